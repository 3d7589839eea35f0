"""Queries on boxes, page profiles, pixel figures, profiles of preparation, comparisons and entities by rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from archiva.operators import compare, entities, imaging, layout, segment, tuning
from archiva.session import spread, table

SHIPS = ["San Telmo", "San Gil", "Santa Polonia", "San Lázaro"]
PLACES = ["Puerto Albora", "Gortujena", "Romtuvaca", "Berridillo"]


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as boxes: one image per order."""
    d = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    i = lambda c: c.cast("int")
    return d.select(
        F.col("l_orderkey").alias("image_path"), F.concat(F.lit("p"), F.col("l_orderkey")).alias("page_label"), i(F.col("l_linenumber") * 10).alias("x1"), i(F.col("l_quantity")).alias("y1"),
        i(F.col("l_linenumber") * 10 + F.col("l_partkey") % 97).alias("x2"), i(F.col("l_quantity") + F.col("l_partkey") % 53).alias("y2"), i(F.col("l_partkey") % 3).alias("class_id"), (F.col("l_partkey") % 100 / 100).alias("conf"), F.lit(100).alias("image_width"), F.lit(80).alias("image_height"),
    )


def q_box_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = layout.rank_boxes(_boxes(spark, sf_dir)).groupBy("image_path").agg(F.max("sort_idx").alias("n"), F.max("box_id").alias("ultimo"), F.max_by("y1", "sort_idx").alias("y_ultimo"))
    return d


def q_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.manifest(layout.clamp(_boxes(spark, sf_dir))).groupBy("image_path").agg(F.sum("crop_area").alias("area"), F.min("x2").alias("x2_min"), F.max("y2").alias("y2_max"), F.count_if(F.col("status") == "cropped").alias("n"))


def q_page_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without lines get the whole page as a box."""
    pages = table(spark, sf_dir, "orders", F.col("o_orderkey").alias("image_path")).withColumns({"image_width": F.lit(100), "image_height": F.lit(80)})
    b = _boxes(spark, sf_dir).withColumn("class_name", F.lit("contrato"))
    return layout.page_fallback(pages, b).groupBy("class_name").agg(F.count("*").alias("n"), F.sum("x2").alias("x2"))


def q_percent_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _boxes(spark, sf_dir).select("image_path", F.col("x1").alias("x0"), F.col("y1").alias("y0"), F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.col("image_width").alias("img_width"), F.col("image_height").alias("img_height"))
    p = layout.to_percent(d)
    back = layout.from_percent(p.drop("x0", "y0", "x1", "y1"))
    return back.groupBy("image_path").agg(F.sum("x0").alias("x0"), F.sum("y0").alias("y0"), F.sum("x1").alias("x1"), F.sum("y1").alias("y1"))


def q_label_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelling tasks written and read back: the boxes of each page in order."""
    d = _boxes(spark, sf_dir).select(F.col("image_path").cast("string").alias("pagina"), F.col("x1").alias("x0"), F.col("y1").alias("y0"), F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.col("image_width").alias("img_width"), F.col("image_height").alias("img_height"))
    t = layout.label_tasks(d).select(F.regexp_replace("task", '"predictions"', '"annotations"').alias("task"))
    return layout.reviewed_boxes(t, "task")


def q_obb_augment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels turned by seven angles."""
    d = _boxes(spark, sf_dir).select("image_path", "class_id", ((F.col("x1") + F.col("x2")) / 200).alias("cx"), ((F.col("y1") + F.col("y2")) / 160).alias("cy"), ((F.col("x2") - F.col("x1")) / 100).alias("w"), ((F.col("y2") - F.col("y1")) / 80).alias("h"))
    return layout.rotate_labels(d, [-6, -4, -2, 0, 2, 4, 6], 1000, 800).groupBy("angle").agg(F.count("*").alias("n"), F.bround(F.avg("x1"), 4).alias("x1"))


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as ink profiles of pages."""
    d = spread(table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding"))
    wide = F.flatten(F.transform("embedding", lambda x: F.array_repeat(F.abs(x.cast("double")) * 100, 20)))
    return d.select("vec_id", F.col("label").alias("tomo"), wide.alias("profile"))


def q_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _profiles(spark, sf_dir).select("vec_id", segment.find_gaps(F.col("profile"), 0.2, 20).alias("g"))
    return d.select("vec_id", F.posexplode("g").alias("pos", "x")).select("vec_id", "pos", F.col("x.a").alias("ini"), F.col("x.b").alias("fin"))


def q_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments and diagnosis of each page."""
    d = segment.segment_pages(_profiles(spark, sf_dir))
    return d.select("vec_id", F.size("gaps").alias("n_gaps"), F.size("segments").alias("n_segmentos"), "diagnostico_flags", "diagnostico_score", "diagnostico_estado")


def _pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as grey pixels."""
    d = table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding")
    grey = F.transform("embedding", lambda x: F.pmod(F.floor(F.abs(x.cast("double")) * 1000).cast("int"), F.lit(256)))
    return d.select("vec_id", F.col("label").alias("tomo"), grey.alias("px"))


def q_pixel_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = imaging.pixel_figures(_pixels(spark, sf_dir), "vec_id", "px")
    return d.select("vec_id", *(F.col(c).cast("bigint").alias(c) for c in ("pixel_count", "min", "max")), *(F.bround(F.col(c) * 1000).cast("bigint").alias(c) for c in ("ink_lt_128", "white_ge_240", *(b[0] for b in imaging.BINS))))


def _figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _pixels(spark, sf_dir)
    return imaging.pixel_figures(p, "vec_id", "px").join(p.select("vec_id", "tomo"), "vec_id")


def q_tomo_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = tuning.summary(_figures(spark, sf_dir), ["tomo"])
    return d.select("tomo", "paginas", *(F.bround(c, 3).alias(c) for c in d.columns if c not in ("tomo", "paginas")))


def q_histogram_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tuning.histogram_long(_figures(spark, sf_dir), ["tomo"], [b[0] for b in imaging.BINS]).select("tomo", "bin", F.bround("mean", 4).alias("media"))


def q_profile_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of each volume to volume 0."""
    s = tuning.summary(_figures(spark, sf_dir), ["tomo"])
    return tuning.distance(s, s.where("tomo = 0")).select("tomo", F.bround("distance", 4).alias("distancia"))


def q_best_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best of a grid of profiles by volume; the grid scales the distance."""
    d = q_profile_distance(spark, sf_dir)
    g = tuning.grid(spark, [{"name": "baseline", "k": 1.0}, {"name": "suave", "k": 0.97}, {"name": "fuerte", "k": 0.8}], {"k": 1.0})
    r = d.crossJoin(F.broadcast(g)).withColumn("distance", F.col("distancia") * F.col("k"))
    return tuning.best_profile(r, ["tomo"]).select("tomo", "profile", "adopted")


def q_sample_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five pages of each volume, evenly spread (a sampling operator)."""
    return tuning.evenly(table(spark, sf_dir, "documents", "doc_id", "source"), ["source"], "doc_id", 5)


def _two_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Texts and their joined lines, as if by two recognisers."""
    from archiva.functions.text import join_lines

    a = spread(table(spark, sf_dir, "documents", F.col("doc_id").alias("pagina"), "text")).withColumn("tiempo_s", F.lit(1.0))
    return a, a.select("pagina", join_lines(F.col("text")).alias("text"), F.lit(2.0).alias("tiempo_s"))


def q_ab_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of both sides of all texts and their differences."""
    return compare.compare(*_two_sides(spark, sf_dir), "pagina", similarity=False).select("pagina", "v1_chars", "v2_chars", "v1_lineas", "v2_lineas", "v1_valido", "v2_valido", "delta_chars", "delta_tiempo")


def q_ab_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity of both sides of all texts."""
    return compare.compare(*_two_sides(spark, sf_dir), "pagina").select("pagina", "similitud_v1_v2", "delta_chars", "delta_tiempo")


def q_type_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "compilado", "asunto").select(entities.record_type(F.col("asunto")).alias("regla")).groupBy("regla").agg(F.count("*").alias("n"))


def q_gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "compilado", "contrato_idx", "asunto")
    return d.select("contrato_idx", F.array_join(entities.mentioned(F.col("asunto"), SHIPS), "; ").alias("naos"), F.array_join(entities.mentioned(F.col("asunto"), PLACES), "; ").alias("lugares"))


def q_persons_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "compilado", "contrato_idx", "asunto")
    return d.select("contrato_idx", F.array_join(entities.persons(F.col("asunto"), ["Juan", "Pedro", "Domingo"], ["Ribemora", "Navalfresno"]), "; ").alias("personas"))


def q_entities_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of a model, made of the records' own fields, read and normalised."""
    d = table(spark, sf_dir, "compilado", "contrato_idx", "tipo", "personas", "naos", "lugares")
    lst = lambda c: F.filter(F.split(F.coalesce(F.col(c), F.lit("")), ";"), lambda x: x != "")
    answer = F.concat(F.lit("Aquí está: "), F.to_json(F.struct(F.upper("tipo").alias("tipo"), *(lst(c).alias(c) for c in ("personas", "naos", "lugares")))), F.lit(" fin"))
    p = entities.normalize_payload(entities.json_in_prose(answer))
    return entities.flatten_payload(d.select("contrato_idx", p.alias("p")), "p")


def q_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a record text of the same number."""
    done = table(spark, sf_dir, "compilado", F.col("contrato_idx").alias("doc_id"), "personas")
    return entities.resume(table(spark, sf_dir, "documents", "doc_id"), done, "doc_id", "personas")


def q_upcoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of events by user: a new one after an hour of silence."""
    d = table(spark, sf_dir, "events", "event_id", "user_id", "ts")
    gap = F.unix_timestamp("ts") - F.unix_timestamp(F.lag("ts").over(W.partitionBy("user_id").orderBy("ts", "event_id")))
    return d.withColumn("nuevo", (gap.isNull() | (gap > 3600)).cast("int")).groupBy("user_id").agg(F.sum("nuevo").alias("tramos"), F.count("*").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        q_box_rank, q_clamp, q_page_fallback, q_percent_boxes, q_label_tasks, q_obb_augment, q_gaps, q_segments, q_pixel_stats, q_tomo_summary, q_histogram_long, q_profile_distance, q_best_profile, q_sample_pages, q_ab_compare, q_ab_similarity,
        q_type_rules, q_gazetteer, q_persons_rules, q_entities_normalize, q_resume, q_upcoming,
    )
}

_B = """b AS (SELECT l_orderkey AS image_path, 'p' || l_orderkey AS page_label, (l_linenumber * 10)::int AS x1, trunc(l_quantity)::int AS y1, (l_linenumber * 10 + l_partkey % 97)::int AS x2, trunc(l_quantity + l_partkey % 53)::int AS y2, (l_partkey % 3)::int AS class_id, (l_partkey % 100) / 100 AS conf, 100 AS w, 80 AS h FROM lineitem)"""
_C = "c AS (SELECT image_path, cx1, cy1, least(w, greatest(x2, cx1 + 1)) AS cx2, least(h, greatest(y2, cy1 + 1)) AS cy2 FROM (SELECT *, greatest(0, least(x1, w - 1)) AS cx1, greatest(0, least(y1, h - 1)) AS cy1 FROM b))"
_PX = "px AS (SELECT vec_id, label AS tomo, list_transform(embedding, lambda x: (floor(abs(x::double) * 1000)::int % 256)) AS p FROM embeddings)"
_BINS = ", ".join(f"round_even(len(list_filter(p, lambda v: v >= {a} AND v <= {b})) / len(p) * 1000, 0)::bigint AS {n}" for n, a, b in imaging.BINS)
_VALID = r"NOT (regexp_full_match({0}, '\s*') OR length(regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '<\|[^|]*\|>', '', 'g'), '\[\[\d[\d,\s]*\]\]', '', 'g'), '^\s+|\s+$', '', 'g'), 'zzz', '')) < 20 OR (length({1}) > 20 AND length(regexp_replace({1}, '[^\p{{L}}]', '', 'g')) / length({1}) < 0.3) OR (len({2}) > 5 AND (len({2}) - len(list_distinct({2}))) / len({2}) > 0.5))"
_LN = r"list_filter(list_transform(string_split({0}, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')"
_ST = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"

SQL = {
    "q_box_rank": f"""WITH {_B}, r AS (SELECT *, row_number() OVER (PARTITION BY image_path ORDER BY y1, x1, y2 - y1 DESC, x2 - x1 DESC, class_id, conf DESC) AS sort_idx FROM b)
  SELECT image_path, max(sort_idx)::int AS n, max(page_label || '_' || lpad(sort_idx::varchar, 4, '0')) AS ultimo, max_by(y1, sort_idx) AS y_ultimo FROM r GROUP BY 1""",
    "q_clamp": f"WITH {_B}, {_C} SELECT image_path, sum((cx2 - cx1) * (cy2 - cy1))::bigint AS area, min(cx2) AS x2_min, max(cy2) AS y2_max, count(*) FILTER (WHERE cx2 > cx1 AND cy2 > cy1) AS n FROM c GROUP BY 1",
    "q_page_fallback": f"""WITH {_B}, j AS (SELECT o_orderkey, b.image_path, b.x2 FROM orders LEFT JOIN b ON o_orderkey = b.image_path)
  SELECT CASE WHEN image_path IS NULL THEN 'page_fallback' ELSE 'contrato' END AS class_name, count(*) AS n, sum(CASE WHEN image_path IS NULL THEN 100 ELSE x2 END)::bigint AS x2 FROM j GROUP BY 1""",
    "q_percent_boxes": f"""WITH {_B} SELECT image_path, sum(trunc(100.0::double * x1 / w / 100.0 * w))::bigint AS x0, sum(trunc(100.0::double * y1 / h / 100.0 * h))::bigint AS y0,
  sum(trunc((100.0::double * x1 / w + 100.0::double * (x2 - x1) / w) / 100.0 * w))::bigint AS x1, sum(trunc((100.0::double * y1 / h + 100.0::double * (y2 - y1) / h) / 100.0 * h))::bigint AS y1 FROM b GROUP BY 1""",
    "q_gaps": """WITH p AS (SELECT vec_id, flatten(list_transform(embedding, lambda x: list_transform(range(20), lambda i: abs(x::double) * 100))) AS p FROM embeddings), e AS (SELECT vec_id, list_max(p) * 0.2 AS low, unnest(p) AS v, generate_subscripts(p, 1) - 1 AS y FROM p),
  r AS (SELECT vec_id, y, y - row_number() OVER (PARTITION BY vec_id ORDER BY y) AS g FROM e WHERE v <= low), k AS (SELECT vec_id, min(y)::int AS ini, (max(y) + 1)::int AS fin FROM r GROUP BY vec_id, g HAVING count(*) >= 20)
  SELECT vec_id, (row_number() OVER (PARTITION BY vec_id ORDER BY ini) - 1)::int AS pos, ini, fin FROM k""",
    "q_pixel_stats": f"WITH {_PX} SELECT vec_id, len(p)::bigint AS pixel_count, list_min(p)::bigint AS min, list_max(p)::bigint AS max, round_even(len(list_filter(p, lambda v: v < 128)) / len(p) * 1000, 0)::bigint AS ink_lt_128, round_even(len(list_filter(p, lambda v: v >= 240)) / len(p) * 1000, 0)::bigint AS white_ge_240, {_BINS} FROM px",
    "q_tomo_summary": f"WITH {_PX} SELECT tomo, count(*) AS paginas, round_even(avg(list_avg(p)), 3) AS media, round_even(quantile_cont(list_aggregate(p, 'quantile_cont', 0.5), 0.5), 3) AS mediana FROM px GROUP BY 1",
    "q_sample_pages": """WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM documents)
  SELECT doc_id, source FROM r WHERE n <= 5 OR r IN (0, round_even((n - 1) / 4, 0), round_even(2 * (n - 1) / 4, 0), round_even(3 * (n - 1) / 4, 0), n - 1)""",
    "q_ab_compare": f"""WITH a AS (SELECT doc_id AS pagina, text FROM documents), b AS (SELECT doc_id AS pagina, array_to_string({_LN.format("text")}, ' ') AS text FROM documents)
  SELECT a.pagina, length({_ST.format("a.text")}) AS v1_chars, length({_ST.format("b.text")}) AS v2_chars, len({_LN.format("a.text")})::int AS v1_lineas, len({_LN.format("b.text")})::int AS v2_lineas, {_VALID.format("a.text", _ST.format("a.text"), _LN.format("a.text"))} AS v1_valido,
  CASE WHEN b.pagina IS NOT NULL THEN {_VALID.format("b.text", _ST.format("b.text"), _LN.format("b.text"))} END AS v2_valido, length({_ST.format("b.text")}) - length({_ST.format("a.text")}) AS delta_chars, CASE WHEN b.pagina IS NOT NULL THEN 1.0::double END AS delta_tiempo FROM a LEFT JOIN b ON a.pagina = b.pagina""",
    "q_gazetteer": "SELECT contrato_idx, array_to_string(list_sort(list_filter([{}], lambda k: contains(lower(coalesce(asunto, '')), lower(k)))), '; ') AS naos, array_to_string(list_sort(list_filter([{}], lambda k: contains(lower(coalesce(asunto, '')), lower(k)))), '; ') AS lugares FROM compilado".format(*(", ".join(f"'{x}'" for x in xs) for xs in (SHIPS, PLACES))),
    "q_entities_normalize": r"""WITH l AS (SELECT contrato_idx, lower(regexp_replace(coalesce(upper(tipo), ''), '^\s+|\s+$', '', 'g')) AS t, {} FROM compilado) SELECT contrato_idx, CASE WHEN t = '' THEN 'otros' ELSE t END AS tipo, array_to_string(personas, '; ') AS personas, array_to_string(naos, '; ') AS naos, array_to_string(lugares, '; ') AS lugares FROM l""".format(", ".join(rf"list_filter(list_transform(string_split(coalesce({c}, ''), ';'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS {c}" for c in ("personas", "naos", "lugares"))),
    "q_resume": r"SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM compilado c WHERE c.contrato_idx = d.doc_id AND regexp_matches(coalesce(c.personas, ''), '\S'))",
    "q_upcoming": """WITH g AS (SELECT user_id, epoch(date_trunc('second', ts)) - epoch(date_trunc('second', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) AS gap FROM events) SELECT user_id, sum((gap IS NULL OR gap > 3600)::int)::bigint AS tramos, count(*) AS n FROM g GROUP BY 1""",
}
_RULES = "CASE {} ELSE 'otros' END".format(" ".join(f"WHEN regexp_matches(coalesce(asunto, ''), '(?i){p}') THEN '{n}'" for n, p in entities.TYPES))
SQL["q_type_rules"] = f"SELECT {_RULES} AS regla, count(*) AS n FROM compilado GROUP BY 1"
SQL["q_entities_normalize"] = SQL["q_entities_normalize"].replace(" AS lugares FROM l", " AS lugares, '' AS atributos FROM l")
SQL["q_label_tasks"] = f"""WITH {_B}, t AS (SELECT image_path::varchar AS pagina, trunc(100.0::double * x1 / w / 100.0 * w)::int AS x0, trunc(100.0::double * y1 / h / 100.0 * h)::int AS y0,
  trunc((100.0::double * x1 / w + 100.0::double * (x2 - x1) / w) / 100.0 * w)::int AS x1, trunc((100.0::double * y1 / h + 100.0::double * (y2 - y1) / h) / 100.0 * h)::int AS y1 FROM b)
  SELECT pagina, row_number() OVER (PARTITION BY pagina ORDER BY y0, y1, x0, x1)::int AS segment_id, x0, y0, x1, y1, 'manual' AS source FROM t"""
SQL["q_histogram_long"] = f"WITH {_PX} " + " UNION ALL ".join(f"SELECT tomo, '{n}' AS bin, round_even(avg(len(list_filter(p, lambda v: v >= {a} AND v <= {b})) / len(p)), 4) AS media FROM px GROUP BY tomo" for n, a, b in imaging.BINS)
_FIGS = f"""{_PX}, f AS (SELECT tomo, len(list_filter(p, lambda v: v < 128)) / len(p) AS ink_lt_128, len(list_filter(p, lambda v: v >= 240)) / len(p) AS white_ge_240, list_avg(p) AS mean, list_aggregate(p, 'stddev_pop') AS std,
  list_aggregate(p, 'quantile_cont', 0.1) AS p10, list_aggregate(p, 'quantile_cont', 0.5) AS p50, list_aggregate(p, 'quantile_cont', 0.9) AS p90 FROM px)"""
_STAT = {"mean": "avg({})", "median": "quantile_cont({}, 0.5)", "std": "stddev_pop({})", "min": "min({})", "max": "max({})"}
SQL["q_tomo_summary"] = f"WITH {_FIGS} SELECT tomo, count(*) AS paginas, " + ", ".join(f"round_even({x.format(k)}, 3) AS {k}_{n}" for k in tuning.KEYS for n, x in _STAT.items()) + " FROM f GROUP BY tomo"
SQL["q_profile_distance"] = (
    f"WITH {_FIGS}, s AS (SELECT tomo, "
    + ", ".join(f"quantile_cont({k}, 0.5) AS {k}_m, stddev_pop({k}) AS {k}_s" for k in tuning.KEYS)
    + " FROM f GROUP BY tomo), r AS (SELECT * FROM s WHERE tomo = 0) SELECT s.tomo, round_even(("
    + " + ".join(f"abs(s.{k}_m - r.{k}_m) / greatest(r.{k}_s, 1e-6)" for k in tuning.KEYS)
    + f") / {len(tuning.KEYS)}, 4) AS distancia FROM s, r"
)
