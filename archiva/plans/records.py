"""Queries on records: grouping, parsing, numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from archiva.operators import contracts, parse, sequence
from archiva.session import spread, table


def boxes(spark: SparkSession, sf_dir: str, text: str = "asunto") -> DataFrame:
    """Records as if they were the boxes of their page, in the order of their index."""
    d = table(spark, sf_dir, "compilado", "tomo_id", "page_inicio", "contrato_idx", "class_origin", text)
    rank = F.row_number().over(W.partitionBy("tomo_id", "page_inicio").orderBy("contrato_idx"))
    return d.select(F.col("tomo_id").alias("tomo"), F.col("page_inicio").alias("page_num"), rank.alias("sort_idx"), F.col("class_origin").alias("class_name"), F.col(text).alias("ocr_text_clean"), "contrato_idx")


def q_group_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.group_records(boxes(spark, sf_dir))


def q_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.page_texts(boxes(spark, sf_dir), "ocr_text_clean")


def q_volume_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of each volume stitched: what each page adds to the volume's text."""
    return contracts.volume_parts(contracts.page_texts(boxes(spark, sf_dir), "ocr_text_clean"), "text")


def q_soft_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with the lines of each paragraph joined."""
    d = table(spark, sf_dir, "documents", "doc_id", "text")
    return d.select("doc_id", contracts.join_soft_breaks(F.col("text")).alias("text"))


def q_segment_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records found in the texts by their header lines."""
    return contracts.segment_by_headers(spread(table(spark, sf_dir, "compilado", "contrato_idx", "texto_completo")), "contrato_idx", "texto_completo")


def q_parse_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fields parsed anew from the whole text."""
    d = spread(table(spark, sf_dir, "compilado", "contrato_idx", "texto_completo")).withColumn("_x", F.regexp_replace("texto_completo", "\n", " "))
    return parse.parse_text(d.drop("texto_completo"), "_x").drop("_x")


def q_parse_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_report(q_parse_fields(spark, sf_dir))


def q_parse_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many records give the year, office and folio that they were stored with."""
    d = table(spark, sf_dir, "compilado", "contrato_idx", "anio_num", "escribania", "folio").alias("a").join(q_parse_fields(spark, sf_dir).alias("b"), "contrato_idx")
    same = lambda c: F.count_if(F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))).alias(f"igual_{c}")
    return d.agg(F.count("*").alias("n"), same("anio_num"), same("escribania"), same("folio"))


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of each volume of a run in their order, with the numbers as they were read."""
    return table(spark, sf_dir, "compilado", "run_id", "tomo_id", "contrato_idx", "id_num_original", "class_origin", "texto_completo").select("run_id", "tomo_id", F.col("contrato_idx").alias("pos"), F.col("id_num_original").alias("id_num"), "class_origin", "texto_completo")


GROUP = ["run_id", "tomo_id"]


def q_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.anchors(_numbered(spark, sf_dir).drop("texto_completo"), GROUP, "pos", "id_num").select("pos", "is_anchor")


def q_sequence_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers repaired, lost ones as rows."""
    d = sequence.repair(_numbered(spark, sf_dir).drop("texto_completo"), GROUP)
    return d.select(*GROUP, "orden", "sub", "id_num", "id_num_original", "id_status")


def q_id_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_sequence_repair(spark, sf_dir).groupBy("id_status").agg(F.count("*").alias("n"))


def q_buried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records buried in the text of the one before."""
    return sequence.buried(_numbered(spark, sf_dir), GROUP).select(*GROUP, "orden", "sub", "id_num", "desde")


def q_resegment(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = sequence.resegment(_numbered(spark, sf_dir), GROUP)
    return d.groupBy("id_status", "_parse_ok").agg(F.count("*").alias("n"))


def q_subregistros(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by the number of record starts in their text."""
    d = table(spark, sf_dir, "compilado", "texto_completo").select(parse.count_subrecords(F.regexp_replace("texto_completo", "\n", " ")).alias("n_subregistros"))
    return d.groupBy("n_subregistros").agg(F.count("*").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (q_group_contracts, q_page_text, q_volume_text, q_soft_breaks, q_segment_text, q_parse_fields, q_parse_report, q_parse_agreement, q_anchors, q_sequence_repair, q_id_status_counts, q_buried, q_resegment, q_subregistros)
}

_BOXES = r"""boxes AS (SELECT tomo_id AS tomo, page_inicio AS page_num, row_number() OVER (PARTITION BY tomo_id, page_inicio ORDER BY contrato_idx) AS sort_idx, coalesce(class_origin, '') AS k,
  regexp_replace(coalesce(asunto, ''), '^\s+|\s+$', '', 'g') AS t FROM compilado)"""
_ORD = "tomo NULLS FIRST, page_num NULLS FIRST, sort_idx"
_ANCHORS = """
src AS (SELECT run_id, tomo_id, contrato_idx AS pos, id_num_original AS v, coalesce(class_origin, '') AS k, row_number() OVER (PARTITION BY run_id, tomo_id ORDER BY id_num_original IS NULL, contrato_idx) AS r FROM compilado),
walk AS (SELECT run_id, tomo_id, pos, v, r, v AS last, true AS is_anchor FROM src WHERE r = 1 AND v IS NOT NULL
  UNION ALL SELECT s.run_id, s.tomo_id, s.pos, s.v, s.r, CASE WHEN s.v > w.last AND s.v - w.last < 100 THEN s.v ELSE w.last END, s.v > w.last AND s.v - w.last < 100
  FROM walk w JOIN src s ON s.run_id IS NOT DISTINCT FROM w.run_id AND s.tomo_id IS NOT DISTINCT FROM w.tomo_id AND s.r = w.r + 1 AND s.v IS NOT NULL),
marked AS (SELECT s.*, coalesce(w.is_anchor, false) AS a FROM src s LEFT JOIN walk w ON w.pos = s.pos)"""
_REPAIR = f"""WITH RECURSIVE {_ANCHORS},
w1 AS (SELECT *, last_value(CASE WHEN a THEN v END IGNORE NULLS) OVER (PARTITION BY run_id, tomo_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS va,
  first_value(CASE WHEN a THEN v END IGNORE NULLS) OVER (PARTITION BY run_id, tomo_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS vb,
  first_value(CASE WHEN a THEN pos END IGNORE NULLS) OVER (PARTITION BY run_id, tomo_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS pb,
  sum(a::int) OVER (PARTITION BY run_id, tomo_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg FROM marked),
w2 AS (SELECT *, (NOT a AND va IS NOT NULL AND vb IS NOT NULL) AS inside, (NOT a AND va IS NOT NULL AND vb IS NOT NULL AND (v IS NOT NULL OR k <> 'continuacion'))::int AS fit FROM w1),
w3 AS (SELECT *, sum(fit) OVER (PARTITION BY run_id, tomo_id, seg ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS kk, sum(fit) OVER (PARTITION BY run_id, tomo_id, seg) AS fits FROM w2),
w4 AS (SELECT *, (fit = 1 AND kk <= vb - va - 1) AS fill FROM w3),
fixed AS (SELECT run_id, tomo_id, pos AS orden, 1 AS sub, CASE WHEN fill THEN (va + kk)::bigint ELSE v END AS id_num, v AS id_num_original,
  CASE WHEN a THEN 'ancla' WHEN fill AND v IS NULL THEN 'rellenado' WHEN fill THEN 'corregido' WHEN inside THEN 'header' WHEN v IS NOT NULL AND vb IS NULL AND va IS NOT NULL THEN 'sospechoso' ELSE '' END AS id_status FROM w4
  UNION ALL SELECT run_id, tomo_id, pb, 0, unnest(range((v + fits + 1)::bigint, vb)), NULL, 'perdido' FROM w4 WHERE a AND vb IS NOT NULL AND v + fits + 1 < vb)"""

SQL = {
    "q_soft_breaks": r"""SELECT doc_id, regexp_replace(regexp_replace(t, '([^\n])\n([^\n])', '\1 \2', 'g'), '([^\n])\n([^\n])', '\1 \2', 'g') AS text
  FROM (SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), chr(10)) AS t FROM documents)""",
    "q_group_contracts": rf"""WITH {_BOXES}, n AS (SELECT *, CASE WHEN k = 'continuacion' AND sort_idx = 1 THEN 0 ELSE 1 END AS nw FROM boxes),
  i AS (SELECT *, greatest(1, sum(nw) OVER (ORDER BY {_ORD} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::bigint AS island FROM n),
  g AS (SELECT island, first(tomo ORDER BY {_ORD}) AS tomo, coalesce(string_agg(t, ' ' ORDER BY {_ORD}) FILTER (WHERE t <> ''), '') AS texto_completo, first(k ORDER BY {_ORD}) AS class_origin,
    first(page_num ORDER BY {_ORD}) AS page_inicio, last(page_num ORDER BY {_ORD}) AS page_fin, count(*) AS n_crops FROM i GROUP BY island)
  SELECT island, replace(tomo, ' ', '_') AS tomo_id, TRY_CAST(nullif(regexp_extract(texto_completo, '^(\d+)\s+', 1), '') AS BIGINT) AS id_num, texto_completo, class_origin, page_inicio, page_fin, n_crops FROM g""",
    "q_page_text": f"WITH {_BOXES} SELECT tomo, page_num, coalesce(string_agg(t, chr(10) ORDER BY sort_idx) FILTER (WHERE t <> ''), '') AS text FROM boxes GROUP BY tomo, page_num",
    "q_volume_text": rf"""WITH {_BOXES}, pages AS (SELECT tomo, page_num, coalesce(string_agg(t, chr(10) ORDER BY sort_idx) FILTER (WHERE t <> ''), '') AS raw FROM boxes GROUP BY tomo, page_num),
  c AS (SELECT *, count(*) OVER (PARTITION BY tomo) AS n, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS t FROM pages), k AS (SELECT * FROM c WHERE t <> '' OR n = 1),
  w AS (SELECT *, right(lag(t) OVER o, 1) AS last, lead(t) OVER o IS NOT NULL AS more FROM k WINDOW o AS (PARTITION BY tomo ORDER BY page_num NULLS FIRST))
  SELECT tomo, page_num, CASE WHEN n = 1 THEN raw ELSE CASE WHEN last IS NULL OR last = '-' THEN '' WHEN last IN ('.', '?', '!', ':', ';', ')') THEN chr(10) || chr(10) ELSE ' ' END
    || CASE WHEN right(t, 1) = '-' AND more THEN left(t, length(t) - 1) ELSE t END END AS parte FROM w""",
    "q_anchors": f"WITH RECURSIVE {_ANCHORS} SELECT pos, a AS is_anchor FROM marked",
    "q_sequence_repair": f"{_REPAIR} SELECT * FROM fixed",
    "q_id_status_counts": f"{_REPAIR} SELECT id_status, count(*) AS n FROM fixed GROUP BY id_status",
}
