"""The flow from boxes to network, as one lazy plan over tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from archiva.functions.text import clean_ocr
from archiva.operators import contracts, graph, panel, parse, sequence
from archiva.operators.backends import Backend, Stub, extract_entities
from archiva.session import stage, table

#: So many gaps are sent to all tasks at most; more are joined by shuffle.
FEW = 100_000


@dataclass
class Result:
    records: DataFrame
    panel: DataFrame | None
    nodes: DataFrame | None
    edges: DataFrame | None


def reclean(boxes: DataFrame) -> DataFrame:
    """Boxes with ocr_text_clean made anew from ocr_text."""
    return boxes.withColumn("ocr_text_clean", clean_ocr(F.col("ocr_text")))


def run_pipeline(
    boxes: DataFrame, extractor: Callable[[], Backend] = lambda: Stub(lambda x: None, up=False), volumes: list[str] | None = None, only_text: bool = False, skip_entities: bool = False, skip_network: bool = False,
    most_entities: int | None = None, resegment_first: bool = False, cut: Callable[[DataFrame], DataFrame] = stage,
) -> Result:
    """Boxes with text, grouped into records, renumbered, lost ones recovered, parsed, entities extracted, panel and network.

    Numbers are repaired on a few columns, in which src and piece name the text of a row, since a volume is one task
    there; the texts are joined to them once, when all rows are known, and parsed once. ``cut`` materialises what is
    read again. With ``resegment_first`` buried records are looked for before lost numbers become rows, which else hide
    the gaps.
    """
    d = boxes.where(F.col("tomo").isin(volumes)) if volumes else boxes
    texts = contracts.group_records(d).withColumnRenamed("island", "pos")
    if only_text:
        return Result(parse.parse_text(texts, "texto_completo"), None, None, None)
    texts = cut(texts)
    group, parts = ["tomo_id"], texts.withColumnRenamed("pos", "src").withColumn("piece", F.lit(1)).drop("tomo_id", "id_num", "class_origin")

    def repair(x: DataFrame) -> DataFrame:
        return cut(renumber(sequence.repair(x, group)))

    def recover(x: DataFrame) -> DataFrame:
        nonlocal parts
        holes = cut(sequence.gaps(x, group, "pos", "id_num", "src"))
        few = F.broadcast if holes.count() <= FEW else lambda h: h
        found = cut(sequence.pieces(parts.select("src", "texto_completo").join(few(holes), "src"), group, "id_num", "texto_completo", carry=["src"]).withColumnRenamed("sub", "piece"))
        parts = parts.unionByName(found.select("src", "piece", "texto_completo"), allowMissingColumns=True)
        first = found.groupBy("src").agg(F.min("desde").alias("_cut"))
        base = x if "id_status" in x.columns else x.withColumn("id_status", F.lit(""))
        new = found.select(*group, F.col("orden").alias("pos"), "piece", "id_num", "src", F.lit("resegmentado").alias("id_status")).withColumn("sub", F.col("piece"))
        both = base.join(few(first), "src", "left").withColumn("sub", F.lit(1)).unionByName(new, allowMissingColumns=True)
        return cut(renumber(both.withColumn("orden", F.col("pos"))))

    rows = texts.select("pos", *group, "id_num", "class_origin", F.col("pos").alias("src"), F.lit(1).alias("piece"))
    for step in ((recover, repair) if resegment_first else (repair, recover)):
        rows = step(rows)
    # lost rows have no text; their own numbers keep them from meeting in one task
    records = rows.withColumn("src", F.coalesce("src", -F.col("pos"))).join(parts, ["src", "piece"], "left")
    records = parse.parse_text(records.withColumn("texto_completo", sequence.text_before("texto_completo", "_cut")).drop("src", "piece", "_cut"), "texto_completo")
    if resegment_first:  # rows that came after the search have no fields
        records = records.withColumns({c: F.when(F.col("id_status") != "perdido", F.col(c)) for c in (*parse.FIELDS, "anio_num", "n_subregistros", "_parse_ok")})
    blank = {c: F.lit("") for c in ("tipo", "personas", "naos", "lugares", "atributos")}
    if most_entities is not None and not skip_entities:
        records = cut(records)
    records = cut(records.withColumns(blank) if skip_entities else extract_entities(records, "pos", "asunto", extractor, most_entities))
    kept, _ = panel.split_headers(records)
    long = panel.panelize(kept.withColumn("contrato_idx", F.col("pos")))
    if skip_network:
        return Result(records, long, None, None)
    e = graph.edges(records)
    return Result(records, long, graph.nodes(records, e), e)


def renumber(df: DataFrame) -> DataFrame:
    """Places from 1 in the order of orden, sub and number, counted per volume and offset, so no volume waits for another."""
    w = W.partitionBy("tomo_id").orderBy("orden", "sub", "id_num")
    n = df.groupBy("tomo_id").agg(F.count("*").alias("_n")).withColumn("_off", F.coalesce(F.sum("_n").over(W.orderBy("tomo_id").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    d = df.withColumn("_r", F.row_number().over(w)).alias("d").join(n.alias("n"), F.col("d.tomo_id").eqNullSafe(F.col("n.tomo_id"))).select("d.*", "n._off")
    return d.withColumn("pos", (F.col("_off") + F.col("_r")).cast("bigint")).drop("_r", "_off", "orden", "sub")


def q_pipeline(spark, sf_dir: str) -> DataFrame:
    """The whole flow over the records of the catalogue taken for boxes, with a rule for a model.

    n: rows of the panel by kind, persons and edges of the network; suma: their weighted degree and weight.
    """
    from archiva.plans.records import boxes

    def factory() -> Backend:
        import json
        import re

        def answer(text: object) -> str:
            found = re.findall(r"(?:[A-ZÁÉÍÓÚ]\w+ )(?:de |del )?[A-ZÁÉÍÓÚ]\w+", str(text))
            return "La respuesta: " + json.dumps({"tipo": "Otros", "personas": found, "naos": [], "lugares": [], "atributos": {found[0]: "otorgante"} if found else {}}, ensure_ascii=False)

        return Stub(answer)

    # the texts have line ends, which the cleaning of boxes takes out
    d = boxes(spark, sf_dir, "texto_completo").withColumn("ocr_text_clean", F.regexp_replace("ocr_text_clean", "\n", " "))
    r = run_pipeline(d, factory)
    none = F.lit(None).cast("string")
    panel_n = r.panel.groupBy("id_status", "tipo_entidad").agg(F.count("*").alias("n"), F.lit(None).cast("bigint").alias("suma"))
    nodes_n = r.nodes.agg(F.count("*").alias("n"), F.sum("grado_ponderado").alias("suma"))
    edges_n = r.edges.agg(F.count("*").alias("n"), F.sum("peso").alias("suma"))
    out = panel_n.select(F.lit("panel").alias("parte"), "id_status", "tipo_entidad", "n", "suma")
    for name, d in (("nodos", nodes_n), ("aristas", edges_n)):
        out = out.unionByName(d.select(F.lit(name).alias("parte"), none.alias("id_status"), none.alias("tipo_entidad"), "n", "suma"))
    return out


def q_upsert(spark, sf_dir: str) -> DataFrame:
    """New extractions applied to records by key."""
    from archiva.operators.entities import apply_extractions

    d = table(spark, sf_dir, "compilado", "contrato_idx", "tipo", "personas", "naos", "lugares", "atributos")
    p = table(spark, sf_dir, "panel", "contrato_idx", "tipo_entidad", "entidad")
    new = p.where("tipo_entidad = 'nao'").groupBy("contrato_idx").agg(F.max("entidad").alias("naos")).withColumn("tipo", F.lit("nuevo"))
    out, _ = apply_extractions(d, new, "contrato_idx")
    return out.drop("atributos", "lugares")


QUERIES = {"q_pipeline": q_pipeline, "q_upsert": q_upsert}
SQL = {
    "q_upsert": """WITH n AS (SELECT contrato_idx, max(entidad) AS naos FROM panel WHERE tipo_entidad = 'nao' GROUP BY 1)
  SELECT c.contrato_idx, CASE WHEN n.contrato_idx IS NOT NULL THEN 'nuevo' ELSE c.tipo END AS tipo, CASE WHEN n.contrato_idx IS NOT NULL THEN '' ELSE c.personas END AS personas, CASE WHEN n.contrato_idx IS NOT NULL THEN coalesce(n.naos, '') ELSE c.naos END AS naos
  FROM compilado c LEFT JOIN n ON c.contrato_idx = n.contrato_idx""",
}
