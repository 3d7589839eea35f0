"""Queries on places and trades typed freely."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archiva.llm.canon import Gazetteer, map_values
from archiva.plans import packed
from archiva.session import checkpoint, spread, table


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """campo, fila, pos, valor, dominio of every value typed."""
    rows = spread(table(spark, sf_dir, "compilado", "contrato_idx", "lugares"))
    places = packed.values(spark, sf_dir, rows, "contrato_idx", "lugares").select("campo", F.col("contrato_idx").alias("fila"), "pos", "valor", F.lit("lugar").alias("dominio"))
    panel = spread(table(spark, sf_dir, "panel", "panel_id", "vecindad", "ocupacion"))
    pair = F.array(
        F.struct(F.lit("vecindad").alias("campo"), F.col("vecindad").alias("valor"), F.lit("lugar").alias("dominio")),
        F.struct(F.lit("ocupacion").alias("campo"), F.col("ocupacion").alias("valor"), F.lit("ocupacion").alias("dominio")),
    )
    long = panel.select(F.col("panel_id").alias("fila"), F.explode(pair).alias("x")).where(F.trim(F.regexp_replace("x.valor", r"\s+", " ")) != "")
    return places.unionByName(long.select("x.campo", "fila", F.lit(1).alias("pos"), "x.valor", "x.dominio"))


def _lists(spark: SparkSession, sf_dir: str) -> dict[str, Gazetteer]:
    """Both reference lists, tables that do not grow."""
    places = table(spark, sf_dir, "lugares_ref", "lugar_id", "lugar", "otro_nombre", "jurisdiccion").collect()
    trades = table(spark, sf_dir, "ocupaciones_ref", "ocupacion_id", "ocupacion").collect()
    return {
        "lugar": Gazetteer.build("lugar", [(r[0], (r[1], r[2]), r[3]) for r in places]),
        "ocupacion": Gazetteer.build("ocupacion", [(r[0], (r[1],), None) for r in trades]),
    }


def p3_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every typed value with its entry."""
    return map_values(_typed(spark, sf_dir), "dominio", "valor", _lists(spark, sf_dir), cut=checkpoint)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_mapped(spark, sf_dir).select("campo", "fila", "pos", "ref_id")


def p3_unlisted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values without an entry, with their number."""
    return p3_mapped(spark, sf_dir).where(F.col("ref_id") == 0).groupBy("dominio", "valor").agg(F.count("*").alias("n"))


QUERIES = {"p3_found": p3_found, "p3_unlisted": p3_unlisted}
SQL: dict[str, str] = {}
