"""Queries on fields that hold several values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archiva.operators.packed import explode_packed
from archiva.session import spread, table

FIELDS = {"personas": "persona", "naos": "nao", "lugares": "lugar"}


def jurisdictions(spark: SparkSession, sf_dir: str) -> list[str]:
    """The jurisdictions of the reference list of places, a table that does not grow."""
    rows = table(spark, sf_dir, "lugares_ref", "jurisdiccion").distinct().collect()
    return sorted(r[0] for r in rows if r[0])


def values(spark: SparkSession, sf_dir: str, df: DataFrame, key: str = "contrato_idx", *campos: str) -> DataFrame:
    """The values of the packed columns of ``df`` (of ``campos``, or all three)."""
    fields = {c: FIELDS[c] for c in campos or FIELDS}
    return explode_packed(df, key, fields, jurisdictions(spark, sf_dir) if "lugares" in fields else ())


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spread(table(spark, sf_dir, "compilado", "contrato_idx", *FIELDS))
    return values(spark, sf_dir, df)


def p1_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields by number of values: how many fields of each kind hold so many names."""
    per = p1_found(spark, sf_dir).groupBy("campo", "contrato_idx").agg(F.count("*").alias("n_valores"))
    return per.groupBy("campo", "n_valores").agg(F.count("*").alias("n_filas"))


QUERIES = {"p1_found": p1_found, "p1_counts": p1_counts}
SQL: dict[str, str] = {}
