"""Queries on the quality of the texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archiva.llm.quality import text_quality
from archiva.session import spread, table


def p8_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All figures of each document and its kind."""
    # the frequent words are a table that does not grow
    common = [r[0] for r in table(spark, sf_dir, "palabras_comunes", "palabra").distinct().collect()]
    return text_quality(spread(table(spark, sf_dir, "documents", "doc_id", "text")), "text", common, "doc_id")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are mostly not prose, with what they are."""
    return p8_stats(spark, sf_dir).where(F.col("clase") != "prosa").select("doc_id", "clase")


QUERIES = {"p8_found": p8_found, "p8_stats": p8_stats}
SQL: dict[str, str] = {}
