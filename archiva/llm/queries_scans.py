"""Queries on the marks of the scanned page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archiva.llm.scans import find_damage, learn, repair_texts
from archiva.session import checkpoint, spread, table

FIELDS = ["texto_completo", "asunto"]


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "compilado", "contrato_idx", "tomo_id", *FIELDS))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divided and misread words, running headers and page numbers of both text fields."""
    df = _texts(spark, sf_dir)
    # asunto is a part of texto_completo, so the vocabulary comes from the latter
    return find_damage(df, "contrato_idx", FIELDS, learn(df, "texto_completo", "tomo_id", checkpoint))


def p4_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both text fields as continuous paragraphs."""
    df = _texts(spark, sf_dir)
    return repair_texts(df, "contrato_idx", FIELDS, learn(df, "texto_completo", "tomo_id", checkpoint))


def p4_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases by field and kind."""
    return p4_found(spark, sf_dir).groupBy("campo", "tipo").agg(F.count("*").alias("n"))


QUERIES = {"p4_found": p4_found, "p4_repaired": p4_repaired, "p4_counts": p4_counts}
SQL: dict[str, str] = {}
