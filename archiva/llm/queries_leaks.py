"""Queries on held-out passages in the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archiva.llm.leaks import clean_leaks, collect_items, find_leaks
from archiva.session import spread, table


def _items(spark: SparkSession, sf_dir: str) -> list[tuple[int, str]]:
    """The test items, a table that does not grow."""
    return collect_items(table(spark, sf_dir, "eval_items", "item_id", "pasaje"), "item_id", "pasaje")


def p6_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaks with the stretch of each."""
    docs = spread(table(spark, sf_dir, "documents", "doc_id", "text"))
    return find_leaks(docs, "text", "doc_id", _items(spark, sf_dir))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_spans(spark, sf_dir).select("doc_id", "item_id")


def p6_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus without the leaked stretches: doc_id, the words left and those taken out."""
    docs = spread(table(spark, sf_dir, "documents", "doc_id", "text"))
    out = clean_leaks(docs, "text", "doc_id", _items(spark, sf_dir))
    return out.select("doc_id", F.length("text").alias("n_chars"), "n_removed")


QUERIES = {"p6_found": p6_found, "p6_spans": p6_spans, "p6_clean": p6_clean}
SQL: dict[str, str] = {}
