"""Queries on the mix of sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archiva.llm import mix as m
from archiva.session import checkpoint, spread, table


def _tokens(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return m.count_tokens(spread(table(spark, sf_dir, "documents", *cols, "text")), "text")


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one row per source: the corpus is tokenised once, the rest works on this
    sizes = checkpoint(_tokens(spark, sf_dir, "source").groupBy("source").agg(F.sum("n_tokens").alias("n_tokens")))
    return m.plan(sizes, table(spark, sf_dir, "mezcla_objetivo"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that cannot reach their share."""
    return _plan(spark, sf_dir).where(~F.col("reaches")).select("source")


def p7_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target shares, rates, planned shares and those of the copies that p7_mix makes."""
    # a number and a count a document: the corpus is tokenised once for the plan and for the mix
    docs = checkpoint(_tokens(spark, sf_dir, "doc_id", "source"))
    sizes = docs.groupBy("source").agg(F.sum("n_tokens").alias("n_tokens"))
    p = checkpoint(m.plan(sizes, table(spark, sf_dir, "mezcla_objetivo")))
    return m.realised(docs, p, "doc_id")


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix itself: documents with the number of the copy."""
    rates = _plan(spark, sf_dir).select("source", "rate")
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "n_chars")
    return m.mix(docs, rates, "doc_id")


QUERIES = {"p7_found": p7_found, "p7_plan": p7_plan, "p7_mix": p7_mix}
SQL: dict[str, str] = {}
