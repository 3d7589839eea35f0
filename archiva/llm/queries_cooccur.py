"""Queries on persons named together in a contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archiva.llm.cooccur import together
from archiva.plans import packed
from archiva.session import spread, table

# The chi-squared quantiles of one degree of freedom at 0.001 and 0.05.
SIGNIFICANT = 10.83
LIKELY = 3.84
CONTRACT = ["tomo_id", "id_num", "_single"]


def _pairs(spark: SparkSession, sf_dir: str, min_together: int) -> DataFrame:
    rows = table(spark, sf_dir, "compilado", "run_id", "tomo_id", "id_num", "contrato_idx", "personas")
    # a row without number is a contract by itself
    rows = rows.withColumn("_single", F.when(F.col("id_num").isNull(), F.col("contrato_idx")))
    key = F.struct("run_id", F.when(F.col("id_num").isNotNull(), F.col("tomo_id")).alias("tomo_id"), "id_num", "_single")
    rows = rows.select(key.alias("_key"), "personas")
    totals = rows.select("_key").distinct().groupBy(F.col("_key.run_id").alias("run_id")).agg(F.count("*").alias("n"))
    members = packed.values(spark, sf_dir, spread(rows), "_key", "personas").select("_key.*", "valor")
    return together(members, totals, ["run_id"], CONTRACT, "valor", min_together)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs in four contracts of a run or more, five times as often as chance allows, significant at 0.05.

    The ratio takes nothing away from the counts: of k contracts and a lift of l it is at least 2 k (ln l - 1 + 1 / l),
    which is 6.47 for k = 4 and l = 5. Products are decimals, as they can be too large for a bigint.
    """
    p = _pairs(spark, sf_dir, 4)
    large = lambda c: F.col(c).cast("decimal(18,0)")
    often = large("n_ab") * large("n") >= F.lit(5).cast("decimal(1,0)") * (large("n_a") * large("n_b"))
    return p.where((F.col("llr") >= LIKELY) & often).select("run_id", F.col("item_a").alias("persona_a"), F.col("item_b").alias("persona_b"))


def p5_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs that occur together, with counts, lift, log-likelihood ratio and whether it is significant."""
    p = _pairs(spark, sf_dir, 1)
    return p.withColumn("significativo", (F.col("lift") > 1) & (F.col("llr") >= SIGNIFICANT))


QUERIES = {"p5_found": p5_found, "p5_pairs": p5_pairs}
SQL: dict[str, str] = {}
