"""Choosing preparation profiles: figures summed up by volume, distances to a reference, the best of a grid."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from archiva.session import checkpoint

# The figures that profiles are compared by.
KEYS = ["ink_lt_128", "white_ge_240", "mean", "std", "p10", "p50", "p90"]


def summary(df: DataFrame, by: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """mean, median, std (of the whole), min and max of each figure by group, in one pass."""
    aggs = [f(k).alias(f"{k}_{n}") for k in keys for n, f in (("mean", F.avg), ("median", lambda c: F.percentile(c, F.lit(0.5))), ("std", F.stddev_pop), ("min", F.min), ("max", F.max))]
    return df.groupBy(*by).agg(F.count("*").alias("paginas"), *aggs)


def histogram_long(df: DataFrame, by: Sequence[str], bins: Sequence[str]) -> DataFrame:
    """bin, mean, median, std of each band by group."""
    long = df.unpivot(list(by), list(bins), "bin", "valor")
    return long.groupBy(*by, "bin").agg(F.avg("valor").alias("mean"), F.percentile("valor", F.lit(0.5)).alias("median"), F.stddev_pop("valor").alias("std"))


def distance(stats: DataFrame, reference: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``stats`` with distance: mean over figures of the medians' difference in spreads of the one-row reference."""
    ref = reference.select(*(F.col(f"{k}_{m}").alias(f"_ref_{k}_{m}") for k in keys for m in ("median", "std")))
    parts = [F.abs(F.col(f"{k}_median") - F.col(f"_ref_{k}_median")) / F.greatest(F.col(f"_ref_{k}_std"), F.lit(1e-6)) for k in keys]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return stats.crossJoin(ref).withColumn("distance", total / len(keys)).select(*stats.columns, "distance")


def best_profile(results: DataFrame, by: Sequence[str], baseline: str = "baseline", least: float = 5.0) -> DataFrame:
    """by, profile, distance, improvement (per cent of the baseline) and adopted; ties go to the earlier grid entry."""
    best = F.min_by(F.struct("profile", "distance"), F.struct("distance", "grid_pos"))
    base = F.max(F.when(F.col("profile") == baseline, F.col("distance")))
    g = results.groupBy(*by).agg(best.alias("b"), base.alias("base"))
    gain = 100.0 * (F.col("base") - F.col("b.distance")) / F.greatest(F.col("base"), F.lit(1e-6))
    return g.select(*by, "b.*", gain.alias("improvement")).withColumn("adopted", (F.col("profile") != baseline) & (F.col("improvement") > least))


def candidates(distances: DataFrame, reference: str, k: int, by: str = "tomo") -> DataFrame:
    """The k groups farthest from the reference."""
    return distances.where(F.col(by) != reference).orderBy(F.desc("distance"), by).limit(k)


def grid(spark, entries: Sequence[Mapping[str, object]], base: Mapping[str, object]) -> DataFrame:
    """A table of parameter sets, each the base with its changes; a few rows, for a broadcast cross join."""
    rows = [{"grid_pos": i, "profile": str(e["name"]), **{k: type(v)(e.get(k, v)) for k, v in base.items()}} for i, e in enumerate(entries)]
    return spark.createDataFrame(rows)


def with_profile(df: DataFrame, overrides: DataFrame, by: str, base: Mapping[str, object]) -> DataFrame:
    """``df`` with the parameters of its group's profile, or the base's, and profile_name."""
    o = overrides.select(by, *(F.col(k).alias(f"_o_{k}") for k in base if k in overrides.columns), F.lit(True).alias("_o"))
    j = df.join(o, by, "left")
    cols = {k: F.coalesce(F.col(f"_o_{k}"), F.lit(v)) if k in overrides.columns else F.lit(v) for k, v in base.items()}
    return j.select(*df.columns, *(c.alias(k) for k, c in cols.items()), F.when(F.col("_o"), F.col(by)).otherwise("default").alias("profile_name"))


def evenly(df: DataFrame, by: Sequence[str], order: str, k: int) -> DataFrame:
    """k rows of each group evenly spread over its order, first and last among them; all if there are no more."""
    w = W.partitionBy(*by)
    d = df.withColumn("_r", F.row_number().over(w.orderBy(order)) - 1).withColumn("_n", F.count("*").over(w))
    picks = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.bround(i * (F.col("_n") - 1) / F.lit(float(max(k - 1, 1)))).cast("bigint"))
    return d.where((F.col("_n") <= k) | F.array_contains(picks, F.col("_r"))).drop("_r", "_n")


def stride(df: DataFrame, order: str, most: int = 10) -> DataFrame:
    """Every n-th row so that at most ``most`` are left.

    Rows are cut into ranges of ``order``, each range is ranked by itself, and the rows before it are added.
    """
    d = checkpoint(df.repartitionByRange(F.col(order)).withColumn("_p", F.spark_partition_id()))
    sizes = d.groupBy("_p").agg(F.count("*").alias("_n"))
    before = sizes.select("_p", F.coalesce(F.sum("_n").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    step = sizes.agg(F.greatest(F.lit(1), F.floor(F.sum("_n") / most)).alias("_s"))
    d = d.withColumn("_r", F.row_number().over(W.partitionBy("_p").orderBy(order)) - 1).join(F.broadcast(before), "_p").crossJoin(F.broadcast(step))
    return d.where((F.col("_r") + F.col("_before")) % F.col("_s") == 0).orderBy(order).limit(most).select(*df.columns)


def seeded_sample(df: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    """k rows drawn by a hash of the key: the same on any cluster."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(k)


def name_key(c: Column) -> Column:
    """A name for matching files of one volume: lower case, single blanks."""
    return F.lower(F.regexp_replace(F.trim(c), r"\s+", " "))
