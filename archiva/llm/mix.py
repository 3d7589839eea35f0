"""Mixing sources to target shares of the total size, with a cap on repetition."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Where the public tokenizers lie on each machine.
TOKENIZERS = "/opt/tokenizers"
# Fixed value: the pattern by which the rank files split a text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def count_tokens(df: DataFrame, text: str, path: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken", split: str = SPLIT, out: str = "n_tokens") -> DataFrame:
    """``df`` with the number of tokens of ``text`` under the rank file ``path``; null texts have 0.

    Special tokens' strings count as ordinary text. The file is read once per task.
    """
    fields = df.drop(text).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        tok = tiktoken.Encoding("ranks", pat_str=split, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            n = [len(tok.encode_ordinary(t)) if t else 0 for t in b.column("_text").to_pylist()]
            keep = [b.column(c) for c in fields.names]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(n, pa.int64())], names=[*fields.names, out])

    picked = df.select(*(F.col(f"`{c}`") for c in fields.names), F.col(f"`{text}`").cast("string").alias("_text"))
    fields_sql = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields.fields)
    return picked.mapInArrow(run, f"{fields_sql}, {out} bigint" if fields_sql else f"{out} bigint")


def plan(sizes: DataFrame, targets: DataFrame, source: str = "source", share: str = "peso", cap: str = "max_rep") -> DataFrame:
    """Repetition rate of each target source.

    ``sizes``: source and n_tokens, one row per source (null allowed; it counts in the total only). Columns: source,
    peso, max_rep, n_tokens, total, want (peso * total), rate (want / n_tokens, at most max_rep; 0 without tokens),
    reaches (whether the source has max_rep * n_tokens >= want), mixed (rate * n_tokens), actual (share of the mix).
    The tables are one row per source. Duplicated targets stay separate rows.
    """
    total = sizes.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("total"))
    t = targets.select(F.col(source).alias("source"), F.col(share).cast("double").alias("peso"), F.col(cap).cast("int").alias("max_rep"))
    s = sizes.select(F.col(source).alias("source"), "n_tokens")
    p = t.join(s, "source", "left").withColumn("n_tokens", F.coalesce("n_tokens", F.lit(0))).crossJoin(total)
    p = p.withColumn("want", F.col("peso") * F.col("total"))
    p = p.withColumn("rate", F.when(F.col("n_tokens") > 0, F.least(F.col("max_rep").cast("double"), F.col("want") / F.col("n_tokens"))).otherwise(F.lit(0.0)))
    p = p.withColumn("reaches", F.col("max_rep") * F.col("n_tokens") >= F.col("want"))
    p = p.withColumn("mixed", F.col("rate") * F.col("n_tokens"))
    mix = p.agg(F.sum("mixed").alias("_mix"))
    return p.crossJoin(mix).withColumn("actual", F.when(F.col("_mix") > 0, F.col("mixed") / F.col("_mix")).otherwise(F.lit(0.0))).drop("_mix")


def n_copies(rate: Column, key: str, seed: int = 17) -> Column:
    """How many copies of a row mix() makes."""
    u = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 30)).cast("double") / F.lit(float(1 << 30))
    return F.floor(rate).cast("int") + (u < rate - F.floor(rate)).cast("int")


def realised(docs: DataFrame, p: DataFrame, key: str, source: str = "source", tokens: str = "n_tokens", seed: int = 17) -> DataFrame:
    """``p``, a plan(), with what the mix holds: mixed (tokens of the copies mix() makes) and actual (share of them);
    the expected ones as planned_mixed and planned.

    ``docs``: key, source and tokens, a row per document. Copies are not made but counted, combined map-side.
    """
    r = p.select(F.col("source").alias("_source"), F.col("rate").alias("_rate")).distinct()
    j = docs.join(F.broadcast(r), docs[source] == F.col("_source"))
    held = j.groupBy(F.col("_source").alias("source")).agg(F.sum(n_copies(F.col("_rate"), key, seed) * F.col(tokens)).alias("mixed"))
    q = p.withColumnsRenamed({"mixed": "planned_mixed", "actual": "planned"}).join(held, "source", "left").withColumn("mixed", F.coalesce("mixed", F.lit(0)))
    total = q.agg(F.sum("mixed").alias("_mix"))
    return q.crossJoin(total).withColumn("actual", F.when(F.col("_mix") > 0, F.col("mixed") / F.col("_mix")).otherwise(F.lit(0.0))).drop("_mix")


def mix(docs: DataFrame, rates: DataFrame, key: str, source: str = "source", seed: int = 17) -> DataFrame:
    """Each row of ``docs`` floor(rate) times and once more with probability rate - floor(rate); column ``copia`` from 1.

    The draw is a hash of the key and ``seed``: the same at every run and on any number of executors. Rows of sources
    without a rate are left out. ``rates``: source, rate, one row per target source.
    """
    r = rates.select(F.col("source").alias("_source"), F.col("rate").alias("_rate"))
    j = docs.join(F.broadcast(r), docs[source] == F.col("_source"))
    n = n_copies(F.col("_rate"), key, seed)
    copies = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return j.withColumn("copia", F.explode(copies)).drop("_source", "_rate")
