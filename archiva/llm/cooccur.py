"""Items that occur together: counts per pair and how far they exceed chance.

Stripes: each task gives every item an associative array of its neighbours with their counts, over all baskets it
has read so far. Stripes of one item are brought together and merged by adding up their entries. The stripe of an item
found in many baskets is divided by a hash of the neighbours, so that none is gathered whole. What remains of the
merged stripes is held against chance by the log-likelihood ratio.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Baskets beyond this many items are cut into blocks of about this size; every pair of blocks is a row by itself.
BLOCK = 1000
#: A task counts so many entries before it sends its stripes on.
ENTRIES = 2_000_000
#: The stripe of an item is divided once for so many baskets of the item.
HOT = 5000


def _same(cols: Sequence[str]) -> Column:
    """Condition that l and r agree in ``cols``, nulls included."""
    return reduce(lambda a, b: a & b, (F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in cols), F.lit(True))


def _pairs(size: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of both items of every pair i < j of each basket, of which ``start`` and ``size`` are given."""
    many = size * (size - 1) // 2
    basket = np.repeat(np.arange(len(size)), size)
    i = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    times = size[basket] - i - 1
    left = np.repeat(i + start[basket], times)
    step = np.arange(many.sum()) - np.repeat(np.cumsum(times) - times, times)
    return left, left + 1 + step


def _cross(l_size: np.ndarray, l_start: np.ndarray, r_size: np.ndarray, r_start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of every pair of an item of a left block and one of its right block."""
    many = l_size * r_size
    at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    width = np.repeat(r_size, many)
    return np.repeat(l_start, many) + at // np.maximum(width, 1), np.repeat(r_start, many) + at % np.maximum(width, 1)


class _Groups:
    """Numbers for the groups seen, and one row of each."""

    def __init__(self) -> None:
        self.number: dict[tuple, int] = {}

    def of(self, batch: pa.RecordBatch, n: int) -> np.ndarray:
        if not n:
            return np.zeros(batch.num_rows, np.int64)
        rows = zip(*(batch.column(i).to_pylist() for i in range(n)), strict=True)
        return np.array([self.number.setdefault(r, len(self.number)) for r in rows], np.int64)

    def column(self, i: int, at: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.array([r[i] for r in self.number], kind).take(pa.array(at))


def stripes(blocks: DataFrame, group: Sequence[str], hot: int = HOT, entries: int = ENTRIES) -> DataFrame:
    """group, item, n, part, others, other_n, counts: the stripes of each task.

    ``blocks``: group, items and ns of a basket or a block of one, and right, right_ns of another block of it, null for
    the pairs within. Each task counts up to ``entries`` entries before it sends stripes on.
    """
    k = len(group)
    picked = blocks.select(*group, "items", "ns", "right", "right_ns")
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:k]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            groups = _Groups()
            gid = groups.of(t, k)
            lists = [t.column(k + i) for i in (0, 2)]
            flat = pa.concat_arrays([x.flatten() for x in lists])
            n_of = pa.concat_arrays([t.column(k + i).flatten() for i in (1, 3)]).to_numpy(zero_copy_only=False)
            words = pc.dictionary_encode(flat)
            order = pc.sort_indices(words.dictionary).to_numpy()
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            code = rank[words.indices.to_numpy()] if len(flat) else np.zeros(0, np.int64)
            names = words.dictionary.take(pa.array(order))
            size, width = (pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False).astype(np.int64) for x in lists)
            start, first = np.cumsum(size) - size, np.cumsum(width) - width + size.sum()
            whole = np.flatnonzero(t.column(k + 2).is_null().to_numpy(zero_copy_only=False))
            cut = np.flatnonzero(t.column(k + 2).is_valid().to_numpy(zero_copy_only=False))
            one, two = _pairs(size[whole], start[whole])
            three, four = _cross(size[cut], start[cut], width[cut], first[cut])
            g = np.concatenate([np.repeat(gid[whole], size[whole] * (size[whole] - 1) // 2), np.repeat(gid[cut], size[cut] * width[cut])])
            left, right = np.concatenate([one, three]), np.concatenate([two, four])
            x, y = code[left], code[right]
            # an item has its own number of baskets in each group, so both stand in the entry
            nx, ny = n_of[left], n_of[right]
            swap = x > y
            a, b, n_a, n_b = np.where(swap, y, x), np.where(swap, x, y), np.where(swap, ny, nx), np.where(swap, nx, ny)
            key = (g * len(order) + a) * max(1, len(order)) + b
            key, at, counts = np.unique(key, return_index=True, return_counts=True)
            a, b, g, n_a, n_b = a[at], b[at], g[at], n_a[at], n_b[at]
            divided = n_a >= hot
            part = np.zeros(len(key), np.int64)
            if divided.any():
                mixed = pd.util.hash_array(np.asarray(names.to_pylist(), object), categorize=False)[b[divided]]
                part[divided] = (mixed % (1 + n_a[divided] // hot).astype(np.uint64)).astype(np.int64)
                order = np.lexsort((part, a, g))
                a, b, g, n_a, n_b, counts, part = (v[order] for v in (a, b, g, n_a, n_b, counts, part))
            new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (g[1:] != g[:-1]) | (part[1:] != part[:-1])])) if len(a) else np.zeros(0, np.int64)
            offsets = pa.array(np.append(new, len(a)).astype(np.int32))
            return pa.RecordBatch.from_arrays(
                [*(groups.column(i, g[new], picked_types[i]) for i in range(k)), names.take(pa.array(a[new])).cast(pa.string()), pa.array(n_a[new]), pa.array(part[new]),
                 pa.ListArray.from_arrays(offsets, names.take(pa.array(b)).cast(pa.string())), pa.ListArray.from_arrays(offsets, pa.array(n_b)), pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int64)))],
                names=[*group, "item", "n", "part", "others", "other_n", "counts"],
            )

        waiting: list[pa.RecordBatch] = []
        held = 0
        for b in batches:
            picked_types = [b.column(i).type for i in range(k)]
            size, width = (pc.fill_null(pc.list_value_length(b.column(k + i)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 2))
            many = np.where(b.column(k + 2).is_null().to_numpy(zero_copy_only=False), size * (size - 1) // 2, size * width)
            before = 0
            total = np.cumsum(many)
            while before < b.num_rows:
                past = total[before - 1] if before else 0
                upto = max(before + 1, int(np.searchsorted(total, past + entries - held, "right")))
                waiting.append(b.slice(before, upto - before))
                held += int(total[upto - 1] - past)
                before = upto
                if held >= entries or before < b.num_rows:
                    yield flush(waiting)
                    waiting, held = [], 0
        if held:
            yield flush(waiting)

    return picked.mapInArrow(run, ", ".join([*types, "item string, n bigint, part bigint, others array<string>, other_n array<bigint>, counts array<bigint>"]))


def merge(striped: DataFrame, group: Sequence[str], least: int) -> DataFrame:
    """group, item_a, n_a, item_b, n_b, n_ab: the stripes of one item added up, entries under ``least`` left out."""
    k = len(group)
    key = [*group, "item", "part"]
    near = striped.repartition(*key).sortWithinPartitions(*key)
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in near.schema.fields[:k]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def added(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            one = _Groups()
            row = one.of(pa.RecordBatch.from_arrays([*t.columns[: k + 1], t.column(k + 2)], names=key), k + 2)
            first = np.full(len(one.number), t.num_rows)
            np.minimum.at(first, row, np.arange(t.num_rows))
            words = pc.dictionary_encode(t.column(k + 3).flatten())
            size = pc.list_value_length(t.column(k + 3)).to_numpy(zero_copy_only=False)
            entry = np.repeat(row, size) * max(1, len(words.dictionary)) + words.indices.to_numpy()
            different, at, back = np.unique(entry, return_index=True, return_inverse=True)
            n_ab = np.zeros(len(different), np.int64)
            np.add.at(n_ab, back, t.column(k + 5).flatten().to_numpy(zero_copy_only=False))
            keep = n_ab >= least
            owner, at, n_ab = first[different[keep] // max(1, len(words.dictionary))], at[keep], n_ab[keep]
            mine, spot = pa.array(owner), pa.array(at)
            return pa.RecordBatch.from_arrays(
                [*(t.column(i).take(mine) for i in range(k + 2)), t.column(k + 3).flatten().take(spot), t.column(k + 4).flatten().take(spot), pa.array(n_ab)], names=[*group, "item_a", "n_a", "item_b", "n_b", "n_ab"]
            )

        waiting: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            # the last item may go on in the next batch
            last = [b.column(i)[b.num_rows - 1].as_py() for i in (*range(k + 1), k + 2)]
            cut = b.num_rows
            while cut and [b.column(i)[cut - 1].as_py() for i in (*range(k + 1), k + 2)] == last:
                cut -= 1
            if cut:
                yield added([*waiting, b.slice(0, cut)])
                waiting = []
            waiting.append(b.slice(cut))
        if waiting:
            yield added(waiting)

    return near.mapInArrow(run, ", ".join([*types, "item_a string, n_a bigint, item_b string, n_b bigint, n_ab bigint"]))


def llr(n_ab: Column, n_a: Column, n_b: Column, n: Column) -> Column:
    """Dunning's log-likelihood ratio of a two by two table."""

    def part(k: Column, row: Column, col: Column) -> Column:
        k, e = k.cast("double"), row.cast("double") * col.cast("double") / n.cast("double")
        return F.when((k > 0) & (e > 0), k * F.log(k / e)).otherwise(F.lit(0.0))

    cells = part(n_ab, n_a, n_b) + part(n_a - n_ab, n_a, n - n_b) + part(n_b - n_ab, n - n_a, n_b)
    return F.lit(2.0) * (cells + part(n - n_a - n_b + n_ab, n - n_a, n - n_b))


def together(
    members: DataFrame, totals: DataFrame, group: Sequence[str], basket: Sequence[str], item: str, min_together: int = 1, block: int = BLOCK, hot: int = HOT, entries: int = ENTRIES
) -> DataFrame:
    """Pairs of items by group: item_a, item_b (item_a < item_b), n_a, n_b, n_ab, n, lift, llr.

    ``members``: rows (group, basket, item), repeats allowed; null items are dropped; items are texts. ``totals``: group
    and n, the number of baskets with or without items. Pairs in fewer than ``min_together`` baskets are left out; items
    in fewer baskets can be in no such pair and are put aside first, which changes nothing in the result. Ties need no
    rule, as every pair that meets the condition is returned. Null group and basket values are values like others.
    """
    rows = members.select(*group, F.struct(*basket).alias("_basket"), F.col(item).cast("string").alias("_item")).where(F.col("_item").isNotNull()).distinct()
    seen = rows.groupBy(*group, "_item").agg(F.count("*").alias("_n"))
    if min_together > 1:
        seen = seen.where(F.col("_n") >= min_together)
    kept = rows.alias("l").join(seen.alias("r"), _same([*group, "_item"])).select("l.*", F.struct(F.col("l._item").alias("item"), F.col("r._n").alias("n")).alias("_s"))
    # a basket of many items is cut into blocks, so that no task gathers it whole
    sizes = kept.groupBy(*group, "_basket").agg(F.count("*").alias("_size")).where(F.col("_size") > block)
    blocks = F.ceil(F.coalesce("r._size", F.lit(1)) / F.lit(block))
    sized = kept.alias("l").join(sizes.alias("r"), _same([*group, "_basket"]), "left").select("l.*", blocks.alias("_blocks"))
    sized = sized.withColumn("_block", F.pmod(F.xxhash64("_item"), F.col("_blocks")))
    packed = sized.groupBy(*group, "_basket", "_blocks", "_block").agg(F.sort_array(F.collect_list("_s")).alias("_all"))
    packed = packed.select(*group, "_basket", "_blocks", "_block", F.transform("_all", lambda s: s["item"]).alias("items"), F.transform("_all", lambda s: s["n"]).alias("ns"))
    within = packed.where(F.size("items") > 1).select(*group, "items", "ns", F.lit(None).cast("array<string>").alias("right"), F.lit(None).cast("array<bigint>").alias("right_ns"))
    large = packed.where(F.col("_blocks") > 1)
    pair = large.alias("l").join(large.alias("r"), _same([*group, "_basket"]) & (F.col("l._block") < F.col("r._block")))
    between = pair.select(*(F.col(f"l.{c}") for c in group), "l.items", "l.ns", F.col("r.items").alias("right"), F.col("r.ns").alias("right_ns"))
    merged = merge(stripes(within.unionByName(between), group, hot, entries), group, min_together)
    out = merged.alias("l").join(totals.alias("r"), _same(group)).select(*(F.col(f"l.{c}") for c in group), "item_a", "item_b", "n_a", "n_b", "n_ab", F.col("r.n").alias("n"))
    n_a, n_b, n_ab, n = (F.col(c) for c in ("n_a", "n_b", "n_ab", "n"))
    return out.withColumns({"lift": n_ab * n.cast("double") / (n_a.cast("double") * n_b), "llr": llr(n_ab, n_a, n_b, n)})
