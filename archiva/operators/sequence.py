"""Numbers of records repaired: anchors of a rising sequence, gaps filled, lost ones found in their neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from archiva.operators.parse import parse_text

#: An anchor is at most this far above the one before it.
MAX_STEP = 100


def anchors(df: DataFrame, group: Sequence[str], pos: str, number: str, max_step: int = MAX_STEP) -> DataFrame:
    """``df`` with is_anchor: the first number of a group, then each that is above the last anchor by less than max_step.

    The rule depends on all rows before, so each group is folded in order. Only (pos, number) of rows with a number
    are gathered, a few bytes each; the fold emits the anchors' places, which are joined back.
    """
    seen = df.where(F.col(number).isNotNull()).groupBy(*group).agg(F.sort_array(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(number).cast("bigint").alias("v")))).alias("_xs"))
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            lists = b.column(b.num_columns - 1)
            xs, ends = lists.flatten(), np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            p, v = (xs.field(k).to_numpy(zero_copy_only=False) for k in ("p", "v"))
            at, places, begin = [], [], 0
            for i, end in enumerate(ends):
                last = None
                for k, x in enumerate(v[begin:end].tolist(), begin):
                    if last is None or last < x < last + max_step:
                        last = x
                        at.append(i)
                        places.append(k)
                begin = end
            # the lists are left behind: taken along, each anchor had a copy of its group's list
            keys = [c.take(pa.array(at, pa.int64())) for c in b.columns[:-1]]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(p[places], pa.int64())], names=[*group, "_p"])

    found = seen.select(*group, "_xs").mapInArrow(run, ", ".join([*(f"`{g}` {types[g]}" for g in group), "_p bigint"]))
    on = F.col(f"d.{pos}") == F.col("a._p")
    for g in group:
        on &= F.col(f"d.{g}").eqNullSafe(F.col(f"a.{g}"))
    return df.alias("d").join(found.alias("a"), on, "left").select("d.*", F.col("a._p").isNotNull().alias("is_anchor"))


def repair(df: DataFrame, group: Sequence[str] = ("tomo_id",), pos: str = "pos", number: str = "id_num", kind: str = "class_origin") -> DataFrame:
    """``df`` with id_num repaired, id_num_original and id_status; lost numbers become rows with status perdido.

    Between two anchors the rows that can take a number (suspicious ones, and those without one that are no
    continuation) take the missing numbers in order; the others are header. More numbers than rows: the rest is lost,
    placed before the next anchor. Suspicious rows after the last anchor are sospechoso. Columns ``orden`` and
    ``sub`` give the order of all rows; ``pos`` must be unique in its group.
    """
    d = anchors(df.drop("id_status", "id_num_original", "orden", "sub"), group, pos, number)
    order = W.partitionBy(*group).orderBy(pos)
    so_far = order.rowsBetween(W.unboundedPreceding, 0)
    # the next anchor is sought from the end: a frame that reaches to the end is summed up anew for each row
    behind = W.partitionBy(*group).orderBy(F.desc(pos)).rowsBetween(W.unboundedPreceding, -1)
    num = F.col(number).cast("bigint")
    mine = F.when(F.col("is_anchor"), num)
    d = d.withColumn("_a", F.last(mine, ignorenulls=True).over(so_far)).withColumn("_b", F.last(mine, ignorenulls=True).over(behind))
    d = d.withColumn("_seg", F.count_if("is_anchor").over(so_far))
    inside = ~F.col("is_anchor") & F.col("_a").isNotNull() & F.col("_b").isNotNull()
    fits = inside & (num.isNotNull() | (F.coalesce(F.col(kind), F.lit("")) != "continuacion"))
    d = d.withColumn("_fit", fits.cast("int"))
    by_seg = W.partitionBy(*group, "_seg").orderBy(pos).rowsBetween(W.unboundedPreceding, 0)
    d = d.withColumn("_k", F.sum("_fit").over(by_seg)).withColumn("_fits", F.sum("_fit").over(W.partitionBy(*group, "_seg")))
    gap = F.col("_b") - F.col("_a") - 1
    fill = (F.col("_fit") == 1) & (F.col("_k") <= gap)
    status = (
        F.when(F.col("is_anchor"), "ancla").when(fill & num.isNull(), "rellenado").when(fill, "corregido").when(inside, "header").when(num.isNotNull() & F.col("_b").isNull() & F.col("_a").isNotNull(), "sospechoso").otherwise("")
    )
    new = F.when(fill, F.col("_a") + F.col("_k")).otherwise(num)
    kept = d.select(*[c for c in df.columns if c not in (number, "id_status", "id_num_original", "orden", "sub")], num.alias("id_num_original"), new.alias(number), status.alias("id_status"), F.col(pos).alias("orden"), F.lit(1).alias("sub"))
    # lost numbers hang on the anchor before them; its segment knows how many rows could be filled
    ends = d.where(F.col("is_anchor") & F.col("_b").isNotNull())
    ends = ends.withColumn("_next", F.col("_b")).withColumn("_from", num + F.col("_fits") + 1).where(F.col("_from") < F.col("_b"))
    after = d.where("is_anchor").select(*group, (F.col("_seg") - 1).alias("_seg"), F.col(pos).alias("_at"))
    lost = ends.join(after, [*group, "_seg"]).select(*group, F.explode(F.sequence("_from", F.col("_b") - 1)).alias(number), F.col("_at").alias("orden"))
    lost = lost.select(*group, F.col(number), "orden", F.lit(0).alias("sub"), F.lit("perdido").alias("id_status"))
    return kept.unionByName(lost, allowMissingColumns=True)


def gaps(df: DataFrame, group: Sequence[str], pos: str, number: str, *carry: str) -> DataFrame:
    """Anchors that miss more numbers up to the next anchor than rows stand between: group, _p and _v (place and number),
    _b (the next anchor's number) and the columns ``carry``."""
    d = anchors(df, group, pos, number)
    order = W.partitionBy(*group).orderBy(pos)
    d = d.withColumn("_seg", F.count_if("is_anchor").over(order.rowsBetween(W.unboundedPreceding, 0))).where(F.col("_seg") > 0)
    per = d.groupBy(*group, "_seg").agg(F.max(F.when(F.col("is_anchor"), F.struct(F.col(pos).alias("_p"), F.col(number).cast("bigint").alias("_v"), *carry))).alias("a"), F.count_if(~F.col("is_anchor")).alias("_rows"))
    per = per.withColumn("_b", F.lead("a._v").over(W.partitionBy(*group).orderBy("_seg")))
    return per.where(F.col("_b") - F.col("a._v") - 1 > F.col("_rows")).select(*group, "a._p", "a._v", "_b", *(f"a.{c}" for c in carry))


def pieces(holes: DataFrame, group: Sequence[str], number: str, text: str, every: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """Records found in the texts of the anchors of gaps(), see buried()."""
    ids = F.sequence(F.col("_v") + 1, F.col("_b") - 1)
    at = F.transform(ids, lambda i: F.struct(F.regexp_instr(F.coalesce(F.col(text), F.lit("")), F.concat(F.lit(r"(?iUu)(?<!\d)"), i.cast("string"), F.lit(r"\s*\.?\s*-?\s*Libro\s+del\s+a"))).alias("desde"), i.alias("id")))
    hits = F.filter(at, lambda x: x["desde"] > 0)
    per = holes.withColumn("_found", F.array_sort(hits if every else F.slice(hits, 1, 1)))
    each = per.select(*group, *carry, F.col("_p").alias("orden"), F.col(text).alias("_t"), "_found", F.posexplode("_found").alias("_i", "_x"))
    stop = F.coalesce(F.get(F.col("_found"), F.col("_i") + 1)["desde"], F.length("_t") + 1)
    return each.select(*group, *carry, "orden", (F.col("_i") + 2).alias("sub"), F.col("_x.id").alias(number), F.rtrim(F.substr("_t", F.col("_x.desde"), stop - F.col("_x.desde"))).alias(text), F.col("_x.desde").alias("desde"))


def buried(df: DataFrame, group: Sequence[str] = ("tomo_id",), pos: str = "pos", number: str = "id_num", text: str = "texto_completo", every: bool = False) -> DataFrame:
    """Rows for records whose number was lost because their text stands in the record before: group, orden, sub, id_num,
    texto_completo and desde, where in the anchor's text (from 1) the text began.

    For each pair of anchors with more missing numbers than rows between, each missing number is looked for in the
    first anchor's text as "88. Libro del a...". The first missing number that is found counts; with ``every`` all do, and
    each reaches to the next.
    """
    return pieces(gaps(df, group, pos, number, text), group, number, text, every)


def text_before(text: str, start: str) -> Column:
    """What is left of a text when what begins at ``start`` (from 1) is taken out; the whole where that is null."""
    return F.when(F.col(start).isNotNull(), F.regexp_replace(F.substr(F.col(text), F.lit(1), F.col(start) - 1), r"\s+$", "")).otherwise(F.col(text))


def resegment(df: DataFrame, group: Sequence[str] = ("tomo_id",), pos: str = "pos", number: str = "id_num", text: str = "texto_completo") -> DataFrame:
    """``df`` with buried records as rows of their own (status resegmentado), the text before them cut and parsed anew."""
    base = df if "id_status" in df.columns else df.withColumn("id_status", F.lit(""))
    found = buried(base, group, pos, number, text)
    first = found.groupBy(*group, "orden").agg(F.min("desde").alias("_cut"))
    on = F.col(f"d.{pos}") == F.col("f.orden")
    for g in group:
        on &= F.col(f"d.{g}").eqNullSafe(F.col(f"f.{g}"))
    cut = base.alias("d").join(first.alias("f"), on, "left").select("d.*", "f._cut")
    cut = cut.withColumn(text, text_before(text, "_cut")).drop("_cut")
    fresh = found.select(*group, F.col("orden").alias(pos), "sub", number, text, F.lit("resegmentado").alias("id_status"))
    both = cut.withColumn("sub", F.lit(1)).unionByName(fresh, allowMissingColumns=True)
    return parse_text(both, text)
