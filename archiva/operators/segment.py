"""Pages cut into records by their ink profile, over arrays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archiva.functions.quality import flags
from archiva.functions.text import let

GAP = "array<struct<a:int,b:int>>"


def smooth(profile: Column, k: int = 11) -> Column:
    """Moving sums over k rows divided by k; rows beyond the edges count as zero."""
    n, h = F.size(profile), k // 2
    at = F.transform(profile, lambda x, i: i)
    return F.transform(at, lambda i: F.aggregate(F.slice(profile, F.greatest(i - h, F.lit(0)) + 1, F.least(i + h, n - 1) - F.greatest(i - h, F.lit(0)) + 1), F.lit(0.0), lambda s, x: s + x) / F.lit(float(k)))


def find_gaps(profile: Column, share: float = 0.05, least: int = 10) -> Column:
    """Runs of rows at or below a share of the highest, at least so long; ends exclusive, one at the end included."""

    def scan(p: Column, low: Column) -> Column:
        zero = F.struct(F.lit(-1).alias("s"), F.array().cast(GAP).alias("g"))
        step = lambda acc, xi: F.struct(
            F.when(xi["x"] <= low, F.when(acc["s"] < 0, xi["i"]).otherwise(acc["s"])).otherwise(F.lit(-1)).alias("s"),
            F.when((xi["x"] > low) & (acc["s"] >= 0) & (xi["i"] - acc["s"] >= least), F.array_append(acc["g"], F.struct(acc["s"].alias("a"), xi["i"].alias("b")))).otherwise(acc["g"]).alias("g"),
        )
        close = lambda acc: F.when((acc["s"] >= 0) & (F.size(p) - acc["s"] >= least), F.array_append(acc["g"], F.struct(acc["s"].alias("a"), F.size(p).alias("b")))).otherwise(acc["g"])
        return F.aggregate(F.transform(p, lambda x, i: F.struct(x.cast("double").alias("x"), i.alias("i"))), zero, step, close)

    return let(profile, lambda p: let(F.array_max(p) * share, lambda low: scan(p, low)))


def inside_margins(gaps: Column, height: Column, top: float = 0.06, bottom: float = 0.08) -> Column:
    return F.filter(gaps, lambda g: (g["a"] >= F.floor(height * top)) & (g["b"] <= F.floor(height * (1 - bottom))))


def merge_gaps(gaps: Column, profile: Column, bridge: int = 30, share: float = 0.10) -> Column:
    """Gaps with a short, light bridge between them made one."""

    def step(acc: Column, g: Column, most: Column) -> Column:
        last = F.element_at(acc, -1)
        width = g["a"] - last["b"]
        light = F.array_max(F.slice(profile, last["b"] + 1, F.greatest(width, F.lit(1)))) <= most
        join = (width > 0) & (width <= bridge) & light
        one = F.array_append(F.slice(acc, 1, F.size(acc) - 1), F.struct(last["a"].alias("a"), g["b"].alias("b")))
        return F.when(F.size(acc) == 0, F.array(g)).when(join, one).otherwise(F.array_append(acc, g))

    return let(F.array_max(profile) * share, lambda most: F.aggregate(gaps, F.array().cast(GAP), lambda acc, g: step(acc, g, most)))


def quantile(values: Column, q: float) -> Column:
    """Linear interpolation between order statistics."""

    def of(s: Column) -> Column:
        at = (F.size(s) - 1) * F.lit(q)
        lo, hi = F.get(s, F.floor(at).cast("int")), F.get(s, F.ceil(at).cast("int"))
        return lo + (hi - lo) * (at - F.floor(at))

    return let(F.array_sort(values), of)


def tall_gaps(gaps: Column, least: int = 2, jump: float = 0.5) -> Column:
    """Gaps above the first jump in height; without one those above the 60th percentile, or the 40th if few are left."""
    heights = F.array_sort(F.transform(gaps, lambda g: (g["b"] - g["a"]).cast("double")))

    def choose(h: Column) -> Column:
        pairs = F.zip_with(F.slice(h, F.lit(1), F.greatest(F.size(h) - 1, F.lit(0))), F.slice(h, F.lit(2), F.greatest(F.size(h) - 1, F.lit(0))), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
        first = F.get(F.filter(pairs, lambda p: (p["x"] > 0) & ((p["y"] - p["x"]) / p["x"] >= jump)), F.lit(0))
        cut = F.coalesce((first["x"] + first["y"]) / 2, quantile(h, 0.6))
        kept = F.filter(gaps, lambda g: (g["b"] - g["a"]) >= cut)
        lower = quantile(h, 0.4)
        return F.when((F.size(kept) < least) & (F.size(gaps) >= least), F.filter(gaps, lambda g: (g["b"] - g["a"]) >= lower)).otherwise(kept)

    return F.when(F.size(gaps) <= 1, gaps).otherwise(let(heights, choose))


def rescue_last(kept: Column, raw: Column, end: Column, least: int = 10, tail: int = 350, overlap: int = 120) -> Column:
    """A gap that runs into the footer cuts a long last part off."""
    last = F.coalesce(F.try_element_at(kept, F.lit(-1))["b"], F.lit(0))
    fit = F.filter(raw, lambda g: (g["a"] > last) & (g["a"] < end) & (g["b"] > end) & (end - g["a"] >= max(least, overlap)))
    start = F.array_max(F.transform(fit, lambda g: g["a"]))
    return F.when((end - last >= tail) & start.isNotNull(), F.array_append(kept, F.struct(start.alias("a"), end.cast("int").alias("b")))).otherwise(kept)


def refine(gaps: Column, small: int = 55, many: int = 10, share: float = 0.45) -> Column:
    """gaps and refined: of very many gaps, mostly small, only the tall ones are kept, if four or more are left."""

    def choose(h: Column) -> Column:
        cut = F.greatest(F.lit(float(small)), quantile(h, 0.6))
        tall = F.filter(gaps, lambda g: (g["b"] - g["a"]) >= cut)
        crowded = (F.size(h) >= many) & (F.size(F.filter(h, lambda x: x < small)) / F.size(h) >= share) & (F.size(tall) >= 4)
        return F.struct(F.when(crowded, tall).otherwise(gaps).alias("gaps"), F.coalesce(crowded, F.lit(False)).alias("refined"))

    return let(F.transform(gaps, lambda g: (g["b"] - g["a"]).cast("double")), choose)


def between(gaps: Column, start: Column, end: Column, least: int = 60) -> Column:
    """The parts of a zone that no gap covers, those of some height."""
    zero = F.struct(start.cast("int").alias("p"), F.array().cast(GAP).alias("s"))
    step = lambda acc, g: F.struct(g["b"].alias("p"), F.when(g["a"] > acc["p"], F.array_append(acc["s"], F.struct(acc["p"].alias("a"), g["a"].alias("b")))).otherwise(acc["s"]).alias("s"))
    close = lambda acc: F.when(acc["p"] < end, F.array_append(acc["s"], F.struct(acc["p"].alias("a"), end.cast("int").alias("b")))).otherwise(acc["s"])
    return F.filter(F.aggregate(gaps, zero, step, close), lambda s: s["b"] - s["a"] >= least)


def segment_pages(df: DataFrame, profile: str = "profile", top: float = 0.06, bottom: float = 0.08, least_gap: int = 10) -> DataFrame:
    """``df`` with gaps, segments and the diagnosis of each page from its ink profile.

    Needs footer_density and small_components for the diagnosis; where they are missing they count as 0. Null and empty
    profiles have no segments. Every stage is a column of its own.
    """
    for c in ("footer_density", "small_components"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(0.0))
    d = df.withColumn("_p", smooth(F.coalesce(F.col(profile), F.array()))).withColumn("_h", F.size("_p"))
    d = d.withColumn("_end", F.floor(F.col("_h") * (1 - bottom)).cast("int")).withColumn("_raw", find_gaps(F.col("_p"), least=least_gap))
    d = d.withColumn("_zone", inside_margins(F.col("_raw"), F.col("_h"), top, bottom)).withColumn("_merged", merge_gaps(F.col("_zone"), F.col("_p"))).withColumn("_tall", tall_gaps(F.col("_merged")))
    d = d.withColumn("_r", refine(rescue_last(F.col("_tall"), F.col("_raw"), F.col("_end"), least_gap)))
    d = d.withColumn("gaps", F.coalesce("_r.gaps", F.array().cast(GAP))).withColumn("segments", between(F.col("gaps"), F.floor(F.col("_h") * top), F.col("_end")))
    sizes = F.transform("segments", lambda s: (s["b"] - s["a"]).cast("double"))
    d = d.withColumn("_med", F.coalesce(quantile(sizes, 0.5), F.lit(0.0))).withColumn("_last", F.coalesce(F.try_element_at(sizes, F.lit(-1)), F.lit(0.0)))
    ratio = F.when(F.col("_med") > 0, F.col("_last") / F.col("_med")).otherwise(0.0)
    found = flags(
        ("n_segmentos_atipico", (F.size("segments") < 4) | (F.size("segments") > 9)), ("ultimo_segmento_grande", ratio >= 1.8), ("footer_con_tinta", F.col("footer_density") >= 0.025), ("ruido_residual", F.col("small_components") >= 1200),
        ("muy_pocos_gaps", F.size("gaps") <= 2), ("refinamiento_adaptativo", F.coalesce("_r.refined", F.lit(False))),
    )
    d = d.withColumn("diagnostico_flags", found).withColumn("diagnostico_score", F.size("diagnostico_flags"))
    state = F.when(F.col("diagnostico_score") >= 4, "probable_mal_escaneo").when(F.col("diagnostico_score") >= 2, "revisar").otherwise("ok")
    return d.withColumn("diagnostico_estado", state).select(*df.columns, "gaps", "segments", F.array_join("diagnostico_flags", "; ").alias("diagnostico_flags"), "diagnostico_score", "diagnostico_estado")


def ink_extent(columns: Column, height: Column, margin: int = 0) -> Column:
    """First and last column with more ink than two pixels and two per cent of the height, widened by a margin."""
    least = F.greatest(F.lit(2.0), height * 0.02)
    at = F.filter(F.transform(columns, lambda x, i: F.when(x > least, i)), lambda i: i.isNotNull())
    n = F.size(columns)
    return F.struct(F.greatest(F.lit(0), F.coalesce(F.array_min(at), F.lit(0)) - margin).alias("x0"), F.least(n, F.coalesce(F.array_max(at) + 1, n) + margin).alias("x1"))
