"""Quality figures and flags of recognised text, as Columns."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archiva.functions.text import blank, lines, strip, sub

# Scripts that do not belong in these volumes.
FOREIGN = r"[\u0900-\u097F\u4E00-\u9FFF\u3040-\u309F\u30A0-\u30FF\uAC00-\uD7AF]"


def letters(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"[^\p{L}]", ""))


def alpha_ratio(c: Column) -> Column:
    """Share of letters; 0 for blank texts."""
    return F.when(blank(c), F.lit(0.0)).otherwise(letters(c) / F.length(c))


def foreign_chars(c: Column) -> Column:
    return F.when(blank(c), F.lit(0)).otherwise(F.regexp_count(c, F.lit(FOREIGN)))


def repeated_lines(c: Column) -> Column:
    """Lines that are there already, blank ones aside."""
    return F.coalesce(F.size(lines(c)) - F.size(F.array_distinct(lines(c))), F.lit(0))


def metrics(c: Column) -> Column:
    """largo, ratio_alfa (three decimals), chars_no_latino, lineas_repetidas; zeros for blank and null texts."""
    size = F.when(blank(c), F.lit(0)).otherwise(F.length(c))
    repeated = F.when(blank(c), F.lit(0)).otherwise(repeated_lines(c))
    return F.struct(size.alias("largo"), F.bround(alpha_ratio(c), 3).alias("ratio_alfa"), foreign_chars(c).alias("chars_no_latino"), repeated.alias("lineas_repetidas"))


def flags(*pairs: tuple[str, Column]) -> Column:
    return F.array_compact(F.array(*(F.when(cond, F.lit(name)) for name, cond in pairs)))


def page_flags(m: Column, median: Column) -> Column:
    """Flags of a page from its metrics and the median length of its volume (1 if unknown)."""
    med = F.coalesce(median, F.lit(1.0))
    r = F.when(med > 0, m["largo"] / med)
    return flags(
        ("bajo_alfa", m["ratio_alfa"] < 0.40), ("script_no_latino", m["chars_no_latino"] > 0), ("texto_repetitivo", m["lineas_repetidas"] > 5), ("muy_corto", r < 0.1), ("muy_largo", r > 5)
    )


def contract_flags(c: Column) -> Column:
    """Flags of a record's text; the share of letters is not rounded here."""
    found = flags(("bajo_alfa", alpha_ratio(c) < 0.40), ("script_no_latino", c.rlike(FOREIGN)), ("texto_repetitivo", repeated_lines(c) > 5), ("muy_corto", F.length(c) < 80))
    return F.when(blank(c), F.array(F.lit("vacio"))).otherwise(found)


def output_flags(c: Column, version: int = 1) -> Column:
    """Flags of a recogniser's output; version 2 also knows outputs that are only tags."""
    s = strip(F.coalesce(c, F.lit("")))
    bare = strip(sub(sub(s, r"<\|[^|]*\|>"), r"\[\[\d[\d,\s]*\]\]"))
    n = F.size(lines(s))
    tests = [
        ("muy_corto", F.length(s) < 50), ("bajo_alfa", (F.length(s) > 20) & (letters(s) / F.length(s) < 0.3)), ("texto_repetitivo", (n > 5) & (repeated_lines(s) / n > 0.5)), ("chars_no_latino", s.rlike(FOREIGN)),
    ]
    if version == 2:
        tests.insert(0, ("solo_tags", F.length(bare) < 20))
    return F.when(blank(c), F.array(F.lit("vacio"))).otherwise(flags(*tests))


def is_valid(found: Column, version: int = 1) -> Column:
    """Foreign scripts and shortness are warnings only."""
    bad = ["vacio", "bajo_alfa", "texto_repetitivo"] + (["solo_tags"] if version == 2 else [])
    return ~F.arrays_overlap(found, F.array(*map(F.lit, bad)))


def output_metrics(c: Column) -> Column:
    """chars, lineas, ratio_alfa, valido, flags of an output."""
    s = strip(F.coalesce(c, F.lit("")))
    f = output_flags(c, 2)
    ratio = F.when(F.length(s) > 0, F.bround(letters(s) / F.length(s), 3)).otherwise(F.lit(0.0))
    return F.struct(F.length(s).alias("chars"), F.size(lines(s)).alias("lineas"), ratio.alias("ratio_alfa"), is_valid(f, 2).alias("valido"), F.array_join(f, "; ").alias("flags"))


def ratio(a: str | None, b: str | None) -> float:
    """Ratcliff-Obershelp similarity; 1 if both texts are blank, 0 if one is."""
    from difflib import SequenceMatcher

    x, y = (a or "").strip(), (b or "").strip()
    return 1.0 if not x and not y else 0.0 if not x or not y else SequenceMatcher(None, x, y).ratio()


def with_similarity(df: DataFrame, left: str, right: str, out: str) -> DataFrame:
    """``df`` with the similarity of two text columns; no built-in function gives this measure."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = zip(b.column(names.index(left)).to_pylist(), b.column(names.index(right)).to_pylist(), strict=True)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([ratio(x, y) for x, y in pairs], pa.float64())], names=[*names, out])

    return df.mapInArrow(run, f"{schema}, `{out}` double")
