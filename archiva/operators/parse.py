"""Fields of a record's text, parsed by labels that may be misread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archiva.functions.text import blank, clean_value, rx

# Patterns of the start, the labels and the parts of a record, tolerant of misread letters.
SEP = r"[\s.—–\-,;]"
START_CORE = r"br[oió]\s+[d1.]*[elé!.]+\s+\.?\s*a[ñn—]+[oó]\s*[:.;]?\s*"
START = r"[\w.]{0,5}" + START_CORE
START_LOOSE = r"\b[d1.][elé!.]+\s+\.?\s*a[ñn—]+[oó]\s*[:.;]?\s*"
SUBJECT = SEP + r"+A[su][uú]n[^\s:;]{0,2}o\s*[;:]\s*"
SUBJECT_LOOSE = SEP + r"+A[su][uú]n[^\s:;]{0,2}o\s+"
NOTES = SEP + r"+Observaciones\s*[;:]\s*"
LABELS = {
    "oficio": SEP + r"+O[fl]icio\s*[;:]?\s*", "escribania": SEP + r"+Esc[ri]i?[rb]an[íifa]a\s*[;:]?\s*", "folio": SEP + r"+Fol[ií—j]o\s*[;:]?\s*",
    "fecha": SEP + r"+F[eé]cha\s*[;:]?\s*", "signatura": SEP + r"+Signatura\s*[;:]?\s*",
}
SUBBOOK = r"\bLibro\s*:?\s*([IVX]+|[Úú]nico|único)\b"
YEAR = r"\b(\d{4})\b"

FIELDS = ["macrodatos", "anio", "oficio", "libro", "escribania", "folio", "fecha", "signatura", "asunto", "observaciones"]


def _match(c: Column, pattern: str) -> Column:
    """The first match, '' without one."""
    return F.regexp_extract(c, rx(pattern, "i"), 0)


def _place(c: Column, match: Column) -> Column:
    """start and end (0-based, end exclusive) of a match in ``c``; null for ''.

    The pattern must look at nothing outside its match: then no equal text stands before the match, so it is found
    by its text, and the pattern is tried once.
    """
    at = F.position(match, c)
    return F.when(match != "", F.struct((at - 1).alias("start"), (at - 1 + F.length(match)).alias("end")))


def _place_by_pattern(c: Column, pattern: str) -> Column:
    """The like for a pattern that also looks at what stands before its match."""
    lit = F.lit(rx(pattern, "i"))
    at = F.regexp_instr(c, lit)
    return F.when(at > 0, F.struct((at - 1).alias("start"), (at - 1 + F.length(F.regexp_substr(c, lit))).alias("end")))


def _cut(c: Column, start: Column, end: Column | None = None) -> Column:
    rest = F.substr(c, start + 1)
    return rest if end is None else F.substr(c, start + 1, F.greatest(end - start, F.lit(0)))


def count_subrecords(c: Column) -> Column:
    """Record starts in a text, one at least. What may stand before START_CORE changes no count."""
    strict, loose = (F.regexp_count(F.coalesce(c, F.lit("")), F.lit(rx(p, "i"))) for p in (START_CORE, START_LOOSE))
    return F.greatest(F.lit(1), strict, F.when(strict == 0, loose))


def parse_text(df: DataFrame, text: str) -> DataFrame:
    """``df`` with FIELDS, anio_num, n_subregistros and _parse_ok from ``text``; columns of these names are replaced.

    Texts without a start are all asunto and not ok; null and blank texts give '' everywhere. Each stage is a column
    of its own, so that Catalyst evaluates no pattern twice.
    """
    keep = [c for c in df.columns if c not in {*FIELDS, "anio_num", "n_subregistros", "_parse_ok"}]
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    d = df.select(*keep, t.alias("_t")).withColumn("_m", _match(F.col("_t"), START))
    d = d.withColumn("_s", F.coalesce(_place(F.col("_t"), F.col("_m")), _place_by_pattern(F.col("_t"), START_LOOSE)))
    d = d.withColumn("_after", F.when(F.col("_s").isNotNull(), _cut(F.col("_t"), F.col("_s.end"))))
    d = d.withColumn("_m", _match(F.col("_after"), SUBJECT))
    d = d.withColumn("_m", F.when(F.col("_m") == "", _match(F.col("_after"), SUBJECT_LOOSE)).otherwise(F.col("_m")))
    d = d.withColumn("_a", _place(F.col("_after"), F.col("_m")))
    d = d.withColumn("_head", F.when(F.col("_a").isNotNull(), F.substr("_after", F.lit(1), F.col("_a.start"))).otherwise(F.col("_after")))
    d = d.withColumn("_body", F.when(F.col("_a").isNotNull(), _cut(F.col("_after"), F.col("_a.end"))).otherwise(F.lit("")))
    d = d.withColumns({"_m": _match(F.col("_body"), NOTES)} | {f"_m_{n}": _match(F.col("_head"), p) for n, p in LABELS.items()})
    d = d.withColumns({"_o": _place(F.col("_body"), F.col("_m"))} | {f"_at_{n}": _place(F.col("_head"), F.col(f"_m_{n}")) for n in LABELS})
    found = F.array_compact(F.array(*(F.when(m.isNotNull(), F.struct(m["start"].alias("start"), m["end"].alias("end"), F.lit(n).alias("name"))) for n in LABELS for m in [F.col(f"_at_{n}")])))
    d = d.withColumn("_l", F.sort_array(found))

    def value(name: str) -> Column:
        at = F.array_position(F.col("_l")["name"], name)
        stop = F.coalesce(F.get(F.col("_l"), at.cast("int"))["start"], F.length("_head"))
        return F.when(at > 0, clean_value(_cut(F.col("_head"), F.col(f"_at_{name}")["end"], stop))).otherwise(F.lit(""))

    year = F.when(F.size("_l") > 0, F.substr("_head", F.lit(1), F.get(F.col("_l"), F.lit(0))["start"])).otherwise(F.col("_head"))
    ok = F.col("_s").isNotNull()
    d = d.withColumns({f"_{n}": value(n) for n in LABELS} | {"_year": clean_value(year)})
    d = d.withColumn("_sub", F.regexp_extract("_oficio", rx(SUBBOOK, "i"), 1))
    office, subbook = F.col("_oficio"), F.col("_sub")
    out = {
        "macrodatos": clean_value(F.substr("_t", F.col("_s.start") + 1, F.col("_s.end") - F.col("_s.start") + F.length("_head"))), "anio": F.col("_year"),
        "oficio": F.when(subbook != "", clean_value(F.regexp_replace(office, rx(SUBBOOK, "i"), ""))).otherwise(office), "libro": F.when(subbook != "", F.concat(F.lit("Libro "), subbook)).otherwise(F.lit("")),
        **{n: F.col(f"_{n}") for n in ("escribania", "folio", "fecha", "signatura")},
        "asunto": clean_value(F.when(F.col("_o").isNotNull(), F.substr("_body", F.lit(1), F.col("_o.start"))).otherwise(F.col("_body"))), "observaciones": F.when(F.col("_o").isNotNull(), clean_value(_cut(F.col("_body"), F.col("_o.end")))).otherwise(F.lit("")),
    }
    cols = [F.coalesce(F.when(ok, out[n]), clean_value(F.col("_t")) if n == "asunto" else F.lit("")).alias(n) for n in FIELDS]
    number = F.regexp_extract("_year", rx(YEAR), 1)
    return d.select(
        *keep, *cols, F.when(ok, F.nullif(number, F.lit("")).try_cast("bigint")).alias("anio_num"), F.when(blank(F.col("_t")), F.lit(1)).otherwise(count_subrecords(F.col("_t"))).alias("n_subregistros"),
        F.coalesce(ok & (F.col("_year") != ""), F.lit(False)).alias("_parse_ok"),
    )


def parse_report(df: DataFrame) -> DataFrame:
    """One row: records, parsed, fused, and how many have each field."""
    filled = [F.count_if(F.length(c) > 0).alias(f"con_{c}") for c in FIELDS]
    return df.agg(F.count("*").alias("n"), F.count_if("_parse_ok").alias("n_ok"), F.count_if(F.col("n_subregistros") > 1).alias("n_fusionados"), F.count("anio_num").alias("con_anio_num"), *filled)
