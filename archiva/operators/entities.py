"""Entities of a record: by rules and lists, from a model's answer, applied to records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archiva.functions.text import blank, let, rx, strip

# Kinds of record by the words that tell them, the first that matches holds.
TYPES = [
    ("poder", r"\b(otorga poder|otorgan poder)\b"), ("obligacion", r"\b(se obliga|se obligan)\b"), ("fletamento", r"\b(contrato de fletamento|fletamento entre)\b"), ("declaracion", r"\b(declara|declaración)\b"),
    ("compraventa", r"\b(vende|compra|compraventa)\b"), ("cobro", r"\b(carta de pago|finiquito)\b"), ("concierto", r"\b(se compromete|concierto)\b"), ("capitulacion", r"\b(capitulación)\b"), ("testamento", r"\b(testamento)\b"), ("confirmacion", r"\b(confirmación)\b"),
]
# Phrases that persons stand in.
PERSON_PATTERNS = [
    r"(?:otorga|otorgan)\s+poder\s+a\s+([^,\.;]+)", r"(?:se\s+obliga|se\s+obligan)\s+([^,\.;]+?)(?:\s+a\s+|,|;|$)", r"(?:le\s+vende|compra|de\s+)?([A-Z][a-záéíóú]+(?:\s+[A-Z][a-záéíóú]+)?)\s+(?:vecino|maestre|escribano|notario)",
    r"(?:maestre|maestres)\s+(?:de\s+la\s+nao\s+)?([A-Z][a-záéíóú]+(?:\s+[A-Z][a-záéíóú]+)?)", r"(?:poder|procurador)\s+(?:de\s+)?([A-Z][a-záéíóú]+(?:\s+[A-Z][a-záéíóú]+)?)",
]
FIELDS = ["gentilicio", "vecindad", "oficio", "relacion"]
PAYLOAD = "tipo string, personas array<string>, naos array<string>, lugares array<string>, atributos map<string,struct<gentilicio:string,vecindad:string,oficio:string,relacion:string>>"


def record_type(c: Column) -> Column:
    """The kind of a record by its text, otros if no rule matches."""
    out = F.lit("otros")
    for name, pattern in reversed(TYPES):
        out = F.when(F.coalesce(c, F.lit("")).rlike(rx(pattern, "i")), name).otherwise(out)
    return out


def mentioned(c: Column, names: Sequence[str]) -> Column:
    """Names of a list that occur in a text, in any case and inside other words too; sorted."""
    low = F.lower(F.coalesce(c, F.lit("")))
    return F.array_sort(F.filter(F.array(*map(F.lit, names)), lambda n: F.contains(low, F.lower(n)))) if names else F.array().cast("array<string>")


def persons_by_phrase(c: Column) -> Column:
    """Names in the places where phrases have persons."""
    t = F.coalesce(c, F.lit(""))
    found = F.concat(*(F.regexp_extract_all(t, F.lit(rx(p, "i")), F.lit(1)) for p in PERSON_PATTERNS))
    return F.filter(F.transform(found, strip), lambda x: F.length(x) > 2)


def persons_by_list(c: Column, given: Sequence[str], surnames: Sequence[str]) -> Column:
    """Given name and surname of the lists side by side: one pattern for all pairs, spelled as in the lists."""
    if not given or not surnames:
        return F.array().cast("array<string>")
    either = lambda xs: "|".join(sorted(xs, key=len, reverse=True))
    pattern = rf"\b({either(given)})\s+({either(surnames)})\b"
    canon = F.create_map(*[F.lit(x) for w in {*given, *surnames} for x in (w.lower(), w)])
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(rx(pattern, "i")), F.lit(0))
    words = lambda m: F.split(F.lower(m), rx(r"\s+"))
    return F.transform(found, lambda m: F.concat_ws(" ", *(F.coalesce(F.try_element_at(canon, F.get(words(m), F.lit(i))), F.get(words(m), F.lit(i))) for i in (0, 1))))


def persons(c: Column, given: Sequence[str], surnames: Sequence[str]) -> Column:
    """Both ways together: distinct, sorted, over three characters, without doubtful ones."""
    both = F.array_distinct(F.concat(persons_by_phrase(c), persons_by_list(c, given, surnames)))
    return F.array_sort(F.filter(both, lambda x: (F.length(x) > 3) & ~x.startswith("?")))


def json_in_prose(c: Column, fallback: Column | None = None) -> Column:
    """The widest {...} of a model's answer, or of its reasoning."""
    take = lambda x: F.nullif(F.regexp_extract(F.coalesce(x, F.lit("")), r"(?s)\{.*\}", 0), F.lit(""))
    return take(c) if fallback is None else F.coalesce(take(c), take(fallback))


def _strings(v: Column) -> Column:
    """The text items of a JSON list that are no numbers, marks or nests; stripped, blanks dropped."""
    items = F.from_json(v, "array<variant>")
    texts = F.filter(items, lambda x: F.schema_of_variant(x) == "STRING")
    return F.coalesce(F.filter(F.transform(texts, lambda x: strip(x.cast("string"))), lambda x: x != ""), F.array())


def normalize_payload(c: Column) -> Column:
    """A model's JSON as a struct: tipo (otros if missing), lists of texts, attributes of listed persons only.

    A plain text as a person's attributes is the relation. Broken JSON gives otros and empty lists.
    """
    none = F.create_map().cast("map<string,string>")

    def whole(d: Column) -> Column:
        get = lambda k: F.try_element_at(d, F.lit(k))
        tipo = F.lower(strip(F.coalesce(get("tipo"), F.lit(""))))

        def with_persons(people: Column) -> Column:
            attributes = let(F.coalesce(F.from_json(get("atributos"), "map<string,string>"), none), lambda raw: of_persons(raw, people))
            return F.struct(F.when(tipo == "", "otros").otherwise(tipo).alias("tipo"), people.alias("personas"), _strings(get("naos")).alias("naos"), _strings(get("lugares")).alias("lugares"), attributes.alias("atributos"))

        return let(_strings(get("personas")), with_persons)

    def of_persons(raw: Column, people: Column) -> Column:
        def attrs(p: Column) -> Column:
            v = F.trim(F.coalesce(F.try_element_at(raw, p), F.lit("")))
            nested = F.coalesce(F.from_json(v, "map<string,string>"), none)
            fields = [F.when(v.startswith("{"), strip(F.coalesce(F.try_element_at(nested, F.lit(f)), F.lit("")))).otherwise(strip(v) if f == "relacion" else F.lit("")).alias(f) for f in FIELDS]
            return F.struct(*fields)

        listed = F.filter(F.array_distinct(people), lambda p: F.map_contains_key(raw, p))
        return F.map_from_arrays(listed, F.transform(listed, attrs))

    return let(F.coalesce(F.from_json(c, "map<string,string>"), none), whole)


def flatten_payload(df: DataFrame, payload: str) -> DataFrame:
    """The payload's parts as text columns: lists joined by "; ", attributes as JSON."""
    p = F.col(payload)
    keep = [c for c in df.columns if c not in {payload, "tipo", "personas", "naos", "lugares", "atributos"}]
    lists = [F.array_join(p[c], "; ").alias(c) for c in ("personas", "naos", "lugares")]
    return df.select(*keep, p["tipo"].alias("tipo"), *lists, F.when(F.size(p["atributos"]) > 0, F.to_json(p["atributos"])).otherwise("").alias("atributos"))


def apply_extractions(df: DataFrame, new: DataFrame, key: str, fields: Sequence[str] = ("tipo", "personas", "naos", "lugares", "atributos")) -> tuple[DataFrame, DataFrame]:
    """``df`` with the fields of ``new`` where its key occurs there (missing ones blank), and the rows of ``new`` without a
    record. Of several rows of ``new`` with one key the greatest holds."""
    one = new.groupBy(key).agg(F.max(F.struct(*(F.coalesce(F.col(f), F.lit("")).alias(f) if f in new.columns else F.lit("").alias(f) for f in fields))).alias("_n"))
    j = df.alias("d").join(one.alias("n"), key, "left")
    out = j.select(*(F.when(F.col("_n").isNotNull(), F.col(f"_n.{c}")).otherwise(F.col(f"d.{c}")).alias(c) if c in fields else F.col(c) for c in df.columns))
    return out, new.join(df.select(key), key, "left_anti")


def resume(todo: DataFrame, done: DataFrame, key: str, text: str) -> DataFrame:
    """Rows still to do: those without a finished text."""
    return todo.join(done.where(~blank(F.col(text))).select(key), key, "left_anti")
