"""The long panel: a row per entity of a record, with attributes and codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from archiva.functions.text import blank, record_code, split_list, strip, volume_code

ATTRIBUTES = ["gentilicio", "vecindad", "ocupacion", "relacion"]
CODES = ["idtomo", "idcont", "idtomocont", "idper", "idnao", "idlug", "idtomocontper", "idtomocontnao", "idtomocontlug"]


def _attrs(gentilicio: Column, vecindad: Column, ocupacion: Column, relacion: Column) -> Column:
    """The four attributes; what is no text, null included, is ''."""
    cols = dict(zip(ATTRIBUTES, (gentilicio, vecindad, ocupacion, relacion), strict=True))
    return F.struct(*(strip(F.coalesce(c, F.lit(""))).alias(n) for n, c in cols.items()))


def attributes(c: Column) -> Column:
    """Map of person to attributes, from JSON {person: {...}} or text "name::words || name::words"; broken text gives none.

    In JSON a plain string is the relation and an empty ocupacion is filled from oficio.
    """
    none = F.lit("")
    raw = F.map_entries(F.from_json(c, "map<string,string>"))

    def one(kv: Column) -> Column:
        v = F.trim(kv["value"])
        d = F.from_json(v, "map<string,string>")
        get = lambda k: F.coalesce(F.try_element_at(d, F.lit(k)), none)
        job = F.when(get("ocupacion") != "", get("ocupacion")).otherwise(get("oficio"))
        nested = v.startswith("{")
        return F.struct(strip(kv["key"]).alias("key"), F.when(nested, _attrs(get("gentilicio"), get("vecindad"), job, get("relacion"))).otherwise(_attrs(none, none, none, F.when(v.startswith("["), none).otherwise(kv["value"]))).alias("value"))

    legacy = F.filter(F.transform(F.split(c, r"\|\|"), lambda p: F.struct(strip(F.split_part(p, F.lit("::"), F.lit(1))).alias("key"), _attrs(none, none, none, F.split_part(p, F.lit("::"), F.lit(2))).alias("value"))), lambda x: x["key"] != "")
    entries = F.when(blank(c), F.array().cast(f"array<struct<key:string,value:struct<{','.join(f'{a}:string' for a in ATTRIBUTES)}>>>")).when(strip(c).startswith("{"), F.coalesce(F.transform(raw, one), F.array())).otherwise(legacy)
    # the last of several entries of one name holds
    keys = F.transform(entries, lambda x: x["key"])
    last = F.filter(entries, lambda x, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), x["key"]))
    return F.map_from_entries(last)


def place_in(df: DataFrame, by: str, order: str, out: str = "orden", step: int = 10_000) -> DataFrame:
    """``df`` with ``out``, the place of each row (from 1) among those of one value of ``by``, in ``order``.

    ``order`` is a unique whole number. Ranges of ``step`` numbers are ranked by themselves, and what lies before a range
    is added, so that a volume with a third of all rows is not sorted in one task. Null values of ``by`` are one.
    """
    d = df.withColumn("_part", F.floor(F.col(order) / step))
    within = W.partitionBy(by, "_part").orderBy(order)
    d = d.withColumn("_in", F.row_number().over(within))
    sizes = d.groupBy(F.col(by).alias("_by"), F.col("_part").alias("_p")).agg(F.count("*").alias("_n"))
    before = W.partitionBy("_by").orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("_by", "_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    j = d.join(sizes, F.col(by).eqNullSafe(F.col("_by")) & F.col("_part").eqNullSafe(F.col("_p")))
    return j.select(*df.columns, (F.col("_before") + F.col("_in")).alias(out))


def project(df: DataFrame, columns: Sequence[str], default: object = "") -> DataFrame:
    """The columns in this order; those that ``df`` lacks hold ``default``."""
    return df.select(*((F.col(c) if c in df.columns else F.lit(default).alias(c)) for c in columns))


def available(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Those of the columns that ``df`` has, in this order."""
    return df.select(*(c for c in columns if c in df.columns))


def panelize(df: DataFrame, order: str = "contrato_idx") -> DataFrame:
    """A row per entity of each record: persons, then ships, then places; a record without any gives one blank row.

    Adds contrato_idx of ``order``, tipo_entidad, pos_entidad (0 in blank rows), entidad, ATTRIBUTES and CODES; columns of these names
    are replaced. Codes: volume (2 digits or more), record (4 or more, its number or else its place among the records of
    its volume in ``order``), entity in its kind (2 or more).
    """
    drop = {"tipo_entidad", "pos_entidad", "entidad", *ATTRIBUTES, *CODES}
    keep = [c for c in df.columns if c not in drop]
    kinds = [("persona", "personas"), ("nao", "naos"), ("lugar", "lugares")]

    def rows(kind: str, column: str) -> Column:
        return F.transform(split_list(F.col(column)), lambda x, i: F.struct(F.lit(kind).alias("tipo"), (i + 1).alias("pos"), x.alias("entidad")))

    per = [rows(k, c) for k, c in kinds]
    d = place_in(df, "tomo_id", order, "_orden").withColumn("_attr", attributes(F.col("atributos"))).withColumn("_e", F.explode_outer(F.concat(*per)))
    kind, ent = F.coalesce("_e.tipo", F.lit("")), F.coalesce("_e.entidad", F.lit(""))
    a = F.when(kind == "persona", F.try_element_at(F.col("_attr"), ent))
    tomo, cont = volume_code(F.col("tomo_id")), record_code(F.col("id_num"), F.col("_orden"))
    both, number = F.concat(tomo, cont), F.format_string("%02d", F.coalesce("_e.pos", F.lit(0)))
    codes = {"idtomo": tomo, "idcont": cont, "idtomocont": both}
    for k, short in (("persona", "per"), ("nao", "nao"), ("lugar", "lug")):
        codes[f"id{short}"] = F.when(kind == k, number).otherwise("")
        codes[f"idtomocont{short}"] = F.when(kind == k, F.concat(both, number)).otherwise("")
    return d.select(*keep, kind.alias("tipo_entidad"), F.coalesce("_e.pos", F.lit(0)).alias("pos_entidad"), ent.alias("entidad"), *(F.coalesce(a[n], F.lit("")).alias(n) for n in ATTRIBUTES), *(codes[n].alias(n) for n in CODES))


def sheets(panel: DataFrame) -> dict[str, DataFrame]:
    """One table per kind with a column named after it; persons know whether their record has a ship."""
    ships = panel.where(F.col("tipo_entidad") == "nao").select("contrato_idx").distinct().withColumn("_nao", F.lit(1))
    persons = panel.where(F.col("tipo_entidad") == "persona").join(ships, "contrato_idx", "left").withColumn("tiene_nao", F.coalesce("_nao", F.lit(0))).drop("_nao")
    out = {"persona": persons}
    for k in ("nao", "lugar"):
        out[k] = panel.where(F.col("tipo_entidad") == k).drop(*ATTRIBUTES)
    return {k: d.withColumnRenamed("entidad", k).drop("tipo_entidad") for k, d in out.items()}


def split_headers(df: DataFrame, number: str = "id_num") -> tuple[DataFrame, DataFrame]:
    """Records with and without a number; without such a column all are records."""
    if number not in df.columns:
        return df, df.limit(0)
    return df.where(F.col(number).isNotNull()), df.where(F.col(number).isNull())


def prefix_until(df: DataFrame, pos: str, number: str, last: int) -> DataFrame:
    """Rows up to the last one with this number; an error if there is none."""
    stop = df.where(F.col(number) == last).agg(F.max(pos).alias("_stop"))
    stop = stop.select(F.when(F.col("_stop").isNull(), F.raise_error(F.lit(f"no record {last}"))).otherwise(F.col("_stop")).alias("_stop"))
    return df.crossJoin(stop).where(F.col(pos) <= F.col("_stop")).drop("_stop")


def pending(asunto: str = "asunto", tipo: str = "tipo", personas: str = "personas") -> Column:
    """Whether a record has a text but nothing extracted yet."""
    return ~blank(F.col(asunto)) & blank(F.col(tipo)) & blank(F.col(personas))


def progress(df: DataFrame) -> DataFrame:
    """One row: total, con_asunto, procesados, con_entidades, pendientes."""
    has = lambda c: ~blank(F.col(c))
    return df.agg(
        F.count("*").alias("total"), F.count_if(has("asunto")).alias("con_asunto"), F.count_if(has("tipo") | has("personas")).alias("procesados"), F.count_if(has("personas") | has("naos") | has("lugares")).alias("con_entidades"), F.count_if(pending()).alias("pendientes")
    )


