"""Queries on the panel of entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archiva.functions.text import blank, record_code, volume_code
from archiva.operators import panel
from archiva.session import table

COLUMNS = ["contrato_idx", "tomo_id", "id_num", "personas", "naos", "lugares", "atributos"]


def _panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.panelize(table(spark, sf_dir, "compilado", *COLUMNS)).drop("personas", "naos", "lugares", "atributos")


def q_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _panel(spark, sf_dir)


def q_panel_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities with their codes, without the attributes."""
    return _panel(spark, sf_dir).select("contrato_idx", "tipo_entidad", "pos_entidad", "entidad", "idtomo", "idcont", "idtomocontper", "idtomocontnao", "idtomocontlug")


def q_panel_personas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.sheets(_panel(spark, sf_dir))["persona"].select("contrato_idx", "pos_entidad", "persona", "tiene_nao")


def q_panel_naos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.sheets(_panel(spark, sf_dir))["nao"].select("contrato_idx", "pos_entidad", "nao")


def q_panel_lugares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.sheets(_panel(spark, sf_dir))["lugar"].select("contrato_idx", "pos_entidad", "lugar")


def q_panel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "panel", "tipo_entidad", "entidad", "gentilicio", "vecindad", "ocupacion", "relacion")
    has = [F.count_if(~blank(F.col(c))).alias(f"con_{c}") for c in panel.ATTRIBUTES]
    return p.groupBy("tipo_entidad").agg(F.count("*").alias("n"), F.count_distinct("entidad").alias("distintas"), *has)


def q_unique_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "panel", "tipo_entidad", "entidad")
    return p.groupBy("tipo_entidad", "entidad").agg(F.count("*").alias("n"))


def q_ids_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "compilado", "contrato_idx", "tomo_id", "id_num")
    d = panel.place_in(d, "tomo_id", "contrato_idx")
    t, c = volume_code(F.col("tomo_id")), record_code(F.col("id_num"), F.col("orden"))
    return d.select("contrato_idx", t.alias("idtomo"), c.alias("idcont"), F.concat(t, c).alias("idtomocont"))


def q_headers_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, heads = panel.split_headers(table(spark, sf_dir, "compilado", "contrato_idx", "id_num"))
    return kept.select("contrato_idx", F.lit("registro").alias("grupo")).unionByName(heads.select("contrato_idx", F.lit("encabezado").alias("grupo")))


def q_prefix_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records up to the last one with number 1."""
    return panel.prefix_until(table(spark, sf_dir, "compilado", "contrato_idx", "id_num"), "contrato_idx", "id_num", 1)


def q_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.progress(table(spark, sf_dir, "compilado", "asunto", "tipo", "personas", "naos", "lugares"))


def q_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "compilado", "tipo")
    return d.groupBy(F.coalesce("tipo", F.lit("")).alias("tipo")).agg(F.count("*").alias("n"))


def q_status_by_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cube of records by volume and status."""
    d = table(spark, sf_dir, "compilado", "tomo_id", "id_status")
    return d.cube("tomo_id", "id_status").agg(F.count("*").alias("n"), F.grouping_id().cast("bigint").alias("nivel"))


QUERIES = {
    f.__name__: f
    for f in (q_panel, q_panel_entities, q_panel_personas, q_panel_naos, q_panel_lugares, q_panel_counts, q_unique_entities, q_ids_composite, q_headers_split, q_prefix_cut, q_progress, q_type_counts, q_status_by_volume)
}

_S = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_LIST = r"list_filter(list_transform(string_split(coalesce({0}, ''), ';'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')"
_TOMO = """printf('%02d', coalesce(nullif(regexp_extract(tomo_id, '(\\d+)$', 1), ''), CASE string_split(replace(tomo_id, ' ', '_'), '_')[-1]
  WHEN 'I' THEN '1' WHEN 'II' THEN '2' WHEN 'III' THEN '3' WHEN 'IV' THEN '4' WHEN 'V' THEN '5' WHEN 'VI' THEN '6' WHEN 'VII' THEN '7' WHEN 'VIII' THEN '8' WHEN 'IX' THEN '9' WHEN 'X' THEN '10'
  WHEN 'XI' THEN '11' WHEN 'XII' THEN '12' WHEN 'XIII' THEN '13' WHEN 'XIV' THEN '14' WHEN 'XV' THEN '15' WHEN 'XVI' THEN '16' END, '0')::int)"""
# a record without a number has its place among the records of its volume
_CONT = "printf('%04d', CASE WHEN id_num >= 0 THEN id_num ELSE orden END)"
_RECORDS = "(SELECT *, row_number() OVER (PARTITION BY tomo_id ORDER BY contrato_idx) AS orden FROM compilado)"
_ENT = f"""ent AS (SELECT contrato_idx, {_TOMO} AS idtomo, {_CONT} AS idcont, k.tipo AS tipo_entidad, k.pos AS pos_entidad, k.e AS entidad FROM (
  SELECT *, unnest(CASE WHEN len(p) + len(n) + len(l) = 0 THEN [{{'tipo': '', 'pos': 0, 'e': ''}}] ELSE list_concat(list_concat(
    list_transform(p, lambda x, i: {{'tipo': 'persona', 'pos': i::int, 'e': x}}), list_transform(n, lambda x, i: {{'tipo': 'nao', 'pos': i::int, 'e': x}})), list_transform(l, lambda x, i: {{'tipo': 'lugar', 'pos': i::int, 'e': x}})) END) AS k
  FROM (SELECT *, {_LIST.format("personas")} AS p, {_LIST.format("naos")} AS n, {_LIST.format("lugares")} AS l FROM {_RECORDS})))"""
_HAS = ", ".join(f"count(*) FILTER (WHERE NOT regexp_full_match(coalesce({c}, ''), '\\s*')) AS con_{c}" for c in panel.ATTRIBUTES)

SQL = {
    "q_panel_entities": f"""WITH {_ENT} SELECT contrato_idx, tipo_entidad, pos_entidad, entidad, idtomo, idcont, {", ".join(f"CASE WHEN tipo_entidad = '{k}' THEN idtomo || idcont || printf('%02d', pos_entidad) ELSE '' END AS idtomocont{s}" for k, s in (("persona", "per"), ("nao", "nao"), ("lugar", "lug")))} FROM ent""",
    "q_panel_personas": f"WITH {_ENT} SELECT contrato_idx, pos_entidad, entidad AS persona, (contrato_idx IN (SELECT contrato_idx FROM ent WHERE tipo_entidad = 'nao'))::int AS tiene_nao FROM ent WHERE tipo_entidad = 'persona'",
    "q_panel_naos": f"WITH {_ENT} SELECT contrato_idx, pos_entidad, entidad AS nao FROM ent WHERE tipo_entidad = 'nao'",
    "q_panel_lugares": f"WITH {_ENT} SELECT contrato_idx, pos_entidad, entidad AS lugar FROM ent WHERE tipo_entidad = 'lugar'",
    "q_panel_counts": f"SELECT tipo_entidad, count(*) AS n, count(DISTINCT entidad) AS distintas, {_HAS} FROM panel GROUP BY tipo_entidad",
    "q_unique_entities": "SELECT tipo_entidad, entidad, count(*) AS n FROM panel GROUP BY ALL",
    "q_ids_composite": f"SELECT contrato_idx, {_TOMO} AS idtomo, {_CONT} AS idcont, {_TOMO} || {_CONT} AS idtomocont FROM {_RECORDS}",
    "q_headers_split": "SELECT contrato_idx, CASE WHEN id_num IS NULL THEN 'encabezado' ELSE 'registro' END AS grupo FROM compilado",
    "q_prefix_cut": "SELECT contrato_idx, id_num FROM compilado WHERE contrato_idx <= (SELECT max(contrato_idx) FROM compilado WHERE id_num = 1)",
    "q_progress": r"""SELECT count(*) AS total, count(*) FILTER (WHERE a) AS con_asunto, count(*) FILTER (WHERE t OR p) AS procesados, count(*) FILTER (WHERE p OR n OR l) AS con_entidades, count(*) FILTER (WHERE a AND NOT t AND NOT p) AS pendientes
  FROM (SELECT coalesce(regexp_matches(asunto, '\S'), false) AS a, coalesce(regexp_matches(tipo, '\S'), false) AS t, coalesce(regexp_matches(personas, '\S'), false) AS p, coalesce(regexp_matches(naos, '\S'), false) AS n, coalesce(regexp_matches(lugares, '\S'), false) AS l FROM compilado)""",
    "q_type_counts": "SELECT coalesce(tipo, '') AS tipo, count(*) AS n FROM compilado GROUP BY 1",
    "q_status_by_volume": "SELECT tomo_id, id_status, count(*) AS n, grouping_id(tomo_id, id_status)::bigint AS nivel FROM compilado GROUP BY CUBE (tomo_id, id_status)",
}
