"""Queries on cleaning and quality of texts, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archiva.functions import quality as q
from archiva.functions import text as t
from archiva.session import spread, table


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents", "doc_id", "text"))


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "compilado", "contrato_idx", "tomo_id", "texto_completo", "asunto"))


def q_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole cleaning of recognised text."""
    return _texts(spark, sf_dir).select("contrato_idx", t.clean_ocr(F.col("texto_completo")).alias("limpio"))


def q_clean_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The single steps whose result SQL can give as well."""
    c = F.col("text")
    return _docs(spark, sf_dir).select("doc_id", t.dehyphen(c).alias("sin_guion"), t.join_lines(c).alias("una_linea"), t.dehyphen_inline(c).alias("sin_guion_linea"), t.safe_name(c).alias("nombre"))


def q_clean_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", t.clean_page(F.col("text")).alias("limpia"))


def q_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of records with slips set right."""
    return _texts(spark, sf_dir).select("contrato_idx", t.normalize_labels(t.normalize_office(t.join_lines(F.col("texto_completo")))).alias("texto"))


def q_header_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are a running header, for a header given as parameter."""
    d = _texts(spark, sf_dir).select("contrato_idx", F.explode(F.split("texto_completo", "\n")).alias("linea"))
    return d.where(t.is_running_header(F.col("linea"), "ARCHIVO NOTARIAL DE PUERTO ALBORA")).groupBy("contrato_idx").agg(F.count("*").alias("n"))


def q_dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", F.length(t.drop_repeated_lines(F.col("text"))).alias("n"))


def q_quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("text")
    m = q.metrics(c)
    return _docs(spark, sf_dir).select("doc_id", m["largo"].alias("largo"), q.letters(F.coalesce(c, F.lit(""))).alias("letras"), m["chars_no_latino"].alias("chars_no_latino"), m["lineas_repetidas"].alias("lineas_repetidas"))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents", "doc_id", "source", "text").withColumn("m", q.metrics(F.col("text")))
    med = d.groupBy("source").agg(F.percentile("m.largo", F.lit(0.5)).alias("med"))
    j = d.alias("d").join(med.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")), "left")
    return j.select("doc_id", "d.source", q.page_flags(F.col("m"), F.col("med")).alias("flags"))


def q_quality_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags of each page against the median length of its source."""
    return _pages(spark, sf_dir).select("doc_id", F.array_join("flags", "; ").alias("flag"), (F.size("flags") > 0).alias("flagged"))


def q_flag_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


def q_contract_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("contrato_idx", F.array_join(q.contract_flags(F.col("texto_completo")), "; ").alias("ocr_flag"))


def q_validate_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validity of outputs under both versions of the rules."""
    d = _docs(spark, sf_dir).withColumn("f1", q.output_flags(F.col("text"))).withColumn("f2", q.output_flags(F.col("text"), 2))
    return d.select("doc_id", F.array_join("f1", "; ").alias("flags_v1"), q.is_valid(F.col("f1")).alias("valido_v1"), F.array_join("f2", "; ").alias("flags_v2"), q.is_valid(F.col("f2"), 2).alias("valido_v2"))


def q_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity of the subject as parsed and as cleaned again."""
    d = _texts(spark, sf_dir).select("contrato_idx", "asunto", t.clean_ocr(F.col("asunto")).alias("_c"))
    return q.with_similarity(d, "asunto", "_c", "similitud").select("contrato_idx", "similitud")


def q_record_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose first line is about "Libro del año", slips allowed."""
    return _texts(spark, sf_dir).select("contrato_idx", t.is_record_start(F.regexp_replace("texto_completo", "\n", " ")).alias("inicia"))


QUERIES = {f.__name__: f for f in (q_clean_text, q_clean_steps, q_clean_page, q_labels, q_header_lines, q_dedup_lines, q_quality_metrics, q_quality_flags, q_flag_freq, q_contract_flags, q_validate_output, q_similarity, q_record_starts)}

_STRIP = r"regexp_replace({0}, '^[\s]+|[\s]+$', '', 'g')"
_LINES = r"list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')"
_FOREIGN = r"[\x{0900}-\x{097F}\x{4E00}-\x{9FFF}\x{3040}-\x{309F}\x{30A0}-\x{30FF}\x{AC00}-\x{D7AF}]"
_METRICS = rf"""
SELECT doc_id, source, text, CASE WHEN regexp_full_match(coalesce(text, ''), '\s*') THEN 0 ELSE length(text) END AS largo,
  length(regexp_replace(coalesce(text, ''), '[^\p{{L}}]', '', 'g')) AS letras, len(regexp_extract_all(coalesce(text, ''), '{_FOREIGN}')) AS chars_no_latino,
  coalesce(len({_LINES}) - len(list_distinct({_LINES})), 0) AS lineas_repetidas FROM documents"""
_FLAGS = f"""
SELECT m.doc_id, list_filter([CASE WHEN largo = 0 OR round_even(letras / largo, 3) < 0.40 THEN 'bajo_alfa' END, CASE WHEN chars_no_latino > 0 THEN 'script_no_latino' END,
  CASE WHEN lineas_repetidas > 5 THEN 'texto_repetitivo' END, CASE WHEN med > 0 AND largo / med < 0.1 THEN 'muy_corto' END, CASE WHEN med > 0 AND largo / med > 5 THEN 'muy_largo' END], lambda x: x IS NOT NULL) AS flags
FROM ({_METRICS}) m JOIN (SELECT source, quantile_cont(largo, 0.5) AS med FROM ({_METRICS}) GROUP BY source) s ON m.source IS NOT DISTINCT FROM s.source"""
_CF = _LINES.replace("text,", "texto_completo,")
_V = r"regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g')"

SQL = {
    "q_clean_steps": rf"""SELECT doc_id, regexp_replace(text, '([\p{{L}}\p{{M}}\p{{N}}_])-\s*\n\s*([\p{{L}}\p{{M}}\p{{N}}_])', '\1\2', 'g') AS sin_guion, array_to_string({_LINES}, ' ') AS una_linea,
  regexp_replace(text, '([\p{{L}}\p{{M}}\p{{N}}_])- ?([\p{{L}}\p{{M}}\p{{N}}_])', '\1\2', 'g') AS sin_guion_linea, regexp_replace(text, '[^A-Za-z0-9._-]+', '_', 'g') AS nombre FROM documents""",
    "q_quality_metrics": f"SELECT doc_id, largo, letras, chars_no_latino, lineas_repetidas FROM ({_METRICS})",
    "q_quality_flags": f"SELECT doc_id, array_to_string(flags, '; ') AS flag, len(flags) > 0 AS flagged FROM ({_FLAGS})",
    "q_flag_freq": f"SELECT flag, count(*) AS n FROM (SELECT unnest(flags) AS flag FROM ({_FLAGS})) GROUP BY flag",
    "q_contract_flags": rf"""SELECT contrato_idx, CASE WHEN regexp_full_match(coalesce(texto_completo, ''), '\s*') THEN 'vacio' ELSE array_to_string(list_filter([
  CASE WHEN length(regexp_replace(texto_completo, '[^\p{{L}}]', '', 'g')) / length(texto_completo) < 0.40 THEN 'bajo_alfa' END, CASE WHEN regexp_matches(texto_completo, '{_FOREIGN}') THEN 'script_no_latino' END,
  CASE WHEN len({_CF}) - len(list_distinct({_CF})) > 5 THEN 'texto_repetitivo' END, CASE WHEN length(texto_completo) < 80 THEN 'muy_corto' END], lambda x: x IS NOT NULL), '; ') END AS ocr_flag FROM compilado""",
    "q_validate_output": rf"""
WITH a AS (SELECT doc_id, {_V} AS s, {_LINES} AS l, regexp_replace(regexp_replace(regexp_replace({_V}, '<\|[^|]*\|>', '', 'g'), '\[\[\d[\d,\s]*\]\]', '', 'g'), '^\s+|\s+$', '', 'g') AS bare FROM documents),
b AS (SELECT doc_id, CASE WHEN s = '' THEN ['vacio'] ELSE list_filter([CASE WHEN length(s) < 50 THEN 'muy_corto' END, CASE WHEN length(s) > 20 AND length(regexp_replace(s, '[^\p{{L}}]', '', 'g')) / length(s) < 0.3 THEN 'bajo_alfa' END,
  CASE WHEN len(l) > 5 AND (len(l) - len(list_distinct(l))) / len(l) > 0.5 THEN 'texto_repetitivo' END, CASE WHEN regexp_matches(s, '{_FOREIGN}') THEN 'chars_no_latino' END], lambda x: x IS NOT NULL) END AS f1, s, bare FROM a),
c AS (SELECT *, CASE WHEN s <> '' AND length(bare) < 20 THEN list_concat(['solo_tags'], f1) ELSE f1 END AS f2 FROM b)
SELECT doc_id, array_to_string(f1, '; ') AS flags_v1, NOT list_has_any(f1, ['vacio', 'bajo_alfa', 'texto_repetitivo']) AS valido_v1, array_to_string(f2, '; ') AS flags_v2, NOT list_has_any(f2, ['vacio', 'bajo_alfa', 'texto_repetitivo', 'solo_tags']) AS valido_v2 FROM c""",
}
