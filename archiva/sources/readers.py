"""Readers: images, page texts, tables, JSON, labels, runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from archiva.functions.text import rx, strip
from archiva.operators.entities import PAYLOAD
from archiva.operators.layout import parse_labels


def file_name(path: Column) -> Column:
    """The last part of a path, with %20 and the like read."""
    return F.url_decode(F.element_at(F.split(path, "/"), -1))


def page_keys(name: Column) -> Column:
    """tomo, page_num, page_label of a prepared image's name; the volume begins with a capital; null for other names."""
    p = rx(r"^(.+?)_p(\d+)_prep\.\w+$", "i")
    tomo = F.regexp_extract(name, p, 1)
    tomo = F.when(F.left(tomo, F.lit(1)).rlike(r"^\p{Ll}"), F.concat(F.upper(F.left(tomo, F.lit(1))), F.substr(tomo, F.lit(2)))).otherwise(tomo)
    n = F.regexp_extract(name, p, 2).try_cast("int")
    return F.when(name.rlike(p), F.struct(tomo.alias("tomo"), n.alias("page_num"), F.format_string("%s_p%04d", tomo, n).alias("page_label")))


def folder_keys(name: Column) -> Column:
    """tomo and page_num of a page's folder; nulls for other names."""
    return F.struct(F.nullif(F.regexp_extract(name, r"^(.+?)_p(\d+)$", 1), F.lit("")).alias("tomo"), F.nullif(F.regexp_extract(name, r"^(.+?)_p(\d+)$", 2), F.lit("")).try_cast("int").alias("page_num"))


def natural_order(name: Column) -> Column:
    """The page number in a name, a very high one if there is none."""
    return F.coalesce(F.nullif(F.regexp_extract(name, r"_p(\d+)_", 1), F.lit("")).try_cast("bigint"), F.lit(1_000_000_000))


def selected_volumes(selector: str) -> list[str]:
    """Names of volumes from "tomo_i, Tomo III": single blanks, the word as usual, the number in capitals."""
    out = []
    for part in selector.split(","):
        words = part.replace("_", " ").split()
        if words:
            name = f"Tomo {' '.join(words[1:]).upper()}" if words[0].lower() == "tomo" and len(words) > 1 else " ".join(words)
            if name not in out:
                out.append(name)
    return out


def images(spark: SparkSession, path: str, volumes: list[str] | None = None) -> DataFrame:
    """Prepared page images of a folder with their keys, in the order of volume, page and name."""
    d = spark.read.format("binaryFile").option("pathGlobFilter", "*_prep.*").load(path)
    d = d.withColumn("name", file_name(F.col("path"))).withColumn("_k", page_keys(F.col("name"))).where(F.col("_k").isNotNull()).select("path", "name", "length", "_k.*", "content")
    if volumes:
        d = d.where(F.col("tomo").isin(volumes))
    return d.orderBy("tomo", "page_num", F.lower("name"))


def decode_text(content: Column) -> Column:
    """Bytes as UTF-8, else as Latin-1."""
    return F.when(F.is_valid_utf8(content.cast("string")), F.decode(content, "UTF-8")).otherwise(F.decode(content, "ISO-8859-1"))


def page_texts(spark: SparkSession, path: str, name: str = "result.txt") -> DataFrame:
    """tomo, page_num, text of the result files in the page folders below a path."""
    d = spark.read.format("binaryFile").option("pathGlobFilter", name).option("recursiveFileLookup", "true").load(path)
    k = folder_keys(F.url_decode(F.element_at(F.split("path", "/"), -2)))
    return d.select(k.alias("k"), decode_text(F.col("content")).alias("text")).select("k.*", "text")


def csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A table with header, quoted line breaks and perhaps a byte order mark."""
    r = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return (r.schema(schema) if schema else r).csv(path)


def records_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON list of records with idx, the place of each in its file."""
    d = spark.read.option("wholetext", True).text(path).select(F.posexplode(F.from_json("value", "array<variant>")).alias("idx", "record"))
    return d.select(F.col("idx").cast("bigint"), F.to_json("record").alias("record"))


def extraction_chunk(spark: SparkSession, path: str) -> DataFrame:
    """idx and payload of a JSON map of extractions; a file that is not JSON gives no row here but one in broken_chunks()."""
    d = spark.read.option("wholetext", True).text(path).select(F.from_json("value", f"map<string,struct<{_colons(PAYLOAD)}>>").alias("m"))
    return d.select(F.explode("m").alias("idx", "payload")).select(F.col("idx").try_cast("bigint").alias("idx"), "payload")


def broken_chunks(spark: SparkSession, path: str) -> DataFrame:
    """archivo and inicio (its first 200 characters) of each file that extraction_chunk() cannot read."""
    d = spark.read.option("wholetext", True).text(path).select("value", F.col("_metadata.file_path").alias("archivo"))
    ok = F.from_json("value", "map<string,variant>").isNotNull()
    return d.where(~ok).select("archivo", F.substring("value", 1, 200).alias("inicio"))


def _colons(ddl: str) -> str:
    """Field list of a struct type from a table's field list."""
    depth, out, part = 0, [], ""
    for c in ddl + ",":
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            name, kind = part.strip().split(" ", 1)
            out.append(f"{name}:{kind}")
            part = ""
        else:
            part += c
    return ",".join(out)


def labels(spark: SparkSession, path: str) -> DataFrame:
    """Label files of a folder: pagina, class, cx, cy, w, h."""
    d = spark.read.option("wholetext", True).text(path).select(F.regexp_replace(file_name(F.col("_metadata.file_path")), r"_seg\.txt$|\.txt$", "").alias("pagina"), F.explode(F.split("value", "\n")).alias("value"))
    return parse_labels(d.where(strip(F.col("value")) != ""))


def grouped_boxes(spark: SparkSession, path: str) -> DataFrame:
    """pagina and boxes of a table of proposed boxes."""
    d = csv(spark, path)
    return d.groupBy("pagina").agg(F.collect_list(F.struct(*[c for c in d.columns if c != "pagina"])).alias("boxes"))


def latest_run(names: list[str], having: set[str] | None = None) -> str | None:
    """The last run folder by name, of those in ``having`` if given."""
    runs = sorted((n for n in names if n.startswith("run_") and (having is None or n in having)), reverse=True)
    return runs[0] if runs else None
