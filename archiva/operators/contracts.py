"""Boxes grouped into records that may run over pages; pages into texts; texts into records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from archiva.functions.text import is_record_start, strip

ORDER = ["tomo", "page_num", "sort_idx"]


def islands(df: DataFrame, kind: str = "class_name", chunk: Sequence[str] = ("tomo", "page_num")) -> DataFrame:
    """``df`` with ``island``, the number of the record of each box, from 1 in the order of ORDER.

    A continuation that is the first box of its page joins the record before it, also across volumes; every other box
    begins one. The running number over the whole table is made of a count per page, the sum of the pages before in the
    volume and the sum of the volumes before, so boxes are only sorted within their page, and what runs over all is one row
    per volume.
    """
    # the very first box opens a record whatever it is
    first = df.agg(F.min(F.struct(*chunk)).alias("_first"))
    joins = (F.coalesce(F.col(kind), F.lit("")) == "continuacion") & (F.col("sort_idx") == 1) & ~F.struct(*chunk).eqNullSafe(F.col("_first"))
    d = df.crossJoin(F.broadcast(first)).withColumn("_new", F.when(joins, 0).otherwise(1)).drop("_first")
    pages = d.groupBy(*chunk).agg(F.sum("_new").alias("_n"))
    # one row per page within a volume, one row per volume over all
    volume, rest = chunk[0], list(chunk[1:])
    volumes = pages.groupBy(volume).agg(F.sum("_n").alias("_v"))
    volumes = volumes.select(F.col(volume).alias("_volume"), F.coalesce(F.sum("_v").over(W.orderBy(volume).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_volumes"))
    if rest:
        before = W.partitionBy(volume).orderBy(*rest).rowsBetween(W.unboundedPreceding, -1)
        pages = pages.withColumn("_pages", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    else:
        pages = pages.withColumn("_pages", F.lit(0))
    pages = pages.join(volumes, F.col(volume).eqNullSafe(F.col("_volume"))).select(*chunk, (F.col("_pages") + F.col("_volumes")).alias("_before"))
    within = W.partitionBy(*chunk).orderBy("sort_idx").rowsBetween(W.unboundedPreceding, 0)
    d = d.withColumn("_in", F.sum("_new").over(within))
    on = [F.col(f"d.{c}").eqNullSafe(F.col(f"p.{c}")) for c in chunk]
    j = d.alias("d").join(pages.alias("p"), on[0] & on[1] if len(on) > 1 else on[0])
    return j.select("d.*", (F.col("_before") + F.col("_in")).alias("island")).drop("_new", "_in")


def group_records(df: DataFrame, text: str = "ocr_text_clean", kind: str = "class_name") -> DataFrame:
    """island, tomo_id, id_num, texto_completo, class_origin, page_inicio, page_fin, n_crops of each record."""
    d = islands(df, kind)
    box = F.struct(*ORDER, strip(F.coalesce(F.col(text), F.lit(""))).alias("t"), F.col(kind).alias("k"))
    g = d.groupBy("island").agg(F.sort_array(F.collect_list(box)).alias("b"), F.count("*").alias("n_crops"))
    body = F.array_join(F.filter(F.transform("b", lambda x: x["t"]), lambda t: t != ""), " ")
    first, last = F.element_at("b", 1), F.element_at("b", -1)
    g = g.withColumn("texto_completo", body)
    number = F.nullif(F.regexp_extract("texto_completo", r"^(\d+)\s+", 1), F.lit("")).try_cast("bigint")
    return g.select("island", F.replace(first["tomo"], F.lit(" "), F.lit("_")).alias("tomo_id"), number.alias("id_num"), "texto_completo", first["k"].alias("class_origin"), first["page_num"].alias("page_inicio"), last["page_num"].alias("page_fin"), "n_crops")


def page_texts(df: DataFrame, text: str, sep: str = "\n") -> DataFrame:
    """tomo, page_num, text: the texts of a page's boxes in order, blank ones left out."""
    item = F.struct("sort_idx", strip(F.coalesce(F.col(text), F.lit(""))).alias("t"))
    g = df.groupBy("tomo", "page_num").agg(F.sort_array(F.collect_list(item)).alias("b"))
    return g.select("tomo", "page_num", F.array_join(F.filter(F.transform("b", lambda x: x["t"]), lambda t: t != ""), sep).alias("text"))


def stitch(pages: Column) -> Column:
    """Ordered pages as one text: a word divided over a page end is made whole, an open sentence goes on, else a blank line.

    A single page stays as it is.
    """
    full = F.filter(F.transform(pages, strip), lambda p: p != "")

    def step(acc: Column, p: Column) -> Column:
        last = F.right(acc, F.lit(1))
        cut = F.substr(acc, F.lit(1), F.length(acc) - 1)
        open_ = ~last.isin(".", "?", "!", ":", ";", ")")
        return F.when(acc == "", p).when(last == "-", F.concat(cut, p)).when(open_, F.concat(acc, F.lit(" "), p)).otherwise(F.concat(acc, F.lit("\n\n"), p))

    return F.when(F.size(pages) == 1, F.element_at(pages, 1)).otherwise(F.aggregate(full, F.lit(""), step))


def join_soft_breaks(c: Column) -> Column:
    """Lines that are not blank, stripped and joined by blanks; blank lines, also those that hold blanks, stay as empty ones."""
    bare = F.array_join(F.transform(F.split(c, "\n"), strip), "\n")
    return F.regexp_replace(bare, r"(?<=[^\n])\n(?=[^\n])", " ")


def volume_parts(df: DataFrame, text: str) -> DataFrame:
    """tomo, page_num, parte: what each page adds to the text of its volume; the parts in order are what stitch() gives.

    Only the neighbouring pages are looked at, so no task holds the text of a volume. Blank pages add nothing and are
    left out; the only page of a volume stays as it is.
    """
    d = df.select("tomo", "page_num", F.coalesce(F.col(text), F.lit("")).alias("_raw"), F.count("*").over(W.partitionBy("tomo")).alias("_pages"))
    d = d.withColumn("_t", strip(F.col("_raw"))).where((F.col("_t") != "") | (F.col("_pages") == 1))
    order = W.partitionBy("tomo").orderBy("page_num")
    last = F.right(F.lag("_t").over(order), F.lit(1))
    cut = (F.right("_t", F.lit(1)) == "-") & F.lead("_t").over(order).isNotNull()
    lead = F.when(last.isNull() | (last == "-"), "").when(last.isin(".", "?", "!", ":", ";", ")"), "\n\n").otherwise(" ")
    body = F.when(cut, F.substr("_t", F.lit(1), F.length("_t") - 1)).otherwise(F.col("_t"))
    return d.select("tomo", "page_num", F.when(F.col("_pages") == 1, F.col("_raw")).otherwise(F.concat(lead, body)).alias("parte"))


def write_volumes(parts: DataFrame, path: str) -> None:
    """The parts of volume_parts() as text, a folder per volume, the pages in order."""
    parts.repartition("tomo").sortWithinPartitions("tomo", "page_num").select("tomo", F.col("parte").alias("value")).write.mode("overwrite").option("lineSep", "").partitionBy("tomo").text(path)


def segment_by_headers(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, rec (from 1), id_num, texto: records of a long text that begin at lines like "56. Libro del año".

    Lines before the first record are dropped. Each text is cut on its own.
    """
    d = df.select(key, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("pos", "_l")).withColumn("line", strip(F.col("_l"))).where(F.col("line") != "")
    d = d.withColumn("_start", is_record_start(F.col("line")).cast("int"))
    d = d.withColumn("rec", F.sum("_start").over(W.partitionBy(key).orderBy("pos"))).where(F.col("rec") > 0)
    g = d.groupBy(key, "rec").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), " ").alias("_t"))
    mark = r"^(\d+)\s*[\.\)]?-?\s+"
    return g.select(key, "rec", F.nullif(F.regexp_extract("_t", mark, 1), F.lit("")).try_cast("bigint").alias("id_num"), F.regexp_replace("_t", mark, "").alias("texto"))
