"""Two recognisers compared page by page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from archiva.functions.quality import output_metrics, with_similarity


def pages_with_problems(listed: DataFrame, column: str, images: DataFrame, page: str = "page_num") -> DataFrame:
    """Images whose page number stands in lists like "12; 30"; the volume does not count."""
    n = listed.select(F.explode(F.split(F.coalesce(F.col(column), F.lit("")), r"[;,\s]+")).alias("n")).where(F.col("n").rlike(r"^\d+$"))
    return images.join(n.select(F.col("n").cast("int").alias(page)).distinct(), page, "left_semi")


def first_of(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_r", F.row_number().over(W.partitionBy(key).orderBy(order))).where("_r = 1").drop("_r")


def compare(a: DataFrame, b: DataFrame, key: str, text: str = "text", seconds: str = "tiempo_s", similarity: bool = True) -> DataFrame:
    """A row per page of ``a``: figures of both outputs (v1_, v2_), their differences and, if wanted, their similarity,
    which takes time by the product of the lengths."""
    side = lambda d, s: d.select(key, F.col(text).alias(f"{s}_text"), F.col(seconds).alias(f"{s}_tiempo_s"), output_metrics(F.col(text)).alias(f"_{s}")).select(key, f"{s}_text", f"{s}_tiempo_s", *(F.col(f"_{s}.{c}").alias(f"{s}_{c}") for c in ("chars", "lineas", "ratio_alfa", "valido", "flags")))
    j = side(a, "v1").join(side(b, "v2"), key, "left")
    j = with_similarity(j, "v1_text", "v2_text", "similitud_v1_v2") if similarity else j
    return j.withColumns({"delta_chars": F.col("v2_chars") - F.col("v1_chars"), "delta_tiempo": F.col("v2_tiempo_s") - F.col("v1_tiempo_s")}).drop("v1_text", "v2_text")


def means(outputs: DataFrame, model: str = "modelo") -> DataFrame:
    """Means of time, characters and letters by model, and how many outputs are valid."""
    return outputs.groupBy(model).agg(F.count("*").alias("n"), F.avg("tiempo_s").alias("tiempo_s"), F.avg("chars").alias("chars"), F.avg("ratio_alfa").alias("ratio_alfa"), F.count_if("valido").alias("validos"))
