"""Boxes and texts as they arrive: the same Column functions on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from archiva.functions.quality import contract_flags
from archiva.functions.text import clean_ocr


def read_parts(spark: SparkSession, path: str, schema: str, most_files: int = 100) -> DataFrame:
    """Parquet files of a folder as a stream, so many at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", most_files).parquet(path)


def cleaned(stream: DataFrame, text: str) -> DataFrame:
    """Texts cleaned and flagged; stateless."""
    c = clean_ocr(F.col(text))
    return stream.withColumn("limpio", c).withColumn("flags", F.array_join(contract_flags(F.col("limpio")), "; "))


def arrivals(stream: DataFrame, when: str, by: str, late: str = "30 days", window: str = "1 day") -> DataFrame:
    """Rows per window and group; what comes later than ``late`` is dropped, so state stays bounded."""
    w = stream.withWatermark(when, late).groupBy(F.window(when, window).alias("w"), by)
    return w.agg(F.count("*").alias("n")).select(F.col("w.start").alias("desde"), F.col("w.end").alias("hasta"), by, "n")


def first_loads(stream: DataFrame, when: str, *key: str, late: str = "30 days") -> DataFrame:
    """Each record once, though it be loaded again within the watermark."""
    return stream.withWatermark(when, late).dropDuplicatesWithinWatermark(list(key))


def write(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """A stream into parquet, exactly once, until what is there is done."""
    return stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start()
