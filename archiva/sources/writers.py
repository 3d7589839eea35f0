"""Writers: tables, page texts, network files, reports, profiles, checkpoints."""

from __future__ import annotations

from xml.sax.saxutils import quoteattr

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archiva.functions.text import safe_name
from archiva.operators import panel as panel_ops


def csv(df: DataFrame, path: str, single: bool = False) -> None:
    """A table as CSV; one file only where an export wants it."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def table(df: DataFrame, path: str, *by: str) -> None:
    """A table as parquet, by folders of ``by``."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*by) if by else w).parquet(path)


def sheets(panel: DataFrame, path: str) -> dict[str, int]:
    """The panel by kind of entity, each with its own columns; the number of rows of each."""
    for kind, d in panel_ops.sheets(panel).items():
        table(d, f"{path}/tipo_entidad={kind}")
    return {r.tipo_entidad: r.n for r in panel.groupBy("tipo_entidad").agg(F.count("*").alias("n")).collect()}


def texts(df: DataFrame, key: str, text: str, path: str) -> None:
    """A text per key, under folders named after the key."""
    df.select(safe_name(F.col(key)).alias("clave"), F.col(text).cast("string").alias("value")).write.mode("overwrite").partitionBy("clave").option("lineSep", "\n").text(path)


def gexf(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """The network as a GEXF file, written row by row from the tables."""
    with open(path, "w", encoding="utf-8") as f:
        f.write('<?xml version="1.0" encoding="UTF-8"?>\n<gexf xmlns="http://www.gexf.net/1.2draft" version="1.2">\n<graph mode="static" defaultedgetype="undirected">\n<nodes>\n')
        for r in nodes.select("persona").toLocalIterator():
            f.write(f"<node id={quoteattr(r[0])} label={quoteattr(r[0])}/>\n")
        f.write("</nodes>\n<edges>\n")
        for i, r in enumerate(edges.select("persona_a", "persona_b", "peso").toLocalIterator()):
            f.write(f'<edge id="{i}" source={quoteattr(r[0])} target={quoteattr(r[1])} weight="{r[2]}"/>\n')
        f.write("</edges>\n</graph>\n</gexf>\n")


def report(stats: DataFrame, title: str) -> str:
    """A one-row table as lines of text."""
    row = stats.collect()[0].asDict()
    return "\n".join([title, "=" * len(title), *(f"{k}: {v:.4f}" if isinstance(v, float) else f"{k}: {v}" for k, v in row.items())]) + "\n"


def combined_markdown(pages: DataFrame, label: str, text: str) -> DataFrame:
    """documento: the pages as one document, a row per page with its heading, sorted by ranges; written as text, the files
    in order are the document, and no task holds all of it."""
    part = F.concat(F.lit("## "), F.col(label), F.lit("\n\n"), F.coalesce(F.col(text), F.lit("")), F.lit("\n"))
    return pages.orderBy(label).select(part.alias("documento"))


def batch_log(done: DataFrame, valid: str = "valido") -> DataFrame:
    """page, image, status, note of a batch."""
    return done.select("page", "image", F.when(F.col(valid), "OK").otherwise("REVISAR").alias("status"), F.col("flags").alias("note"))


def append_parts(df: DataFrame, path: str, pos: str, size: int = 500) -> None:
    """A table appended in parts of ``size`` by position, one write each, so that a job that is cut off keeps those it
    has written; called again it goes on with the parts that are not there."""
    from pyspark.errors import AnalysisException

    spark = df.sparkSession
    d = df.withColumn("parte", F.floor((F.col(pos) - 1) / size).cast("int"))
    try:
        there = {r[0] for r in spark.read.parquet(path).select("parte").distinct().collect()}
    except AnalysisException:  # nothing was written yet
        there = set()
    for part in sorted(r[0] for r in d.select("parte").distinct().collect() if r[0] not in there):
        d.where(F.col("parte") == part).write.mode("append").partitionBy("parte").parquet(path)


def profiles(df: DataFrame, path: str) -> None:
    """The registry of preparation profiles, replaced as a whole."""
    df.coalesce(1).write.mode("overwrite").json(path)


def run_summary(folder: str) -> list[tuple[str, int]]:
    """Files of a run on the driver's disk and their sizes in bytes, by name."""
    from pathlib import Path

    return sorted((p.name, p.stat().st_size) for p in Path(folder).iterdir() if p.is_file())


def parts_wide(df: DataFrame, key: str, pos: str, value: str, most: int | None = None) -> DataFrame:
    """Parts of each key side by side as col_0, col_1 and so on, for looking at them; as many columns as the key with most
    parts needs, or ``most``, which is refused if some key has more."""
    needed = (df.agg(F.max(pos)).collect()[0][0] if df.columns else None) or 0
    if most is None:
        most = int(needed) + 1
    elif needed >= most:
        raise ValueError(f"a key has {needed + 1} parts, not {most} at most")
    return df.groupBy(key).pivot(pos, list(range(most))).agg(F.first(value)).select(key, *(F.col(str(i)).alias(f"col_{i}") for i in range(most)))
