"""Boxes on pages: clamped, ranked, cut out, augmented, exchanged with labelling tools."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def clamp(df: DataFrame, w: str = "image_width", h: str = "image_height") -> DataFrame:
    """Boxes inside their image and at least one pixel wide and high."""
    d = df.withColumns({"x1": F.greatest(F.lit(0), F.least(F.col("x1"), F.col(w) - 1)), "y1": F.greatest(F.lit(0), F.least(F.col("y1"), F.col(h) - 1))})
    far = lambda a, b, size: F.least(F.col(size), F.greatest(F.col(b), F.col(a) + 1))
    return d.withColumns({"x2": far("x1", "x2", w), "y2": far("y1", "y2", h)})


def rank_boxes(df: DataFrame, page: str = "image_path", label: str = "page_label") -> DataFrame:
    """``df`` with sort_idx from 1 by (y1, x1, taller, wider) and box_id of the page's label."""
    w = W.partitionBy(page).orderBy("y1", "x1", F.desc(F.col("y2") - F.col("y1")), F.desc(F.col("x2") - F.col("x1")), "class_id", F.desc("conf"))
    return df.withColumn("sort_idx", F.row_number().over(w)).withColumn("box_id", F.concat_ws("_", F.col(label), F.format_string("%04d", "sort_idx")))


def polygon_box(points: Column) -> Column:
    """The upright box around a polygon: floor of the least, ceil of the greatest corner."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.floor(F.array_min(xs)).cast("int").alias("x1"), F.floor(F.array_min(ys)).cast("int").alias("y1"), F.ceil(F.array_max(xs)).cast("int").alias("x2"), F.ceil(F.array_max(ys)).cast("int").alias("y2"))


def order_corners(points: Column) -> Column:
    """Corners as upper left, upper right, lower right, lower left, by sums and differences of x and y."""
    by = lambda f: F.array_sort(F.transform(points, lambda p: F.struct(f(p).alias("k"), p.alias("p"))))
    total, diff = by(lambda p: p["x"] + p["y"]), by(lambda p: p["y"] - p["x"])
    return F.array(F.element_at(total, 1)["p"], F.element_at(diff, 1)["p"], F.element_at(total, -1)["p"], F.element_at(diff, -1)["p"])


def warp_size(corners: Column, pad: int = 5) -> Column:
    """Width and height of an upright crop of ordered corners: the longer of opposite edges plus a margin."""
    c = lambda i: F.element_at(corners, i)
    edge = lambda a, b: F.sqrt(F.pow(c(a)["x"] - c(b)["x"], 2) + F.pow(c(a)["y"] - c(b)["y"], 2))
    return F.struct((F.floor(F.greatest(edge(1, 2), edge(4, 3))) + 2 * pad).cast("int").alias("w"), (F.floor(F.greatest(edge(1, 4), edge(2, 3))) + 2 * pad).cast("int").alias("h"))


def page_fallback(pages: DataFrame, boxes: DataFrame, key: str = "image_path") -> DataFrame:
    """Boxes of each page; a page without any is one box of class -1 and confidence 1."""
    cols = ["class_id", "class_name", "conf", "x1", "y1", "x2", "y2"]
    whole = {"class_id": F.lit(-1), "class_name": F.lit("page_fallback"), "conf": F.lit(1.0), "x1": F.lit(0), "y1": F.lit(0), "x2": F.col("image_width"), "y2": F.col("image_height")}
    j = pages.alias("p").join(boxes.select(key, *cols, F.lit(1).alias("_hit")).alias("b"), key, "left")
    return j.select(*(F.col(f"p.{c}") if c != key else F.col(key) for c in pages.columns), *(F.when(F.col("_hit").isNull(), whole[c]).otherwise(F.col(f"b.{c}")).alias(c) for c in cols))


def manifest(boxes: DataFrame) -> DataFrame:
    """Boxes with the size of their crop and whether it is empty."""
    d = boxes.withColumns({"crop_width": F.col("x2") - F.col("x1"), "crop_height": F.col("y2") - F.col("y1")})
    return d.withColumn("crop_area", F.col("crop_width") * F.col("crop_height")).withColumn("status", F.when((F.col("crop_width") > 0) & (F.col("crop_height") > 0), "cropped").otherwise("empty_crop"))


def to_percent(df: DataFrame, w: str = "img_width", h: str = "img_height") -> DataFrame:
    """Pixel boxes x0, y0, x1, y1 as x, y, width, height in per cent."""
    p = lambda a, size: 100.0 * a / F.col(size)
    return df.withColumns({"x": p(F.col("x0"), w), "y": p(F.col("y0"), h), "width": p(F.col("x1") - F.col("x0"), w), "height": p(F.col("y1") - F.col("y0"), h)})


def from_percent(df: DataFrame, w: str = "img_width", h: str = "img_height") -> DataFrame:
    """Per cent boxes as whole pixels, cut off."""
    p = lambda a, size: (a / 100.0 * F.col(size)).cast("int")
    return df.withColumns({"x0": p(F.col("x"), w), "y0": p(F.col("y"), h), "x1": p(F.col("x") + F.col("width"), w), "y1": p(F.col("y") + F.col("height"), h)})


def label_tasks(segments: DataFrame) -> DataFrame:
    """pagina and task, the JSON of a labelling task with the page's boxes as predictions, in order."""
    d = to_percent(segments)
    value = F.struct("x", "y", "width", "height", F.array(F.lit("contrato")).alias("rectanglelabels"))
    box = F.struct("y0", "x0", F.struct(F.lit("rectanglelabels").alias("type"), F.col("img_width").alias("original_width"), F.col("img_height").alias("original_height"), value.alias("value")).alias("r"))
    g = d.groupBy("pagina").agg(F.sort_array(F.collect_list(box)).alias("_b"), F.max("img_width").alias("w"), F.max("img_height").alias("h"))
    data = F.struct("pagina", F.col("w").alias("img_width"), F.col("h").alias("img_height"))
    return g.select("pagina", F.to_json(F.struct(data.alias("data"), F.array(F.struct(F.transform("_b", lambda x: x["r"]).alias("result"))).alias("predictions"))).alias("task"))


EXPORT = "struct<data:struct<pagina:string,img_width:int,img_height:int>,annotations:array<struct<result:array<struct<type:string,value:struct<x:double,y:double,width:double,height:double>>>>>>"


def reviewed_boxes(tasks: DataFrame, column: str) -> DataFrame:
    """pagina, segment_id, x0, y0, x1, y1 of the last annotation of each exported task; ids from 1 by (y0, y1)."""
    d = tasks.select(F.from_json(column, EXPORT).alias("t")).select("t.data.*", F.try_element_at("t.annotations", F.lit(-1))["result"].alias("r"))
    d = d.select("pagina", "img_width", "img_height", F.explode("r").alias("b")).where(F.col("b.type") == "rectanglelabels").select("pagina", "img_width", "img_height", "b.value.*")
    px = from_percent(d)
    w = W.partitionBy("pagina").orderBy("y0", "y1", "x0", "x1")
    return px.select("pagina", F.row_number().over(w).alias("segment_id"), "x0", "y0", "x1", "y1", F.lit("manual").alias("source"))


def parse_labels(lines: DataFrame, column: str = "value") -> DataFrame:
    """class, cx, cy, w, h of label lines; lines of fewer than five fields are left out."""
    d = lines.withColumn("_p", F.split(F.trim(column), r"\s+")).where(F.size("_p") >= 5)
    f = lambda i: F.get(F.col("_p"), F.lit(i))
    return d.select(*[c for c in lines.columns if c != column], f(0).try_cast("int").alias("class"), *(f(i).try_cast("double").alias(n) for i, n in ((1, "cx"), (2, "cy"), (3, "w"), (4, "h"))))


def rotate_labels(labels: DataFrame, angles: Sequence[float], width: int, height: int, least_area: float = 0.001) -> DataFrame:
    """Labels turned about the middle of the image by each angle: corners x1..y4 in shares, clipped to the image, those
    with hardly any area left dropped. The angles are a literal of a few rows."""
    spark = labels.sparkSession
    grid = F.broadcast(spark.createDataFrame([(float(a),) for a in angles], "angle double"))
    d = labels.crossJoin(grid)
    a = F.radians("angle")
    cos, sin = F.cos(a), F.sin(a)
    cx, cy = F.lit(width / 2.0), F.lit(height / 2.0)
    out = {}
    for i, (sx, sy) in enumerate(((-1, -1), (1, -1), (1, 1), (-1, 1)), 1):
        x, y = (F.col("cx") + sx * F.col("w") / 2) * width, (F.col("cy") + sy * F.col("h") / 2) * height
        out[f"x{i}"] = (cos * x + sin * y + (1 - cos) * cx - sin * cy) / width
        out[f"y{i}"] = (-sin * x + cos * y + sin * cx + (1 - cos) * cy) / height
    d = d.withColumns({k: F.greatest(F.lit(0.0), F.least(F.lit(1.0), v)) for k, v in out.items()})
    span = lambda n: F.greatest(*(f"{n}{i}" for i in range(1, 5))) - F.least(*(f"{n}{i}" for i in range(1, 5)))
    return d.where(span("x") * span("y") > least_area)
