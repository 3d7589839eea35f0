from pyspark.sql import functions as F

from archiva.operators import compare, layout
from archiva.plans.layout import QUERIES


def test_all_documents_have_two_sides(spark, sf):
    d = QUERIES["q_ab_similarity"](spark, sf)
    n = spark.read.parquet(f"{sf}/documents.parquet").where("text is not null").count()
    assert d.where(F.col("delta_chars").isNotNull() & F.col("delta_tiempo").isNotNull() & F.col("similitud_v1_v2").isNotNull()).count() == n
    assert QUERIES["q_ab_compare"](spark, sf).where("v2_chars is not null").count() == n


def test_all_boxes(spark, sf):
    got = {r.class_name: r.n for r in QUERIES["q_page_fallback"](spark, sf).collect()}
    assert got["contrato"] == spark.read.parquet(f"{sf}/lineitem.parquet").count()


def test_missing_pages(spark):
    a = spark.createDataFrame([(1, "uno dos", 1.0), (2, "tres", 1.0)], "pagina long, text string, tiempo_s double")
    got = {r.pagina: r for r in compare.compare(a, a.where("pagina = 1"), "pagina").collect()}
    assert (got[1].delta_chars, got[1].v2_chars, got[2].v1_chars, got[2].v2_chars, got[2].delta_tiempo) == (0, 7, 4, None, None)
    pages = spark.createDataFrame([("p", 100, 80), ("q", 100, 80)], "image_path string, image_width int, image_height int")
    boxes = spark.createDataFrame([("p", 0, "contrato", 0.5, 1, 2, 30, 40)], "image_path string, class_id int, class_name string, conf double, x1 int, y1 int, x2 int, y2 int")
    assert sorted((r.image_path, r.class_name, r.x2) for r in layout.page_fallback(pages, boxes).collect()) == [("p", "contrato", 30), ("q", "page_fallback", 100)]
