"""Files read and written, streams, the whole flow."""

import json

from pyspark.sql import functions as F

from archiva.operators.backends import Stub
from archiva.plans.pipeline import q_pipeline, reclean, run_pipeline
from archiva.sources import readers, writers
from archiva.streaming import ingest


def test_pages(spark, tmp_path):
    for name, data in (("Tomo I_p0001", "áéí".encode()), ("Tomo I_p0002", "áéí".encode("latin-1"))):
        (tmp_path / "pages" / name).mkdir(parents=True)
        (tmp_path / "pages" / name / "result.txt").write_bytes(data)
    got = {r.page_num: (r.tomo, r.text) for r in readers.page_texts(spark, str(tmp_path / "pages")).collect()}
    assert got == {1: ("Tomo I", "áéí"), 2: ("Tomo I", "áéí")}
    (tmp_path / "img").mkdir()
    for n in ("tomo II_p12_prep.png", "Tomo I_p3_prep.png", "other.png"):
        (tmp_path / "img" / n).write_bytes(b"x")
    rows = readers.images(spark, str(tmp_path / "img"), ["Tomo I", "Tomo II"]).collect()
    assert [(r.tomo, r.page_num, r.page_label) for r in rows] == [("Tomo I", 3, "Tomo I_p0003"), ("Tomo II", 12, "Tomo II_p0012")]
    assert readers.selected_volumes("tomo_i, Tomo  iii,,tomo_i") == ["Tomo I", "Tomo III"]
    assert readers.latest_run(["run_1", "run_3", "x"], {"run_1"}) == "run_1"


def test_tables(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_bytes('﻿pagina,x\nA,"1\n2"\n'.encode())
    d = readers.csv(spark, str(p))
    assert d.columns == ["pagina", "x"]
    assert readers.grouped_boxes(spark, str(p)).collect()[0].boxes[0].x == "1\n2"
    (tmp_path / "r.json").write_text(json.dumps([{"a": 1}, {"b": "ñ"}]))
    assert [(r.idx, json.loads(r.record)) for r in readers.records_json(spark, str(tmp_path / "r.json")).collect()] == [(0, {"a": 1}), (1, {"b": "ñ"})]
    (tmp_path / "c.json").write_text(json.dumps({"3": {"tipo": "x", "personas": ["A"], "atributos": {"A": {"oficio": "o"}}}}))
    r = readers.extraction_chunk(spark, str(tmp_path / "c.json")).collect()[0]
    assert (r.idx, r.payload.personas, r.payload.atributos["A"].oficio) == (3, ["A"], "o")
    (tmp_path / "bad.json").write_text('{"3": ]')
    assert readers.extraction_chunk(spark, str(tmp_path / "bad.json")).count() == 0
    assert [r.archivo.rsplit("/", 1)[1] for r in readers.broken_chunks(spark, str(tmp_path / "*.json")).collect()].count("bad.json") == 1
    (tmp_path / "lab").mkdir()
    (tmp_path / "lab" / "Tomo I_p0001_seg.txt").write_text("1 0.1 0.2 0.3 0.4\n0 1 2\n0 0.5 0.5 0.5 0.5")
    assert sorted((r.pagina, r["class"]) for r in readers.labels(spark, str(tmp_path / "lab")).collect()) == [("Tomo I_p0001", 0), ("Tomo I_p0001", 1)]


def test_writers(spark, tmp_path):
    n = spark.createDataFrame([("A",), ('B "x"',)], "persona string")
    e = spark.createDataFrame([("A", 'B "x"', 3)], "persona_a string, persona_b string, peso long")
    writers.gexf(n, e, str(tmp_path / "g.gexf"))
    import xml.etree.ElementTree as ET

    assert len(ET.parse(tmp_path / "g.gexf").getroot()[0][1]) == 1
    writers.csv(e, str(tmp_path / "e"), single=True)
    assert readers.csv(spark, str(tmp_path / "e")).count() == 1
    assert "peso: 3" in writers.report(e.select("peso"), "red")
    writers.append_parts(spark.range(1, 1201).withColumnRenamed("id", "pos"), str(tmp_path / "parts"), "pos")
    assert spark.read.parquet(str(tmp_path / "parts")).select("parte").distinct().count() == 3
    writers.texts(n, "persona", "persona", str(tmp_path / "txt"))
    assert spark.read.text(str(tmp_path / "txt")).count() == 2
    md = "\n".join(r.documento for r in writers.combined_markdown(n.withColumn("t", F.lit("hola")), "persona", "t").collect())
    assert md.startswith("## A\n\nhola")
    writers.profiles(n, str(tmp_path / "prof"))
    assert spark.read.json(str(tmp_path / "prof")).count() == 2


def test_stream(spark, tmp_path):
    d = spark.createDataFrame([(1, "pala-\nbra", "2024-01-01 10:00:00"), (1, "otra", "2024-01-01 11:00:00")], "k long, t string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    d.write.parquet(str(tmp_path / "in"))
    s = ingest.read_parts(spark, str(tmp_path / "in"), "k long, t string, ts timestamp")
    ingest.write(ingest.cleaned(ingest.first_loads(s, "ts", "k"), "t"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    ingest.arrivals(s, "ts", "k").writeStream.format("memory").queryName("arr").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start().awaitTermination(120)
    assert spark.table("arr").collect()[0].n == 2


def test_pipeline(spark, sf):
    rows = [("Tomo I", 1, 1, "contrato", "1 Libro del año: 1500. Oficio: I. Asunto: Ana vende"), ("Tomo I", 1, 2, "contrato", "3 Libro del año: 1501. Asunto: Juan y Ana")]
    boxes = spark.createDataFrame(rows, "tomo string, page_num int, sort_idx int, class_name string, ocr_text string")
    r = run_pipeline(reclean(boxes), lambda: Stub(lambda x: json.dumps({"tipo": "t", "personas": ["Ana", "Juan"]})))
    assert [(x.id_num, x.id_status) for x in r.records.orderBy("pos").collect()] == [(1, "ancla"), (2, "perdido"), (3, "ancla")]
    assert r.edges.collect()[0].peso == 2
    assert r.panel.count() == 5
    assert run_pipeline(reclean(boxes), only_text=True).panel is None
    assert q_pipeline(spark, sf).count() > 0
