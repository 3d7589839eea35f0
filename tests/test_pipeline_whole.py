from pyspark.sql import functions as F

from archiva.plans import pipeline


def test_whole_flow(spark, sf, monkeypatch):
    seen = {}
    run = pipeline.run_pipeline
    monkeypatch.setattr(pipeline, "run_pipeline", lambda *a, **k: seen.setdefault("r", run(*a, **k)))
    got = pipeline.q_pipeline(spark, sf).collect()
    n = {p: sum(r.n for r in got if r.parte == p) for p in ("panel", "nodos", "aristas")}
    r = seen["r"]
    assert n == {"panel": r.panel.count(), "nodos": r.nodes.count(), "aristas": r.edges.count()}
    weight = {x.parte: x.suma for x in got if x.parte != "panel"}
    assert weight["nodos"] == 2 * weight["aristas"] > 0
    # the fifth name of a text and later ones are kept
    assert r.records.select(F.max(F.size(F.split("personas", ";"))).alias("m")).collect()[0].m > 4


def test_anchors_of_a_long_volume(spark):
    """20,000 records of one volume: a copy of the volume's list for each anchor would be 6 GB."""
    from archiva.operators import sequence

    d = spark.range(1, 20_001).selectExpr("id AS pos", "'Tomo I' AS tomo_id", "if(id % 10 = 0, 5, id) AS id_num")
    peak = []

    def seen(batches):
        import resource

        yield from batches
        peak.append(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss)
        assert peak[0] < 1_500_000, f"{peak[0]} kB"

    got = sequence.anchors(d, ["tomo_id"], "pos", "id_num").mapInArrow(seen, "pos bigint, tomo_id string, id_num bigint, is_anchor boolean")
    assert got.where("is_anchor").count() == 18_000
