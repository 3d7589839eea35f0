from collections import Counter

import pytest
from pyspark.sql import functions as F

from archiva.llm.mix import count_tokens, mix, plan, realised


def test_tokens(spark):
    df = spark.createDataFrame([(1, "Hola mundo", "x"), (2, None, "y"), (3, "", None), (4, "<|endoftext|> a" * 3000, "z")], "doc_id long, text string, n_text string")
    got = {r.doc_id: r.n_tokens for r in count_tokens(df, "text").collect()}
    assert got[2] == got[3] == 0
    assert got[1] == 4
    assert got[4] > 3000 * 5  # an ordinary text, not one special token
    assert count_tokens(df, "text").columns == ["doc_id", "n_text", "n_tokens"]
    assert count_tokens(df.limit(0), "text").count() == 0


def rows(spark, sizes, targets):
    s = spark.createDataFrame(sizes, "source string, n_tokens long")
    t = spark.createDataFrame(targets, "source string, peso double, max_rep int")
    return {r.source: r for r in plan(s, t).collect()}


def test_plan(spark):
    got = rows(spark, [("a", 100), ("b", 800), (None, 100)], [("a", 0.3, 2), ("b", 0.5, 1), ("c", 0.2, 3)])
    assert (got["a"].want, got["a"].rate, got["a"].reaches) == (pytest.approx(300), 2.0, False)
    assert (got["b"].rate, got["b"].reaches) == (pytest.approx(0.625), True)
    assert (got["c"].n_tokens, got["c"].rate, got["c"].reaches) == (0, 0.0, False)
    assert sum(r.actual for r in got.values()) == pytest.approx(1)
    assert got["a"].actual == pytest.approx(200 / 700)


def test_plan_of_nothing(spark):
    got = rows(spark, [], [("a", 1.0, 2)])
    assert (got["a"].reaches, got["a"].actual) == (True, 0.0)  # nothing is wanted of nothing


def test_mix(spark):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 == 0, "a").when(F.col("id") % 4 == 1, "b").otherwise(F.lit(None)).alias("source"), F.lit(1).alias("rate"))
    rates = spark.createDataFrame([("a", 2.25), ("b", 0.0)], "source string, rate double")
    got = mix(docs, rates, "doc_id")
    assert got.columns == ["doc_id", "source", "rate", "copia"]
    n = Counter(r.doc_id for r in got.collect())
    assert set(n.values()) == {2, 3}
    assert len(n) == 5000
    assert sum(n.values()) / 5000 == pytest.approx(2.25, abs=0.03)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, mix(docs.repartition(7), rates, "doc_id").collect()))


def test_realised(spark):
    # one long document holds most of its source, so the draw moves the share away from the plan
    docs = spark.createDataFrame([(k, "a" if k < 4 else "b", 1000 if k == 0 else 10) for k in range(104)], "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("a", 0.4, 3), ("b", 0.6, 3), ("c", 0.0, 1)], "source string, peso double, max_rep int")
    p = plan(docs.groupBy("source").agg(F.sum("n_tokens").alias("n_tokens")), targets)
    got = {r.source: r for r in realised(docs, p, "doc_id").collect()}
    held = Counter()
    for r in mix(docs, p.select("source", "rate"), "doc_id").collect():
        held[r.source] += r.n_tokens
    assert {k: r.mixed for k, r in got.items()} == {k: held[k] for k in "abc"}
    assert got["a"].actual == pytest.approx(held["a"] / sum(held.values()))
    assert got["a"].planned_mixed == pytest.approx(0.4 * 2030)
    assert abs(got["a"].actual - got["a"].planned) > 0.05


def test_query(spark, sf):
    from archiva.llm.queries_mix import p7_found, p7_mix, p7_plan

    found = {r.source for r in p7_found(spark, sf).collect()}
    assert found == {r.source for r in p7_plan(spark, sf).collect() if r.max_rep * r.n_tokens < r.peso * r.total}
    assert p7_mix(spark, sf).count() > 0
