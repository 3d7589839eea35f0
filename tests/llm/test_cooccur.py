import itertools
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from archiva.llm.cooccur import together

SCHEMA = "run string, contract long, name string, n long"


def brute(rows, least):
    baskets = {}
    for run, contract, name in rows:
        if name is not None:
            baskets.setdefault((run, contract), set()).add(name)
    single, pair = Counter(), Counter()
    for (run, _), names in baskets.items():
        single.update((run, x) for x in names)
        pair.update((run, *p) for p in itertools.combinations(sorted(names), 2))
    return {(r, a, b): (single[r, a], single[r, b], k) for (r, a, b), k in pair.items() if k >= least}


def run(spark, rows, least, block, n=1000, hot=5000, entries=2_000_000):
    df = spark.createDataFrame([(*r, 7) for r in rows], SCHEMA)
    runs = sorted({r[0] for r in rows}, key=str)
    totals = spark.createDataFrame([(r, n) for r in runs], "run string, n long")
    return together(df, totals, ["run"], ["contract"], "name", least, block, hot, entries)


@pytest.mark.parametrize(("least", "block", "hot", "entries"), [(1, 1000, 5000, 10**6), (4, 1000, 3, 10**6), (1, 3, 2, 7), (2, 2, 5000, 1), (1, 1000, 4, 20)])
def test_against_brute_force(spark, least, block, hot, entries):
    random.seed(least * 10 + block)
    names = ["Ana", "Íñigo", "Zoilo", "juan", "Ñuño", *"abcdefgh"]
    rows = [(random.choice(["r1", "r2", None]), random.choice([None, *range(12)]), random.choice([*names, None])) for _ in range(400)]
    rows += [("r1", 1, n) for n in names] * 2  # repeats, and one basket with everything
    got = {(r.run, r.item_a, r.item_b): (r.n_a, r.n_b, r.n_ab) for r in run(spark, rows, least, block, 1000, hot, entries).collect()}
    assert got == brute(rows, least)


def test_measures(spark):
    rows = [("r", i, x) for i in range(10) for x in ("a", "b")] + [("r", i, "a") for i in range(10, 20)]
    r = run(spark, rows, 1, 1000, 100).collect()[0]
    assert (r.n_a, r.n_b, r.n_ab, r.n) == (20, 10, 10, 100)
    assert r.lift == pytest.approx(5.0)
    cells = [(10, 20 * 10 / 100), (10, 20 * 90 / 100), (80, 80 * 90 / 100)]
    assert r.llr == pytest.approx(2 * sum(k * math.log(k / e) for k, e in cells))


def test_found_is_significant_by_itself():
    """The bound in the docstring of p5_found."""
    for k, l, n in [(4, 5, 10**6), (4, 5, 1000), (40, 7, 10**5)]:
        a = b = max(k, math.floor(math.sqrt(k * n / l)))
        e = a * b / n
        cells = [(k, e), (a - k, a - e), (b - k, b - e), (n - a - b + k, n - a - b + e)]
        assert 2 * sum(x * math.log(x / y) for x, y in cells if x) >= 2 * k * (math.log(k / e) - 1 + e / k) - 1e-6 > 3.84


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert together(df, df.select("run", "n"), ["run"], ["contract"], "name").count() == 0


def test_query(spark, sf):
    from archiva.llm.queries_cooccur import p5_found, p5_pairs

    assert p5_found(spark, sf).columns == ["run_id", "persona_a", "persona_b"]
    pairs = p5_pairs(spark, sf)
    once = pairs.where("n_ab = 1")
    assert once.count() > 0 and once.where("n_a = 1").count() > 0
    assert pairs.where(F.col("significativo") != ((F.col("lift") > 1) & (F.col("llr") >= 10.83))).count() == 0
    assert pairs.where(F.col("item_a") >= F.col("item_b")).count() == 0
