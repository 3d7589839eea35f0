import random

import numpy as np
import pytest

from archiva.llm import leaks
from archiva.llm.leaks import Index, Rule, align, clean_leaks, find_leaks, words

random.seed(5)
VOCABULARY = [a + b + c for a in "bcdfgjlmnprstvz" for b in ("ala", "ero", "ino", "usa", "embo", "igra") for c in ("ta", "mo", "ces", "lu", "rin", "das", "pel")]
ITEMS = [(i, " ".join(random.choice(VOCABULARY) for _ in range(60))) for i in range(30)]
FILLER = " ".join(random.choice(["uno", "dos", "tres", "mar", "sol"]) for _ in range(80))


def test_words():
    assert words("Se-\nñor, p@ra  9.389 pes0s; El ÁRBOL") == ["senor", "para", "9389", "pesos", "el", "arbol"]


def test_align_against_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(60):
        a, b = rng.integers(0, 5, 14), rng.integers(0, 5, 11)
        s = np.zeros((15, 12))
        for i in range(1, 15):
            for j in range(1, 12):
                s[i, j] = max(0, s[i - 1, j - 1] + (1 if a[i - 1] == b[j - 1] else -0.9), s[i - 1, j] - 0.7, s[i, j - 1] - 0.7)
        got = align(a, b)
        if s.max() <= 0:
            assert got == []
            continue
        lo, hi, c, d, at = got[0]
        assert s[hi, d] == pytest.approx(s.max())
        assert all(lo <= at[j] < hi and b[j] == a[at[j]] for j in np.flatnonzero(at >= 0))


@pytest.mark.parametrize(("change", "leak"), [
    (lambda w: w, True), (lambda w: w[20:42], True), (lambda w: w[20:32], False), (lambda w: [], False),
    (lambda w: [x.upper() for x in w], True), (lambda w: [x.replace("a", "@", 1) if i % 5 == 0 else x for i, x in enumerate(w)], True),
    (lambda w: [y for i, x in enumerate(w) for y in ([x, "luego"] if i % 9 == 0 else [x])], True), (lambda w: [x for i, x in enumerate(w) if i % 10], True),
    (lambda w: [x if i % 2 else "otra" for i, x in enumerate(w)], False),
])
def test_leaks(spark, change, leak):
    docs = [(k, f"{FILLER} {' '.join(change(t.split()))}\n{FILLER}") for k, t in ITEMS[:3]] + [(99, FILLER), (100, None), (101, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in find_leaks(df, "text", "doc_id", ITEMS).collect()}
    assert got == ({(k, k) for k, _ in ITEMS[:3]} if leak else set())


@pytest.mark.parametrize("n", [20, 24, 28])
def test_scattered_changes(spark, n):
    docs = []
    for k, t in ITEMS[:8]:
        w = t.split()[10 : 10 + n]
        docs.append((k, f"{FILLER} {' '.join('xyxyxy' if i % 3 == 2 and i < 18 else x for i, x in enumerate(w))} {FILLER}"))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in find_leaks(df, "text", "doc_id", ITEMS).collect()} == {(k, k) for k, _ in ITEMS[:8]}


def test_shared_passages(spark):
    """Equal passages are all found, and neither they nor unrelated ones change what is found."""
    passage = " ".join(w[::-1] for w in VOCABULARY[:60])
    same = [(k, passage) for k in range(16)]
    other = [(1000 + k, " ".join(random.choice(VOCABULARY) for _ in range(60))) for k in range(1600)]
    df = spark.createDataFrame([(1, f"{FILLER} {passage} {FILLER}")], "doc_id long, text string")
    for items in (same[:1], same, same[:4] + other[:20], same + other):
        want = {i for i, t in items if t == passage}
        assert {r.item_id for r in find_leaks(df, "text", "doc_id", items).collect()} == want


ALIKE = "Juró el {}, puesta la mano en el arca, que {} nunca pisó la villa de {} antes del {} de marzo de {}, y lo firmó en {} delante de todos."
PEOPLE = [("herrero", "Ana de Soto", "Rada Mansa", 4, 1501, "Cabo Largo"), ("sastre", "Luis Oliva", "Puerto Claro", 17, 1533, "Isla Seca"), ("paje", "Juan Ruano", "Rada Mansa", 9, 1560, "Villa Honda")]


def test_sentences_built_alike(spark):
    """Names and numbers tell a passage from sentences built alike, beside any number of other passages."""
    items = [(k, ALIKE.format(*x)) for k, x in enumerate(PEOPLE)]
    docs = [(k, f"{FILLER}. {t} {FILLER}") for k, t in items] + [(9, f"{FILLER}. {ALIKE.format('cura', 'Eva Mar', 'Rada Mansa', 5, 1590, 'Punta Alta')} {FILLER}")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for some in (items, items[:1], items + [(50 + k, ALIKE.format(*x)) for k in range(30) for x in PEOPLE]):
        got = {(r.doc_id, r.item_id) for r in find_leaks(df, "text", "doc_id", some).collect()}
        assert got == {(k, i) for k, t in items for i, u in some if t == u}


def test_best_stretch_within_an_alignment(spark):
    """A good stretch counts although what lies beyond it agrees too little."""
    w = ITEMS[3][1].split()
    text = " ".join(w[:22] + [x if k % 3 == 0 else "otra" for k, x in enumerate(w[22:])])
    df = spark.createDataFrame([(3, text)], "doc_id long, text string")
    assert [r.item_id for r in find_leaks(df, "text", "doc_id", ITEMS).collect()] == [3]


def test_long_text(spark):
    """A text longer than what is searched at once, with a passage across the cut and at the end."""
    w = ITEMS[0][1].split()
    filler = ["mar", "sol", "dos"] * 20_000
    text = " ".join(filler[:49_970] + w + filler[:90_000] + ITEMS[1][1].split())
    df = spark.createDataFrame([(1, text), (2, " ".join(filler))], "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in find_leaks(df, "text", "doc_id", ITEMS).collect()} == {(1, 0), (1, 1)}


def test_clean(spark):
    stretch = " ".join(ITEMS[0][1].split()[5:45])
    df = spark.createDataFrame([(1, f"{FILLER} {stretch} {FILLER}", 7), (2, FILLER, 7), (3, None, 7)], "doc_id long, text string, n_removed int")
    got = {r.doc_id: (r.text, r.n_removed) for r in clean_leaks(df, "text", "doc_id", ITEMS).collect()}
    assert got == {1: (f"{FILLER} {FILLER}", 40), 2: (FILLER, 0), 3: (None, 0)}


def test_clean_takes_every_copy(spark):
    w = ITEMS[0][1].split()
    whole, one, two = " ".join(w), " ".join(w[:25]), " ".join(w[30:58])
    far = " ".join([FILLER] * 4)
    texts = {1: (f"mar {whole} {far} {whole} sol", 120), 2: (f"mar {one} {FILLER} {two} sol", 53), 3: (f"mar {whole} uno {whole} sol {one}", 145)}
    df = spark.createDataFrame([(k, t) for k, (t, _) in texts.items()], "doc_id long, text string")
    out = clean_leaks(df, "text", "doc_id", ITEMS)
    assert {r.doc_id: r.n_removed for r in out.collect()} == {k: n for k, (_, n) in texts.items()}
    assert find_leaks(out, "text", "doc_id", ITEMS).count() == 0


def test_edges(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    assert find_leaks(df.limit(0), "text", "doc_id", ITEMS).count() == 0
    assert find_leaks(df, "text", "doc_id", []).count() == 0
    assert find_leaks(df, "text", "doc_id", [(1, ""), (2, None)]).count() == 0
    twice = Index.build([(1, ITEMS[0][1]), (2, ITEMS[0][1])])
    assert len(twice.ids) == 2


def test_query(spark, sf):
    from archiva.llm.queries_leaks import p6_clean, p6_found

    assert p6_found(spark, sf).columns == ["doc_id", "item_id"]
    assert p6_clean(spark, sf).count() == spark.read.parquet(f"{sf}/documents.parquet").count()


@pytest.mark.parametrize("shape", [(14, 11), (11, 14), (9, 9)])
def test_align_takes_the_first_of_equal_scores(shape):
    """Scores in tenths are whole, so which of several equal alignments is taken depends on no rounding, nor on which side is longer."""
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = rng.integers(0, 4, shape[0]), rng.integers(0, 4, shape[1])
        s = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                s[i, j] = max(0, s[i - 1, j - 1] + (10 if a[i - 1] == b[j - 1] else -9), s[i - 1, j] - 7, s[i, j - 1] - 7)
        if s.max() > 0:
            _, hi, _, d, at = align(a, b)[0]
            assert (hi, d) == np.unravel_index(s.argmax(), s.shape)
            assert all(b[j] == a[at[j]] for j in np.flatnonzero(at >= 0))


@pytest.mark.parametrize("cells", [16, 1 << 10])
def test_cells_that_passages_share(spark, monkeypatch, cells):
    """Counting hits in few cells, shared by many passages and shifts, loses nothing and finds nothing more."""
    docs = [f"{FILLER} {' '.join(t.split()[a : a + n])} {FILLER}" for _, t in ITEMS for a, n in ((0, 60), (7, 20), (30, 19), (40, 20))]
    docs += [ALIKE.format(*x) for x in PEOPLE]
    index, rule = Index.build(ITEMS + [(50 + k, ALIKE.format(*x)) for k, x in enumerate(PEOPLE)]), Rule()
    want = list(leaks.leaked(docs, index, rule))
    assert {(k, i) for k, i, *_ in want} == {(4 * i + c, i) for i, _ in ITEMS for c in (0, 1, 3)} | {(120 + k, 50 + k) for k in range(3)}
    monkeypatch.setattr(leaks, "CELLS", cells)
    assert list(leaks.leaked(docs, index, rule)) == want


def test_few_hits_are_sorted(monkeypatch):
    """Texts that share turns of phrase and first names with many passages, but no passage, are left out by counts."""
    rng = random.Random(1)
    given, family = VOCABULARY[:12], VOCABULARY[12:400]
    turn = "y dijo que {} {} fue a la villa de {} con el maestre de la nao y que no vio a {} {} en la plaza de la villa".format

    def passage() -> str:
        return ". ".join(turn(*(rng.choice(x).title() for x in (given, family, family, given, family))) for _ in range(4))

    index = Index.build([(k, passage()) for k in range(200)])
    texts = [" ".join(rng.choice(["de la villa", "y dijo que", "en la plaza", "mar", "sol", "luna", rng.choice(given)]) for _ in range(90)) for _ in range(40)]
    hits = sum(len(index.hits(index.code_all(leaks.tokens(t)))[0]) for t in texts)
    sorted_ = []
    shifts = leaks.Postings.shifts
    monkeypatch.setattr(leaks.Postings, "shifts", lambda self, each, at: (self is index.grams and sorted_.append(len(each)), shifts(self, each, at))[1])
    assert not list(leaks.leaked(texts, index, Rule()))
    assert hits > 100_000 and sum(sorted_) < hits / 4
