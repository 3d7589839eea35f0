import random

import pytest

from archiva.llm.scans import START, Model, Vocabulary, candidates, count_corpus, damage, decode, find_damage, fit, label, learn, letters, repair, repair_texts, split_text

random.seed(4)
NAMES = ["Zoilo Ruano", "Ana de Soto", "Pedro Oliva", "Luis Mar"]
HEADER = "ARCHIVO DE LA VILLA ROTA"


def sentence():
    return f"{random.choice(NAMES)} reconoce deber a {random.choice(NAMES)} la suma de {random.randint(2, 99)} ducados por cuatro cajones de vidrio, según consta en memoria firmada aparte."


def page(lines=True):
    words = f"{random.randint(1, 99)} Folio: {random.randint(1, 400)} .— Asunto: {sentence()} {sentence()}".split()
    cut = [" ".join(words[i : i + 7]) for i in range(0, len(words), 7)]
    if random.random() < 0.3:
        cut.insert(random.randint(1, len(cut) - 1), f"{HEADER} {random.randint(1, 99)}")
    return ("\n" if lines else " ").join(cut)


@pytest.fixture(scope="module")
def corpus():
    return [page(i % 3 > 0) for i in range(300)]


@pytest.fixture(scope="module")
def voc(spark, corpus):
    return learn(spark.createDataFrame([(t,) for t in corpus] + [(None,), ("",)], "t string"), "t")


def test_learn(voc):
    assert [" ".join(h) for h in voc.headers] == [HEADER]
    assert voc.form("reconoce") > 100
    assert voc.form("Folio") > 100
    assert voc.form("Zoilo") == 0


@pytest.mark.parametrize(("text", "want"), [
    (None, []), ("", []), (" \n ", []), ("7 Folio: 12 .— Asunto: Ana de Soto reconoce deber cuatro cajones", []),
    ("Ana de Soto reco-\nnoce deber", [(4, "corte", "reconoce")]), ("Ana de Soto reco¬ noce deber", [(4, "corte", "reconoce")]), ("Ana de Soto reco\nnoce deber", [(4, "corte", "reconoce")]),
    ("según c0nsta en mem0ria firmada", [(2, "letra", "consta"), (4, "letra", "memoria")]), ("12 Fo1io: 7 .— 4sunto: Ana", [(2, "letra", "Folio")]), ("reconoce Zoi1o Ruano", []),
    ("Ana de Soto\n— 45 —\nreconoce deber", [(4, "pagina", "")]), ("Ana de Soto reconoce [45] deber", [(5, "pagina", "")]), ("Ana de Soto pág. 45 reconoce", [(4, "pagina", "")]),
    ("la suma de 30 ducados", []), (f"Ana de Soto\n{HEADER} 45\nreconoce deber", [(4, "encabezado", "")]), ("Ana de ARCHlVO DE LA VlLLA ROTA Soto", [(3, "encabezado", "")]),
    (f"Ana de reco- {HEADER} 9 noce deber", [(3, "corte", "reconoce"), (4, "encabezado", "")]), (f"Ana de Soto\n45\n{HEADER}\nreconoce", [(4, "pagina", ""), (5, "encabezado", "")]),
    ("años 1523-\n1524", []), ("x " * 30_000, []), ("Ana r\neConoce deber\nr\nEconoce", [(2, "corte", "reConoce")]),
])
def test_damage(voc, text, want):
    assert damage(text, voc) == want


def test_repair(voc):
    assert repair(f"Ana de reco-\n{HEADER} 9\nnoce c0nsta\n\nen la\nvilla\n— 3 —", voc) == "Ana de reconoce consta\n\nen la villa"
    assert repair(None, voc) is None
    clean = "Ana de Soto reconoce deber cuatro cajones"
    assert repair(clean, voc) == clean


@pytest.mark.parametrize("text", [
    "Ana de Soto palabr-\n\n— 45 —\n\nita", f"Ana de reco-\n\n{HEADER} 9\n\nnoce c0nsta en la villa", "según se hizo constar\n\n123\n\nen memoria firmada", f"la suma de\n\n— 7 —\n{HEADER}\n\n30 ducados", "reco\n\nnoce deber",
    "Ana de Soto según mem0r1a firmada",
])
def test_repair_leaves_no_damage(voc, text):
    fixed = repair(text, voc)
    assert damage(text, voc)
    assert damage(fixed, voc) == []
    assert "\n" not in fixed
    assert repair(fixed, voc) == fixed


def test_decoded_states(voc):
    """Headers and page numbers are what the model decodes, and its weights count."""
    tokens, line_of = split_text(f"Ana de Soto\n— 45 —\n{HEADER}\nreconoce deber")
    parts = label(tokens, line_of, [voc.act(t)[0] for t in tokens], voc)
    assert [(p.start, p.kind) for p in parts] == [(3, "pagina"), (6, "encabezado")]
    found = candidates(tokens, line_of, [voc.act(t)[0] for t in tokens], voc)
    assert decode(found, Model({**START, "ornate": -9.0, "own line": -9.0, "header": 0.0, "likeness": 0.0})) == []
    far = Model(START, {("pagina", "encabezado"): -99.0})
    assert [p.kind for p in decode(found, far)] == ["encabezado"]


def test_fit_moves_weights(corpus, voc):
    m = fit(corpus[:100], voc)
    assert set(m.weights) == set(START)
    assert any(abs(m.weights[k] - START[k]) > 1e-3 for k in START)
    assert all(abs(x) <= 2 for x in m.moves.values())
    assert fit([], voc) == Model()


def test_other_volumes_take_nothing_away(spark):
    """A header and the words of one volume, beside a hundred times as many texts of others."""
    mine = [(page(True), "T1") for _ in range(60)]
    other = [("Otros papeles sin marca alguna\nque nadie leyó nunca", f"T{k % 40 + 2}") for k in range(6000)]
    voc = learn(spark.createDataFrame(mine + other, "t string, v string"), "t", "v", sample=50)
    assert [" ".join(h) for h in voc.headers] == [HEADER]
    assert voc.form("reconoce") >= 60
    assert damage("Ana de Soto reco-\nnoce c0nsta", voc)[0] == (4, "corte", "reconoce")


def test_counts(spark):
    got = {(r.kind, r.key): r.n for r in count_corpus(spark.createDataFrame([("a b a",), (None,), ("a 12 b\nDe La Villa 7",)], "t string"), "t").collect()}
    assert got["w", "a"] == 3
    assert got["t", ""] == 2
    assert got["p", "a"] == got["n", "b"] == 1
    assert got["h", "De La Villa"] == 1


def test_frames(spark, voc):
    df = spark.createDataFrame([(1, "según c0nsta", None, 5), (1, "según c0nsta", "", 5), (2, None, "reco-\nnoce", 5)], "k long, a string, b string, pos int")
    rows = sorted(tuple(r) for r in find_damage(df, "k", ["a", "b"], voc).collect())
    assert rows == [(1, "a", 2, "letra", "consta")] * 2 + [(2, "b", 1, "corte", "reconoce")]
    assert {r.a for r in repair_texts(df, "k", ["a"], voc).collect()} == {"según consta", None}
    assert find_damage(df.limit(0), "k", ["a"], voc).count() == 0
    assert learn(df.limit(0), "a").headers == []
    assert damage("Ana", Vocabulary()) == []
    assert letters("Índ1ce!") == "indlcei" or letters("Índ1ce!").startswith("ind")


def test_query(spark, sf):
    from archiva.llm.queries_scans import p4_found

    df = p4_found(spark, sf)
    assert df.columns == ["contrato_idx", "campo", "pos", "tipo", "palabra"]
    assert {r.tipo for r in df.select("tipo").distinct().collect()} == {"corte", "letra", "encabezado", "pagina"}
