import itertools

import pytest
from pyspark.sql import functions as F

from archiva.llm.variants import Name, Surnames, attach, given, linked_nodes, pairs, parse


@pytest.mark.parametrize(("token", "want"), [
    ("Francisco", "francisco"), ("Fco.", "francisco"), ("Fca.", "francisca"), ("Fran.co", "francisco"), ("Curro", "francisco"), ("Juanillo", "juan"), ("Dieguillo", "diego"), ("Ju.º", "juan"), ("Jna.", "juana"),
    ("M.ª", "maria"), ("Xpobal", "cristobal"), ("Ylario", "hilario"), ("BARTOLOMÉ", "bartolome"), ("Bme.", "bartolome"), ("Betriz", "beatriz"), ("Dom.º", "domingo"), ("Z.lo", "zoilo"), ("Paca", "francisca"),
])
def test_given(token, want):
    assert want in given(token)


def test_unknown_given():
    assert given("Quintaguijo") == ()
    assert set(given("D.go")) == {"diego", "domingo"}


@pytest.mark.parametrize(("text", "like"), [
    ("Quintaguijo, Juan de", "Juan de Quintaguijo"), ("Quintaguijo Juan", "Juan de Quintaguijo"), ("JUAN DE QUINTAGUIJO (?)", "Juan de Quintaguijo"), ('Juan "el Zurdo" del Quintaguijo', "Juan de Quintaguijo"),
    ("don Juan Quintaguijo", "Juan de Quintaguijo"), ("la dicha Ana Quintaguijo", "Ana Quintaguijo"), ("D. Juan de Quintaguijo", "Juan de Quintaguijo"), ("Cía. de Zarzafresno y Montellana", "Compañía de Zarzafresno y Montellana"),
    ("Zarzafresno & Montellana", "Compañía de Zarzafresno y Montellana"), ("Zarzafresno y Montellana, compañía", "Compañía de Zarzafresno y Montellana"), ("Compañía Zarzafresno-Montellana", "Compañía de Zarzafresno y Montellana"),
])
def test_parse(text, like):
    assert parse(text) == parse(like) is not None


def test_generation_tells_relatives_apart():
    assert parse("Juan Soto el Mozo") != parse("Juan Soto el Viejo") != parse("Juan Soto")


def test_surnames():
    s = Surnames.build({"quintaguijo": 100, "quintagijo": 3, "fuenmora": 50, "puenmora": 40, "navalsauco": 60})
    assert s.read("quintagijo") == s.read("quintaguiijo") == "quintaguijo"
    assert s.read("puenmora") == "puenmora"  # as frequent, so a surname of its own
    assert s.read("nabalzauco") == "navalsauco"
    assert s.read("otro") == "otro"
    assert Surnames.build({}).read("soto") == "soto"


def key(text):
    return parse(text).key()


def test_attach():
    forms = [(key("Domingo Quintaguijo"), 50), (key("Diego Quintaguijo"), 3), (key("D. Quintaguijo"), 2), (key("Ana Quintaguijo Montellana"), 9), (key("Ana Quintaguijo"), 1), (key("Ana Quintaguijo el Mozo"), 4)]
    got = {}
    for k, to, *_ in attach(forms):
        got.setdefault(k, []).append(to)
    assert got == {key("D. Quintaguijo"): [key("Domingo Quintaguijo"), key("Diego Quintaguijo")], key("Ana Quintaguijo"): [key("Ana Quintaguijo Montellana")]}
    assert list(attach([])) == []
    assert Name.of(key("D. Quintaguijo el Mozo")).key() == key("D. Quintaguijo el Mozo")


def test_all_names_count():
    """Companies that differ in the third partner, and persons in the fourth surname, are different."""
    assert key("Compañía de Zarzafresno, Vela y Soto") != key("Compañía de Zarzafresno, Vela y Montes")
    assert key("Ana Soto Vela Ruano Montes") != key("Ana Soto Vela Ruano Oliva")


def groups(spark, rows):
    df = spark.createDataFrame(rows, "nodo_id long, run_id string, persona string, frecuencia long")
    return {r.nodo_id: r.canonica for r in linked_nodes(df, "nodo_id", "run_id", "persona", "frecuencia").collect()}


def test_other_runs_change_nothing(spark):
    mine = [(1, "r1", "Juan de Quintaguijo", 20), (2, "r1", "Juan de Quintagijo", 1), (3, "r1", "J. Quintaguijo", 1), (4, "r1", "Ana Zarzafresno", 20), (5, "r1", "Ana Zarzafrezno", 1)]
    other = [(100 + k, f"s{k % 7}", f"Pedro de {a}{b}ero", 40) for k, (a, b) in enumerate(itertools.product(["Mon", "Val", "Cam", "Ribe", "Sal"], ["te", "ca", "mo", "lu", "ri", "pa"]))]
    alone = groups(spark, mine)
    assert alone[1] == alone[2] == alone[3] != alone[4] == alone[5]
    more = groups(spark, mine + other)
    assert {k: more[k] for k in alone} == alone


def test_long_chains(spark):
    """Links are followed to their end, however many there are."""
    rows = [(k, "r", " ".join(["Ana", "Quintaguijo", *["Vela", "Ruano", "Montes", "Oliva", "Lobo", "Prado", "Salas", "Rojas", "Campos", "Torres", "Pinto"][:k]]), 3**k) for k in range(12)]
    got = groups(spark, rows)
    assert len(set(got.values())) == 1


def test_frames(spark):
    people = {
        1: ["Juan de Quintaguijo", "Quintaguijo, Juan de", "J. Quintaguijo", "Juan de Quintagijo", '"Juan de Quintaguijo"'], 2: ["Ana Zarzafresno de Montellana", "Ana Zarzafresno"], 3: ["Ana Zarzafresno el Mozo"],
        4: ["Compañía de Montellana y Espinoceda", "Montellana & Espinoceda"], 5: ["Pedro de Quintaguijo"],
    }
    rows, want, i = [], set(), 0
    for run in ("r1", None):
        for texts in people.values():
            ids = []
            for t in texts:
                i += 1
                ids.append(i)
                rows.append((i, run, t, 30 if t == texts[0] else None))
            want |= set(itertools.combinations(ids, 2))
    rows += [(1000, "r1", "Juan de Quintaguijo; Ana Soto", 5), (1001, "r1", None, 5), (1002, "r1", "", 5), (1003, "r1", "[]", 5)]
    df = spark.createDataFrame(rows, "nodo_id long, run_id string, persona string, frecuencia long").withColumn("canonica", F.lit(1))
    got = pairs(linked_nodes(df, "nodo_id", "run_id", "persona", "frecuencia"), "nodo_id", "run_id")
    assert {tuple(r) for r in got.collect()} == want
    none = linked_nodes(df.limit(0), "nodo_id", "run_id", "persona", "frecuencia")
    assert pairs(none, "nodo_id", "run_id").count() == 0


def test_query(spark, sf):
    from archiva.llm.queries_variants import p2_found

    df = p2_found(spark, sf)
    assert df.columns == ["nodo_a", "nodo_b"]
    assert df.where("nodo_a >= nodo_b").count() == 0
    assert df.count() > 0
