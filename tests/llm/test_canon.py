import pytest

from archiva.llm.canon import Gazetteer, expand, map_values, plain, set_cost, skeleton

PLACES = [(1, ("Puerto Claro", "Chamul"), "Costa Brava"), (2, ("Santa Tecla de Mar", None), "isla de Sal"), (3, ("Rada Mansa", None), "isla de Sal"), (4, ("Rada Mansa", ""), "isla de Pez"), (5, ("Villa Turpifuz", None), None)]
TRADES = [(1, ("sedero",), None), (2, ("maestro de letras",), None), (3, ("paje",), None), (4, ("escribano público",), None)]


@pytest.fixture(scope="module")
def lists():
    return {"lugar": Gazetteer.build("lugar", PLACES), "ocupacion": Gazetteer.build("ocupacion", TRADES)}


@pytest.mark.parametrize(("domain", "value", "want"), [
    ("lugar", None, 0), ("lugar", "", 0), ("lugar", " \n", 0), ("lugar", "no consta", 0), ("lugar", "—", 0), ("lugar", "s/n", 0),
    ("lugar", "Puerto Claro", 1), ("lugar", "PUERTO CLARO (?)", 1), ("lugar", "villa de Pverto Claro.", 1), ("lugar", "PuertoClaro", 1), ("lugar", "Puert oClaro", 1), ("lugar", "Chamvl", 1),
    ("lugar", "Pto. Claro, Costa Brava", 1), ("lugar", "Sta. Tecla de Mar", 2), ("lugar", "Santa Tecla de Mar, en la isla de Sal", 2),
    ("lugar", "Rada Mansa, isla de Pez", 4), ("lugar", "Rada Mamsa (isla de Sal)", 3), ("lugar", "Rada Mansa en la isla de Pez", 4), ("lugar", "Rada Mansa", 3),
    ("lugar", "Viya Tvrpifuç", 5), ("lugar", "Claro, Puerto", 1), ("lugar", "de Mar Santa Tekla", 2), ("ocupacion", "mercader sedero de paños finos", 0), ("ocupacion", "pxxe", 0), ("lugar", "Cabo Lejano", 0), ("lugar", "x" * 10_000, 0),
    ("ocupacion", "que es sedero", 1), ("ocupacion", "sederos", 1), ("ocupacion", "SEEDRO, su oficio", 1), ("ocupacion", "maestro sedero", 1), ("ocupacion", "maestro de letras", 2), ("ocupacion", "pjae", 3),
    ("ocupacion", "escno. púb.º", 4), ("ocupacion", "oficial escno. púb.º", 4), ("ocupacion", "domador de osos", 0),
])
def test_match(lists, domain, value, want):
    assert lists[domain].match(value) == want


def trades(spark, lists, counts, times=1):
    df = spark.createDataFrame([("ocupacion", v) for v, n in counts.items() for _ in range(n * times)], "dominio string, valor string")
    return {r.valor: r.ref_id for r in map_values(df, "dominio", "valor", lists).distinct().collect()}


def test_own_forms(spark, lists):
    """A trade that is as frequent in the data as the one it resembles is not taken for its misspelling."""
    got = trades(spark, lists, {"sedero": 100, "nevero": 90, "sedreo": 5, "severo": 2, "nevreo": 1})
    assert got == {"sedero": 1, "nevero": 0, "sedreo": 1, "severo": 1, "nevreo": 0}
    assert trades(spark, lists, {"sedero": 60, "nevero": 90, "severo": 2})["severo"] == 0


def test_size_does_not_matter(spark, lists):
    """The same values beside 100 times as many unrelated ones, and 20 times as many of all."""
    counts = {"sedero": 8, "sedreo": 1, "paje": 6, "pjae": 1, "nevero": 4, "domador de osos": 2}
    alone = trades(spark, lists, counts)
    assert alone == {"sedero": 1, "sedreo": 1, "paje": 3, "pjae": 3, "nevero": 0, "domador de osos": 0}
    more = trades(spark, lists, counts | {f"oficio {'abcdefghij'[k % 10]}{k}": 20 for k in range(60)} | {"maestro de letras": 900})
    assert {v: more[v] for v in counts} == alone
    assert trades(spark, lists, counts, 20) == alone


@pytest.mark.parametrize(("a", "b", "want"), [
    ("tecla santa de mar", "santa tecla de mar", 0), ("santa tekla mar", "santa tecla de mar", 2), ("sedero fino", "sedero", 4), ("sdeero", "sedero", 1), ("", "sedero", 6),
])
def test_set_cost(a, b, want):
    assert set_cost(a.split(), b.split(), 9) == want


def test_helpers():
    assert plain("  «Villa  Rota» (?) ") == "villa rota"
    assert expand("sta. tecla") == "santa tecla"
    assert skeleton("villa") == skeleton("viya")


def test_frame(spark, lists):
    df = spark.createDataFrame([("lugar", "Puerto Claro", 9), ("lugar", None, 9), ("lugar", "Puerto Claro", 9), ("otro", "sedero", 9)], "dominio string, valor string, ref_id int")
    got = map_values(df, "dominio", "valor", lists)
    assert sorted((r.dominio, r.valor or "", r.ref_id) for r in got.collect()) == [("lugar", "", 0), ("lugar", "Puerto Claro", 1), ("lugar", "Puerto Claro", 1), ("otro", "sedero", 0)]
    assert map_values(df.limit(0), "dominio", "valor", lists).count() == 0
    assert Gazetteer.build("lugar", []).match("Puerto Claro") == 0


def test_query(spark, sf):
    from archiva.llm.queries_canon import p3_found

    df = p3_found(spark, sf)
    assert df.columns == ["campo", "fila", "pos", "ref_id"]
    assert df.count() == df.select("campo", "fila", "pos").distinct().count() > 0
