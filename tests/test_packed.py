import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from archiva.operators.packed import explode_packed, scan

CASES = [
    ("persona", None, []),
    ("persona", "", []),
    ("persona", "[]", []),
    ("persona", " ; ;;", []),
    ("persona", "Ana de Soto; Juan Ruano", ["Ana de Soto", "Juan Ruano"]),
    ("persona", "Ana de Soto, Juan Ruano y Pedro Oliva", ["Ana de Soto", "Juan Ruano", "Pedro Oliva"]),
    ("persona", "Compañía de Soto y Ruano", ["Compañía de Soto y Ruano"]),
    ("persona", "Ana de Soto; Soto y Ruano, compañía", ["Ana de Soto", "Soto y Ruano, compañía"]),
    ("persona", "Quesada, Domingo de; Ana Soto", ["Quesada, Domingo de", "Ana Soto"]),
    ("persona", "Ana Soto y Compañía de Ruano y Oliva", ["Ana Soto", "Compañía de Ruano y Oliva"]),
    ("persona", "['Ana \"la Moza\" Soto', 'Juan Ruano']", ['Ana "la Moza" Soto', "Juan Ruano"]),
    ("persona", '["Ana \\"la Moza\\" Soto","Juan Ruano"]', ['Ana "la Moza" Soto', "Juan Ruano"]),
    ("persona", '"Ana ""la Moza"" Soto","Juan Ruano"', ['Ana "la Moza" Soto', "Juan Ruano"]),
    ("persona", "1) Ana Soto  2) Juan Ruano", ["Ana Soto", "Juan Ruano"]),
    ("persona", "(1) Ana Soto (2) Juan Ruano (?)", ["Ana Soto", "Juan Ruano (?)"]),
    ("persona", "1.- Ana Soto\n2.- Juan Ruano", ["Ana Soto", "Juan Ruano"]),
    ("persona", "Ana Soto / Juan Ruano | Pedro Oliva", ["Ana Soto", "Juan Ruano", "Pedro Oliva"]),
    ("persona", "Ana Soto · «Ruano, Juan»", ["Ana Soto", "Ruano, Juan"]),
    ("persona", "Ana Soto; Ana Soto", ["Ana Soto", "Ana Soto"]),
    ("nao", '"San Gil; alias La Garza"; San Telmo', ["San Gil; alias La Garza", "San Telmo"]),
    ("nao", "San Gil, alias La Garza", ["San Gil, alias La Garza"]),
    ("nao", "San Gil y San Telmo", ["San Gil y San Telmo"]),
    ("lugar", "Puerto Claro, Costa Brava", ["Puerto Claro, Costa Brava"]),
    ("lugar", "Puerto Claro, Villa Rota, en la isla de Sal", ["Puerto Claro", "Villa Rota, en la isla de Sal"]),
    ("lugar", "—; no consta; Villa Rota (isla de Sal)", ["Villa Rota (isla de Sal)"]),
    ("lugar", '"s/n"', []),
    ("lista", "a1, b2; c3 |", []),
    ("lista", "uno, dos; tres |", ["uno", "dos", "tres"]),
]


@pytest.mark.parametrize(("kind", "text", "want"), CASES)
def test_one(kind, text, want):
    got, _ = scan(pa.array([text], pa.string()), kind, frozenset({"costa brava"}))
    assert got.to_pylist() == want


def test_rows_are_independent():
    """A batch gives what its rows give alone, whatever stands beside them."""
    for kind in ("persona", "nao", "lugar", "lista"):
        texts = [t for _, t, _ in CASES]
        values, parent = scan(pa.array(texts, pa.string()), kind)
        together = [[v for v, p in zip(values.to_pylist(), parent, strict=True) if p == i] for i in range(len(texts))]
        alone = [scan(pa.array([t], pa.string()), kind)[0].to_pylist() for t in texts]
        assert together == alone


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="abñ Ñ;,|/\"'«»()[]12.)\n\t·y\\?", max_size=40)), max_size=5))
def test_any_text(texts):
    values, parent = scan(pa.array(texts, pa.string()), "persona")
    assert len(values) == len(parent)
    assert all(v.strip() == v and v for v in values.to_pylist())
    assert list(parent) == sorted(parent)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["Ana Soto", "Juan Ruano", "Pedro de Oliva", "Zoilo Mar"]), min_size=1, max_size=6), st.sampled_from(["; ", ";", " | ", "\n", " / ", "\t", ";; ", " · "]))
def test_round_trip(items, sep):
    values, _ = scan(pa.array([sep.join(items)]), "persona")
    assert values.to_pylist() == items


def test_frame(spark):
    df = spark.createDataFrame([(1, "Ana Soto; Juan Ruano", "x"), (2, None, "x"), (1, "Ana Soto; Juan Ruano", "x"), (None, "a" * 100_000 + " b; Zoilo Mar", "x")], "contrato_idx long, personas string, valor string")
    rows = explode_packed(df, "contrato_idx", {"personas": "persona"}).collect()
    assert sorted((r.contrato_idx or 0, r.pos, len(r.valor)) for r in rows) == [(0, 1, 100_002), (0, 2, 9), (1, 1, 8), (1, 1, 8), (1, 2, 10), (1, 2, 10)]
    assert explode_packed(df.limit(0), "contrato_idx", {"personas": "persona"}).count() == 0
    with pytest.raises(ValueError, match="kinds"):
        explode_packed(df, "contrato_idx", {"personas": "huh"})
