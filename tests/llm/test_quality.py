import pytest

from archiva.llm.quality import autocorrelation, kind, measure, text_quality

COMMON = frozenset("que en con por se no su un una para los fue".split())
PROSE = "El escribano dijo que no tenía tinta. Por eso se fue con su libro en la mano, y no volvió hasta mayo.\n"
CASES = {
    "prosa": [
        None, "", "   ", PROSE * 2, PROSE.upper(), PROSE.lower().replace(".", "").replace(",", ""), PROSE.replace(" ", "\n", 9), "— " + PROSE, PROSE + "\n- pan\n- vino\n- sal\n" + PROSE,
    ],
    "lista": [
        "\n".join(f"{i}) Ana de Soto" for i in range(9)), "\n".join(["* pan", "* vino tinto", "* aceite", "* jabón"] * 3), "\n".join(f"Soto, Ana, {i}, {i + 7}" for i in range(9)),
        "PUERTO\n   Ana Soto\n   Juan Ruano\nVILLA\n   Pedro Oliva\n   Luis Mar\n" * 2, ", ".join(["Ana Soto", "Juan Ruano", "Pedro Oliva"] * 5), "\n".join(f"{i} cajas de loza;" for i in range(9)),
    ],
    "tabla": [
        "\n".join(f"{i}\tAna Soto\t15{i}" for i in range(9)), "| a | b |\n|---|---|\n" + "\n".join(f"| {i} | loza |" for i in range(9)), 'Nave,"Año"\n' + "\n".join(f"Santa Ana,{i}" for i in range(9)),
        "\n".join(f"{n:<12}{i:<8}folio" for i, n in enumerate(["Ana Soto", "Juan", "Pedro Oli", "Luis", "Zoilo"])), "a;b;c\n" + "\n".join(f"Ana;{i};sal" for i in range(9)),
    ],
    "ruido": [
        "@#~ %& {}|= ^^ ~~ ]]" * 9, "xkcd wrtz bbnm ghjk" * 20, "SIN TEXTO\n" * 30, "sello " * 200, "<caja>[[1, 2, 3, 4]]</caja>\n" * 3 + "<caja>[[9, 2, 3, 4]]</caja>", " ".join(PROSE.replace(" ", "")), "Â·Ã¡Â·Â·\nÂ¬Â¬Â¬" * 5,
        "Dradra surpefin vipe babaquel goltenviquel notagol drata. Cuvicu finmiru tenpel tendra ba bagol virufinta gollo. " * 3,
    ],
}


@pytest.mark.parametrize(("want", "text"), [(k, t) for k, ts in CASES.items() for t in ts])
def test_kind(want, text):
    m = measure(text, COMMON)
    assert kind(m) == want, m
    assert sum(m[f"{k}_share"] for k in ("prose", "list", "table", "noise")) == pytest.approx(1)


ENTRIES = "CABO ALTO\n{0}Ana de Soto\n{0}Luis Mar\nISLA SECA\n{0}Eva Ruano\n{0}Juan Oliva\n" * 3
RECORDS = PROSE + "Ana Soto y Luis\nIsla Seca\nEva Ruano y Ana\nCabo Alto\nJuan Oliva y Eva\nVilla Rey\n"


def test_layout_decides():
    """Texts of the same shares: indentation that comes back, lengths that do, and closed lines tell them apart."""
    m = measure(ENTRIES.format("   "), COMMON)
    assert m["indent_period"] > 0.6
    edge = m | {"prose_share": 0.55, "list_share": 0.45, "line_end_punct": 0.1, "sentence_share": 0.1}
    assert (kind(edge), kind(edge | {"indent_period": 0.0, "length_autocorrelation": 0.0})) == ("lista", "prosa")
    r = measure(RECORDS, COMMON)
    assert r["length_autocorrelation"] != 0
    rows = edge | {"indent_period": 0.0, "length_autocorrelation": 0.8}
    assert (kind(rows), kind(rows | {"length_autocorrelation": 0.0}), kind(rows | {"entry_starts": 0.3})) == ("lista", "prosa", "prosa")
    low = edge | {"indent_period": 0.0, "length_autocorrelation": 0.0, "prose_share": 0.45, "list_share": 0.55}
    assert (kind(low), kind(low | {"line_end_punct": 0.9})) == ("lista", "prosa")
    assert kind(low | {"prose_share": 0.55, "symbol_ratio": 0.4}) != "prosa"
    tie = edge | {"prose_share": 0.1, "list_share": 0.45, "table_share": 0.45, "length_autocorrelation": 0.0}
    assert (kind(tie | {"indent_period": 0.6}), kind(tie | {"indent_period": 0.0, "delimiter_alignment": 1.0})) == ("lista", "tabla")
    noisy = tie | {"table_share": 0.0, "noise_share": 0.45, "indent_period": 0.0}
    assert (kind(noisy), kind(noisy | {"mean_word_length": 30.0})) == ("lista", "ruido")


def test_figures():
    m = measure("uno dos, tres.\ncuatro 55", COMMON)
    assert (m["n_words"], m["mean_word_length"], m["line_end_punct"]) == (5, pytest.approx(4.0), 0.5)
    assert m["symbol_ratio"] == pytest.approx(2 / 20)
    assert autocorrelation([1, 5] * 10) == pytest.approx(0.9, abs=0.15)
    assert autocorrelation([3, 3, 3]) == 0


def test_frame(spark):
    df = spark.createDataFrame([(1, PROSE, "x"), (2, None, "x"), (1, PROSE, "x"), (3, "a\tb\n" * 50_000, None)], "doc_id long, text string, clase string")
    got = text_quality(df, "text", sorted(COMMON), "doc_id")
    assert sorted((r.doc_id, r.clase) for r in got.collect())[:3] == [(1, "prosa"), (1, "prosa"), (2, "prosa")]
    assert text_quality(df.limit(0), "text", [], "doc_id").count() == 0


def test_query(spark, sf):
    from archiva.llm.queries_quality import p8_found

    assert {r.clase for r in p8_found(spark, sf).collect()} <= {"lista", "tabla", "ruido"}
