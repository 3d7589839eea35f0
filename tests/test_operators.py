"""Rows worked out by hand for each operator."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from archiva.functions import quality as q
from archiva.functions import text as t
from archiva.operators import backends, compare, contracts, entities, graph, imaging, layout, panel, parse, segment, sequence, tuning


def one(spark, col, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(col(F.col("c")).alias("r")).collect()[0].r


@pytest.mark.parametrize(("f", "text", "want"), [
    (t.dehyphen, "pala-\n bra", "palabra"), (t.dehyphen_inline, "a-b-c", "ab-c"), (t.join_lines, " a \n\n b ", "a b"), (t.normalize_labels, ". Foiio: 23", ". Folio: 23"), (t.normalize_labels, ". Asnnto: X", ". Asunto: X"),
    (t.drop_repeated_sentences, "Fin de hoja. Fin de hoja. Fin de hoja. Otra.", "Fin de hoja. Otra."), (t.drop_repeated_sentences, "Uno. Dos. Tres.", "Uno. Dos. Tres."), (t.clean_ocr, None, ""), (t.clean_ocr, "  \n ", ""),
    (t.clean_ocr, "# Tit\n**negra** <|ref|>x<|/ref|> pala-\nbra", "Tit negra x palabra"), (t.clean_value, " .— Hola  tú ;", "Hola tú"), (t.volume_code, "Tomo_XVI", "16"), (t.volume_code, "Tomo_01", "01"), (t.volume_code, "foo", "00"),
    (t.literal_list, "['a', '', \"b's\", '...']", "a; b's"), (t.literal_list, " suelto ", "suelto"), (t.literal_list, None, ""), (t.split_list, " a ;;b; ", ["a", "b"]), (t.split_list, None, []), (t.safe_name, "Tomo I/2", "Tomo_I_2"), (t.is_record_start, "56. Libro del año: 1500", True), (t.is_record_start, "56 Iibro dei año", True), (t.is_record_start, "Nota: Libro del año", False),
    (t.is_running_header, "12 CATÁLOGO DE LOS F0NDOS AMERICAN0S", True), (t.is_running_header, "otra línea", False), (t.drop_repeated_lines, "una línea bastante larga\n\nuna línea bastante larga\nx\nx", "una línea bastante larga\n\nx\nx"), (t.roman, "XIV", 14), (t.roman, "ZZ", None),
])
def test_text(spark, f, text, want):
    assert one(spark, f, text) == want


def test_quality(spark):
    m = one(spark, q.metrics, "")
    assert (m.largo, m.ratio_alfa, m.chars_no_latino, m.lineas_repetidas) == (0, 0.0, 0, 0)
    assert one(spark, q.metrics, "aa\naa\naa 中").lineas_repetidas == 1
    assert one(spark, lambda c: q.page_flags(q.metrics(c), F.lit(100.0)), "") == ["bajo_alfa", "muy_corto"]
    assert one(spark, q.contract_flags, None) == ["vacio"]
    assert one(spark, q.output_flags, "1 2 3 4 5 6 7 8 9 0 1 2 3") == ["muy_corto", "bajo_alfa"]
    assert one(spark, lambda c: q.output_flags(c, 2), "<|det|>[[1, 2]]") == ["solo_tags", "muy_corto"]
    assert (q.ratio(None, " "), q.ratio("a", ""), q.ratio("abc", "abd")) == (1.0, 0.0, pytest.approx(2 / 3))


RECORD = "5 Libro del año: 1508. Oficio: I, Libro II. Escribanía: Mateo. Folio: 12. Asunto: X. Observaciones: Y"


def test_parse(spark):
    df = spark.createDataFrame([(1, RECORD, "old"), (2, "texto suelto", "old"), (3, None, "old"), (4, "", "old")], "k long, t string, anio string")
    rows = {r.k: r for r in parse.parse_text(df, "t").collect()}
    r = rows[1]
    assert (r.anio, r.anio_num, r.libro, r.escribania, r.folio, r.asunto, r.observaciones, r._parse_ok, r.n_subregistros) == ("1508", 1508, "Libro II", "Mateo", "12", "X", "Y", True, 1)
    assert r.oficio == "I"
    assert (rows[2].asunto, rows[2]._parse_ok, rows[2].anio_num) == ("texto suelto", False, None)
    assert rows[3].asunto == rows[4].asunto == ""
    assert parse.parse_report(parse.parse_text(df, "t")).collect()[0].n_ok == 1


def test_islands(spark):
    rows = [("T1", 1, 1, "contrato", "7 a"), ("T1", 1, 2, "contrato", "b"), ("T1", 2, 1, "continuacion", "c"), ("T1", 2, 2, "continuacion", None), ("T2", 1, 1, "continuacion", "e")]
    df = spark.createDataFrame(rows, "tomo string, page_num int, sort_idx int, class_name string, ocr_text_clean string")
    got = {r.island: r for r in contracts.group_records(df).collect()}
    assert [(got[i].n_crops, got[i].texto_completo, got[i].page_inicio, got[i].page_fin) for i in (1, 2, 3)] == [(1, "7 a", 1, 1), (2, "b c", 1, 2), (2, "e", 2, 1)]
    assert got[1].id_num == 7
    assert contracts.group_records(df.limit(0)).count() == 0
    assert one(spark, contracts.stitch, ["pala-", "bra y", "más.", "", "Fin"], "array<string>") == "palabra y más.\n\nFin"


def python_repair(ids, kinds):
    """The same rules in a plain loop."""
    last, anchor = None, []
    for i, v in enumerate(ids):
        if v is not None and (last is None or 0 < v - last < 100):
            last = v
            anchor.append(i)
    status, num, lost = [""] * len(ids), list(ids), []
    for i in anchor:
        status[i] = "ancla"
    for a, b in zip(anchor, anchor[1:], strict=False):
        want = list(range(ids[a] + 1, ids[b]))
        for i in range(a + 1, b):
            if (ids[i] is not None or kinds[i] != "continuacion") and want:
                num[i], status[i] = want.pop(0), "rellenado" if ids[i] is None else "corregido"
            else:
                status[i] = "header"
        lost += want
    for i in range(anchor[-1] + 1 if anchor else 0, len(ids)):
        if ids[i] is not None and anchor:
            status[i] = "sospechoso"
    return num, status, sorted(lost)


@pytest.mark.parametrize("ids", [[1, 2, 7, 5, 8, 300, 9], [2, None, 4], [2, None, 3], [2, None, 5], [2, 99999, 4], [9000, 1, 2], [None, None], "random"])
def test_repair(spark, ids):
    random.seed(7)
    groups = {f"g{k}": [random.choice([None, i + 1, i + 2, i + 3, 5000, 1]) for i in range(40)] for k in range(12)} if ids == "random" else {"g": ids}
    kinds = {g: [random.choice(["contrato", "contrato", "continuacion"]) if ids == "random" else "contrato" for _ in xs] for g, xs in groups.items()}
    rows = [(g, i, x, kinds[g][i]) for g, xs in groups.items() for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "tomo_id string, pos long, id_num long, class_origin string")
    out = sequence.repair(df).orderBy("orden", "sub", "id_num").collect()
    for g, xs in groups.items():
        mine = [r for r in out if r.tomo_id == g]
        num, status, lost = python_repair(xs, kinds[g])
        assert [(r.id_num, r.id_status) for r in mine if r.sub == 1] == list(zip(num, status, strict=True))
        assert sorted(r.id_num for r in mine if r.id_status == "perdido") == lost


def test_buried(spark):
    df = spark.createDataFrame([("T", 1, 87, "87 Libro del año: 1499. Asunto: A. fin 88. Libro del año: 1500. Asunto: B", "contrato"), ("T", 2, 89, "89 Libro del año: 1501", "contrato")], "tomo_id string, pos long, id_num long, texto_completo string, class_origin string")
    b = sequence.buried(df).collect()
    assert [(r.id_num, r.texto_completo[:12], r.orden, r.sub) for r in b] == [(88, "88. Libro de", 1, 2)]
    rows = sequence.resegment(df).orderBy("pos", "sub").collect()
    assert [(r.id_num, r.asunto, r.id_status) for r in rows] == [(87, "A. fin", ""), (88, "B", "resegmentado"), (89, "", "")]


def test_panel(spark):
    rows = [(1, "Tomo_II", 5, "A; B", "N", "", '{"A":{"oficio":"maestre"},"B":"hijo de C"}'), (2, "Tomo_X", None, None, "", None, "A::vecino || "), (3, "x", 7, "A", "", "L", "{broken")]
    df = spark.createDataFrame(rows, "contrato_idx long, tomo_id string, id_num long, personas string, naos string, lugares string, atributos string").withColumn("entidad", F.lit("clash"))
    p = panel.panelize(df)
    got = {(r.contrato_idx, r.tipo_entidad, r.entidad): r for r in p.collect()}
    assert set(got) == {(1, "persona", "A"), (1, "persona", "B"), (1, "nao", "N"), (2, "", ""), (3, "persona", "A"), (3, "lugar", "L")}
    assert got[1, "persona", "A"].ocupacion == "maestre"
    assert got[1, "persona", "B"].relacion == "hijo de C"
    assert got[1, "persona", "B"].idtomocontper == "02000502"
    assert got[2, "", ""].idtomocont == "100001"  # the first of its volume
    s = panel.sheets(p)
    assert {(r.persona, r.tiene_nao) for r in s["persona"].where("contrato_idx = 1").collect()} == {("A", 1), ("B", 1)}
    assert panel.panelize(df.limit(0)).count() == 0
    with pytest.raises(Exception, match="no record"):
        panel.prefix_until(df, "contrato_idx", "id_num", 99).collect()
    kept, heads = panel.split_headers(df)
    assert (kept.count(), heads.count()) == (2, 1)


def test_graph(spark):
    df = spark.createDataFrame([("A;B;B", "T1", 1500), ("A; B; C", "T2", None), ("D", "T1", None), (None, None, None), ("E;F", "T1", 1400)], "personas string, tomo_id string, anio_num long")
    e = graph.edges(df)
    assert {tuple(r) for r in e.collect()} == {("A", "B", 2), ("A", "C", 1), ("B", "C", 1), ("E", "F", 1)}
    n = {r.persona: r for r in graph.nodes(df, e).collect()}
    assert (n["B"].frecuencia, n["B"].grado, n["B"].grado_ponderado, n["B"].tomos, n["B"].anio_min) == (3, 2, 3, "T1; T2", 1500)
    assert (n["D"].grado, n["D"].anio_max) == (0, 0)
    c = {r.persona: r.componente for r in graph.components(graph.mentions(df.select("personas")).distinct(), e).collect()}
    assert c == {"A": "A", "B": "A", "C": "A", "D": "D", "E": "E", "F": "E"}
    s = graph.stats(df, graph.nodes(df, e), e, graph.components(graph.mentions(df.select("personas")).distinct(), e)).collect()[0]
    assert (s.nodos, s.aristas, s.componentes, s.gigante, s.contratos_con_2_o_mas) == (6, 4, 3, 3, 3)


def test_entities(spark):
    raw = 'Pienso... {"tipo":" PODER ","personas":["A ",1,""," B"],"naos":null,"lugares":["L",["x"]],"atributos":{"A":"hijo","Z":{"oficio":"x"},"B":{"oficio":"maestre"}}} ya'
    p = one(spark, lambda c: entities.normalize_payload(entities.json_in_prose(c)), raw)
    assert (p.tipo, p.personas, p.naos, p.lugares) == ("poder", ["A", "B"], [], ["L"])
    assert set(p.atributos) == {"A", "B"}
    assert (p.atributos["A"].relacion, p.atributos["B"].oficio) == ("hijo", "maestre")
    assert one(spark, lambda c: entities.normalize_payload(entities.json_in_prose(c)), "nada").tipo == "otros"
    assert one(spark, entities.record_type, "Juan OTORGA PODER y vende") == "poder"
    assert one(spark, lambda c: entities.mentioned(c, ["San Juan", "Cuba"]), "en la nao san juan") == ["San Juan"]
    assert one(spark, lambda c: entities.persons_by_list(c, ["Juan", "Ana"], ["Ruiz"]), "juan  ruiz y ANA RUIZ") == ["Juan Ruiz", "Ana Ruiz"]
    df = spark.createDataFrame([(1, "", "X"), (2, "t", "Y")], "idx long, tipo string, personas string")
    new = spark.createDataFrame([(1, "n"), (9, "n")], "idx long, tipo string")
    out, unknown = entities.apply_extractions(df, new, "idx", ["tipo", "personas"])
    assert {tuple(r) for r in out.collect()} == {(1, "n", ""), (2, "t", "Y")}
    assert [r.idx for r in unknown.collect()] == [9]


def test_backends(spark):
    df = spark.createDataFrame([(1, "a"), (2, ""), (3, "boom"), (4, None)], "pos long, asunto string")

    def answer(x):
        if x == "boom":
            return None
        return json.dumps({"tipo": "X", "personas": [x]})

    got = {r.pos: (r.tipo, r.personas) for r in backends.extract_entities(df, "pos", "asunto", lambda: backends.Stub(answer)).collect()}
    assert got == {1: ("x", "a"), 2: ("", ""), 3: ("", ""), 4: ("", "")}
    off = backends.extract_entities(df, "pos", "asunto", lambda: backends.Stub(answer, up=False))
    assert {r.tipo for r in off.collect()} == {""}
    good = "un texto bastante largo y con muchas letras para ser válido en todo"
    assert one(spark, backends.choose_attempt, ["1 2 3 4 5 6 7 8 9 1 2 3 4 5", good, "x"], "array<string>") == good
    assert one(spark, lambda c: backends.choose_attempt(c, "first"), ["1" * 24, "2" * 24], "array<string>") == "1" * 24


def test_http():
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Echo(BaseHTTPRequestHandler):
        def do_GET(self):
            self.send_response(200)
            self.end_headers()

        def do_POST(self):
            data = self.rfile.read(int(self.headers["Content-Length"]))
            self.send_response(200)
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Echo)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    model = backends.Http(f"http://127.0.0.1:{server.server_port}", lambda x: {"p": x}, lambda r: r["p"])
    assert model.available()
    assert model.run(["a", "ñ"]) == ["a", "ñ"]
    server.shutdown()
    server.server_close()
    assert not model.available()


def test_layout(spark):
    df = spark.createDataFrame([(50, 3, 40, 2)], "x1 int, y1 int, x2 int, y2 int").withColumns({"image_width": F.lit(60), "image_height": F.lit(9)})
    r = layout.clamp(df).collect()[0]
    assert (r.x1, r.x2, r.y1, r.y2) == (50, 51, 3, 4)
    r = layout.from_percent(spark.createDataFrame([(33.337, 0.0, 10.0, 10.0, 1000, 100)], "x double, y double, width double, height double, img_width int, img_height int")).collect()[0]
    assert (r.x0, r.y1) == (333, 10)
    lab = layout.parse_labels(spark.createDataFrame([("1 0.5 0.5 0.2 0.1",), ("bad line",)], "value string"))
    assert [(x["class"], x.cx) for x in lab.collect()] == [(1, 0.5)]
    turned = layout.rotate_labels(lab.withColumnRenamed("class", "k"), [0.0, 90.0], 100, 100).orderBy("angle").collect()
    assert [turned[0].x1, turned[0].y1, turned[0].x3] == pytest.approx([0.4, 0.45, 0.6])
    assert sorted([turned[1][f"x{i}"] for i in range(1, 5)]) == pytest.approx([0.45, 0.45, 0.55, 0.55])
    box = one(spark, layout.polygon_box, [(1.2, 2.0), (5.1, 3.9)], "array<struct<x:double,y:double>>")
    assert tuple(box) == (1, 2, 6, 4)


def python_gaps(p, share, least):
    low, out, start = max(p) * share, [], None
    for y, v in enumerate([*p, float("inf")]):
        if v <= low and start is None:
            start = y
        elif v > low and start is not None:
            if y - start >= least:
                out.append((start, y))
            start = None
    return out


def test_segment(spark):
    rng = np.random.default_rng(2)
    p = [float(x) for x in np.where(rng.random(300) < 0.03, 5, np.repeat(rng.choice([0, 9], 15), 20))]
    assert [tuple(g) for g in one(spark, lambda c: segment.find_gaps(c, 0.05, 10), p, "array<double>")] == python_gaps(p, 0.05, 10)
    assert one(spark, lambda c: segment.smooth(c), [11.0] + [0.0] * 9, "array<double>")[:6] == pytest.approx([1.0] * 6)
    assert one(spark, lambda c: segment.quantile(c, 0.6), [1.0, 5.0, 2.0, 9.0], "array<double>") == pytest.approx(np.percentile([1, 2, 5, 9], 60))
    page = [100.0] * 200 + [0.0] * 50 + [100.0] * 200 + [0.0] * 50 + [100.0] * 200 + [0.0] * 12 + [100.0] * 288
    df = spark.createDataFrame([(1, page), (2, []), (3, None)], "k int, profile array<double>")
    got = {r.k: r for r in segment.segment_pages(df).collect()}
    assert len(got[1].segments) == 3
    assert got[2].segments == got[3].segments == []


def test_imaging(spark):
    rng = np.random.default_rng(1)
    img = rng.integers(0, 256, (40, 50), dtype=np.uint8)
    f = imaging.figures(img)
    assert [f["mean"], f["std"], f["p25"], f["p90"]] == pytest.approx([img.mean(), img.std(), np.percentile(img, 25), np.percentile(img, 90)])
    w = np.lib.stride_tricks.sliding_window_view(np.pad(img, 1, mode="edge"), (3, 3)).reshape(40, 50, 9)
    assert (imaging.median(img, 3) == np.median(w, axis=-1)).all()
    assert set(np.unique(imaging.sauvola(img))) <= {0, 255}
    dots = np.full((20, 20), 255, np.uint8)
    dots[2, 2] = dots[3, 3] = dots[10:15, 10:16] = 0
    assert imaging.small_components(dots) == 1
    assert imaging.trim(dots).shape == (18 + 16, 19 + 16)
    assert (imaging.mend_strokes(dots, 1, 0) == dots).all()
    assert imaging.crop(img, 5, 6, 15, 16, 2).shape == (14, 14)
    df = spark.createDataFrame([(1, 40, 50, 1, bytearray(img.tobytes())), (2, 0, 0, 1, None)], "k int, height int, width int, nChannels int, data binary")
    got = {r.k: r for r in imaging.map_images(df, imaging.otsu).collect()}
    assert bytes(got[1].data) == imaging.otsu(img).tobytes()
    assert got[2].data is None


def test_tuning(spark):
    df = spark.createDataFrame([("a", i) for i in range(11)] + [("b", i) for i in range(3)], "tomo string, n int")
    assert [r.n for r in tuning.evenly(df, ["tomo"], "n", 3).where("tomo = 'a'").orderBy("n").collect()] == [0, 5, 10]
    assert tuning.evenly(df, ["tomo"], "n", 3).where("tomo = 'b'").count() == 3
    r = spark.createDataFrame([("a", "baseline", 10.0, 0), ("a", "x", 9.0, 1), ("b", "baseline", 10.0, 0), ("b", "x", 9.8, 1)], "tomo string, profile string, distance double, grid_pos int")
    assert {(x.tomo, x.profile, x.adopted) for x in tuning.best_profile(r, ["tomo"]).collect()} == {("a", "x", True), ("b", "x", False)}
    p = tuning.with_profile(df, spark.createDataFrame([("a", 7)], "tomo string, k int"), "tomo", {"k": 3, "m": 1})
    assert {(x.tomo, x.k, x.m, x.profile_name) for x in p.collect()} == {("a", 7, 1, "a"), ("b", 3, 1, "default")}
    listed = spark.createDataFrame([("12; 30",), (None,)], "pags string")
    images = spark.createDataFrame([("T", 12), ("T", 13)], "tomo string, page_num int")
    assert compare.pages_with_problems(listed, "pags", images).count() == 1


def test_codes_of_many_entities(spark):
    """120 entities, volumes over 99 and records without a number keep different codes."""
    names = ";".join(f"P{i}" for i in range(120))
    rows = [(5, "Tomo_II", 7, names), (6, "Tomo_II", None, "A"), (20_009, "Tomo_II", None, "B"), (7, "Tomo_120", None, "C"), (8, None, None, "D")]
    df = spark.createDataFrame(rows, "contrato_idx long, tomo_id string, id_num long, personas string").withColumns({c: F.lit(None).cast("string") for c in ("naos", "lugares", "atributos")})
    got = {(r.contrato_idx, r.entidad): r for r in panel.panelize(df).collect()}
    assert len({got[5, f"P{i}"].idtomocontper for i in range(120)}) == 120
    assert (got[5, "P8"].idper, got[5, "P99"].idper, got[5, "P119"].idtomocontper) == ("09", "100", "020007120")
    assert [got[k].idcont for k in ((6, "A"), (20_009, "B"), (7, "C"), (8, "D"))] == ["0002", "0003", "0001", "0001"]
    assert (got[7, "C"].idtomo, got[8, "D"].idtomo) == ("120", "00")


@pytest.mark.parametrize(("text", "want"), [
    ("a\nb\nc", "a b c"), ("a\n \nb", "a\n\nb"), ("a\n\n  b", "a\n\nb"), (" a \n\n\nb\n", "a\n\n\nb\n"), ("\na", "\na"), ("", ""), (None, None),
])
def test_soft_breaks(spark, text, want):
    assert one(spark, contracts.join_soft_breaks, text) == want


def test_single_page_stays(spark):
    assert one(spark, contracts.stitch, [" una página \n"], "array<string>") == " una página \n"
    assert one(spark, contracts.stitch, [], "array<string>") == ""


def test_first_box_opens_a_record(spark):
    rows = [("T1", 1, 1, "continuacion", "a"), ("T1", 1, 2, "contrato", "b"), ("T2", 1, 1, "continuacion", "c")]
    df = spark.createDataFrame(rows, "tomo string, page_num int, sort_idx int, class_name string, ocr_text_clean string")
    assert {r.ocr_text_clean: r.island for r in contracts.islands(df).collect()} == {"a": 1, "b": 2, "c": 2}


def test_one_bad_input(spark):
    """One input that fails leaves the answers of the others."""

    class Touchy:
        def available(self):
            return True

        def run(self, inputs):
            if "bad" in inputs:
                raise OSError("no answer")
            return [x.upper() for x in inputs]

    df = spark.createDataFrame([("a",), ("bad",), ("c",), (None,)], "x string").coalesce(1)
    assert [r.y for r in backends.infer(df, "x", Touchy, "y").collect()] == ["A", None, "C", None]


def test_stride(spark):
    df = spark.range(95).withColumn("k", (F.col("id") * 37) % 95).select("k")
    assert [r.k for r in tuning.stride(df, "k", 10).collect()] == list(range(0, 90, 9))
    assert tuning.stride(df.limit(0), "k").count() == 0


def test_projection(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert panel.project(df, ["b", "z"], "x").collect()[0].asDict() == {"b": 2, "z": "x"}
    assert panel.available(df, ["z", "b"]).columns == ["b"]


def test_volume_parts(spark):
    """The parts together are the stitched pages."""
    pages = {"A": ["pala-", "bra y", " ", "más.", None, "Fin"], "B": [" solo \n"], "C": ["uno:", "dos-"], "D": ["", ""]}
    df = spark.createDataFrame([(t, i, x) for t, xs in pages.items() for i, x in enumerate(xs)], "tomo string, page_num int, text string")
    got = dict.fromkeys(pages, "")
    for r in contracts.volume_parts(df, "text").orderBy("tomo", "page_num").collect():
        got[r.tomo] += r.parte
    for t, xs in pages.items():
        assert got[t] == one(spark, contracts.stitch, [x or "" for x in xs], "array<string>")
