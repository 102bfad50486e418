"""XHTML acts, page texts, texts and tables in parts, registers and sinks, on inline rows."""

import json
import sqlite3
import xml.etree.ElementTree as ET
import zipfile

import pytest
from pyspark.sql import functions as F

from normwerk.operators import layout as L
from normwerk.sources import pages as P
from normwerk.sources import registers, sinks

XHTML = """<html xmlns="http://www.w3.org/1999/xhtml"><head><title>x</title></head><body><div class="eli-main-title"><p>Act on kites</p></div>
<div id="pbl_1"><p>Whereas kites fly.</p></div><div id="art_2a"><p class="oj-ti-art">Article 2a</p><p>Kites<br/>land.</p></div><div id="art_3"><p>No label here.</p></div>
<div id="anx_I"><table><tr><td>red</td></tr></table></div><div id="art_x">none</div></body></html>"""
LINES = "<html><body><p>Old act on kites<p>Artikel 1<br>Kites fly.<p>Artikel 2<p>They land, see Artikel 1.<p>ANHANG II<p>Second.<p>ANHANG I<p>Goes back.<p>ANHANG III<p>Third.</body>"


def test_xhtml_acts(spark):
    rows = {i.split("_", 2)[2] if kind != "document" else kind: (kind, f) for kind, i, _, _, f in P.xhtml_act("a", XHTML)}
    assert rows["document"][1] == {"title": "Act on kites", "parser": "xhtml"}
    assert rows["art_2a_text"][1]["text"] == "Article 2a\nKites\nland." and rows["art_2a"][1]["source_xml_identifier"] == "art_2a"
    assert set(rows) == {"document", "preambel", "preambel_text", "art_2a", "art_2a_text", "art_2", "art_2_text", "anhang_1", "anhang_1_text"}
    old = [(kind, f.get("number"), f.get("text")) for kind, _, _, _, f in P.xhtml_act("b", LINES)]
    assert [x[1] for x in old if x[0] == "unit"] == ["1", "2", "2", "3"] and old[4][2] == "Artikel 2\nThey land, see Artikel 1."
    got = P.extract_xhtml(spark.createDataFrame([("a", XHTML), ("b", LINES), ("c", None)], "path string, html string")).groupBy("path").count().collect()
    assert {r.path: r["count"] for r in got} == {"a": 9, "b": 9, "c": 1}


def test_page_texts(spark):
    files = spark.createDataFrame([("a/b.PDF", None), ("c", "Text/HTML; charset=x")], "path string, media string")
    assert [r.k for r in files.select(P.kind_of(F.col("path"), F.col("media")).alias("k")).collect()] == ["pdf", "html"]
    with pytest.raises(Exception, match="unknown format"):
        spark.createDataFrame([("a.doc", "x")], "path string, media string").select(P.kind_of(F.col("path"), F.col("media"))).collect()
    two = spark.createDataFrame([("x" * 100, "y" * 104), ("x" * 100, "y" * 106), (None, "y"), ("short", "y" * 7)], "a string, b string")
    assert [(r.l[0], r.s[0]) for r in two.select(P.longer_text(F.col("a"), F.col("b")).alias("l"), P.text_for_alignment(F.col("a"), F.col("b")).alias("s")).collect()] == [("x", "x"), ("y", "x"), ("y", "y"), ("y", "y")]
    text = [["Amtsblatt Seite 1", "§ 1 Zweck", "Drachen steigen.", "§ 1 Abs. 2 gilt"], ["Amtsblatt Seite 2", "Sie landen.", "17 05 03* Boden mit Stoffen", "§ 2 Höhe"], ["Amtsblatt Seite 3", "Hundert Meter ??", "Anlage 1 (zu § 2)"]]
    lines = spark.createDataFrame([("d", p, n, t) for p, page in enumerate(text, 1) for n, t in enumerate(page)], "document_id string, page int, line_no int, text string")
    kept = P.without_running_lines(lines)
    assert kept.count() == 8
    units = sorted((r.segment, r.heading, r.page_start, r.page_end, r.n_lines) for r in P.statute_units(kept).collect())
    assert units == [(1, "§ 1 Zweck", 1, 2, 5), (2, "§ 2 Höhe", 2, 3, 2), (3, "Anlage 1 (zu § 2)", 3, 3, 1)]
    assert [(r.code, r.hazardous, r.name) for r in P.waste_codes(lines).collect()] == [("17 05 03", True, "Boden mit Stoffen")]
    rules = spark.createDataFrame([("doubt", r"\?\?"), ("none", "zzz")], "rule string, pattern string")
    assert [(r.page, r.rule, r.line) for r in P.anomalies(lines.unionByName(lines), rules).collect()] == [(3, "doubt", "Hundert Meter ??")]
    page = spark.createDataFrame([("d", 1, "Drachenverordnung (DrachV)\nvom 3. Mai 2031\nStand: heute"), ("d", 2, "x")], "document_id string, page int, text string")
    assert P.first_page(page).first() == ("d", "Drachenverordnung (DrachV)", "DrachV", "3. Mai 2031", "heute")
    near = P.nearest_by_pages(spark.createDataFrame([("k", 5, 8)], "key string, page_start int, page_end int"), spark.createDataFrame([("k", "a", 1, 5), ("k", "b", 6, 9)], "key string, unit_id string, unit_start int, unit_end int"), "key")
    assert [r.unit_id for r in near.collect()] == ["b"]


def test_passages(spark):
    text = "1. Wind\n\nDrachen brauchen Wind.\nViel davon.\n\nUnd Schnur.\n\nRegen\n\n" + "nass " * 25 + "."
    assert P.paragraphs(text)[:2] == [("1. Wind", "Drachen brauchen Wind. Viel davon."), ("1. Wind", "Und Schnur.")]
    got = P.passages(text, 10, 2)
    assert got[0] == ("1. Wind", "Drachen brauchen Wind. Viel davon. Und Schnur.") and [len(x.split()) for _, x in got[1:]] == [10, 10, 10] and got[1][0] == "Regen"
    df = spark.createDataFrame([("d", 1, text), ("d", 2, None)], "document_id string, page int, text string")
    assert P.page_passages(df, 10, 2).count() == 4


def test_texts_in_parts():
    text = "\n".join(["kurz " * 5] * 4 + ["Ein Satz. " * 30] + ["w " * 100])
    parts = L.long_text(text, 50, 40)
    assert all(len(p.split()) <= 40 for p in parts) and " ".join(parts).split() == text.split() and L.long_text("a b", 5) == ["a b"] and L.long_text(" ") == []
    assert L.list_items("Kopf\n1. eins\nnoch\n2. zwei\n a) drei") == [("", "Kopf"), ("1", "eins\nnoch"), ("2", "zwei"), ("a", "drei")]
    assert L.subsections("(1) Eins.\n(7) kein Absatz\n(2) Zwei.\n") == [("1", "Eins.\n(7) kein Absatz"), ("2", "Zwei.")] and L.subsections("ohne") == [("", "ohne")]
    assert L.substitute_marks({"a [F1]": ["[F1] und [F9]", {"b": 3}]}, {"F1": "*"}) == {"a [*]": ["[*] und [F9]", {"b": 3}]}
    assert L.footnotes("x [a] y [c] [a]", {"a": "A", "b": "B"}) == ([("a", 1, "A")], ["c"], ["b"])
    dl = ET.fromstring("<DL><DT>1.</DT><DD>eins <B>fett</B><DL><DT>a)</DT><DD>unten</DD></DL> Rest</DD><DT>2.</DT><DD>zwei</DD></DL>")
    assert L.definition_list(dl) == [{"marker": "1.", "text": "eins fett Rest", "items": [{"marker": "a)", "text": "unten", "items": []}]}, {"marker": "2.", "text": "zwei", "items": []}]
    assert list(L.visible_strings({"unit_id": "no", "a": ["x", {"source_y": "no", "b": "y"}]})) == ["a", "x", "b", "y"]


def test_tables_from_pages():
    lines = ["Vorwort.", "Stoff   Wert   Art", "Blei   1   fest", "Metalle", "Zink   2", "* nur trocken", "Ende."]
    kinds = [k for k, _ in L.blocks(lines)]
    assert kinds == ["text", "table", "text"] and L.text_table(["nur ein", "Satz"]) is None
    t = L.text_table(lines[1:6])
    assert t["columns"] == ["Stoff", "Wert", "Art"] and t["rows"] == [{"Stoff": "Blei", "Wert": "1", "Art": "fest"}, {"_section": "Metalle", "Stoff": "Zink", "Wert": "2", "Art": ""}] and t["notes"] == ["* nur trocken"]
    assert L.text_table(["1  2", "3  4"])["columns"] == ["column_1", "column_2"]
    words = [(0, 0, 9, 9, "Art"), (20, 1, 29, 9, "Zahl"), (0, 20, 9, 29, "Eule"), (20, 20, 29, 29, "3"), (20, 40, 29, 49, "bis"), (30, 40, 39, 49, "4"), (0, 60, 9, 69, "Art"), (20, 60, 29, 69, "Zahl"), (0, 80, 9, 89, "Uhu")]
    g = L.grid_table(words, [40, 0, 15])
    assert g["rows"] == [{"Art": "Eule", "Zahl": "3 bis 4"}, {"Art": "Uhu", "Zahl": ""}]
    left = {"title": "", "columns": ["a", "b", "x"], "rows": [{"a": "1", "b": "2", "x": "p"}, {"a": "3", "b": "4", "x": ""}], "notes": []}
    right = {"title": "", "columns": ["a", "b", "x", "y"], "rows": [{"a": "1", "b": "2", "x": "q", "y": "r"}, {"a": "3", "b": "4", "x": "s", "y": ""}, {"a": "5", "b": "6", "x": "t", "y": "u"}], "notes": []}
    assert [r["x"] for r in L.merge_panels(left, right)["rows"]] == ["p | q", "s", "t"]
    assert L.parse_table({"words": words, "verticals": [0, 15, 40], "lines": lines})["columns"] == ["Art", "Zahl"] and L.parse_table({"lines": lines[1:5]})["columns"][0] == "Stoff" and L.parse_table({}) is None
    rows = L.emit_table("u", t)
    assert [(k, i) for k, i, _, _ in rows] == [("unit", "u"), ("chunk", "u_rows_1"), ("chunk", "u_rows_2"), ("chunk", "u_note_1")] and rows[1][3]["text"] == "Blei | 1 | fest"


def test_split_tables():
    rows = [{"a": f"r{i}", "b": "v" if i % 2 else f"r{i}"} for i in range(40)]
    assert L.split_table("T § 1", "Namen", ["a", "b"], rows, most=500)[0]["was_split"] is False
    parts = L.split_table("T § 1", "Namen", ["a", "b"], rows, most=60, target=50)
    assert sum(p["n_rows"] for p in parts) == 40 and all(len(p["text"].split()) <= 50 for p in parts) and parts[0]["text"].startswith("Tabelle: T § 1 — Namen\nSpaltenüberschriften:\na | b\nZeilen 1–") and "r0 | ↳" in parts[0]["text"]
    big = L.split_table("T", "", ["a"], [{"a": "x"}, {"a": "w " * 90}, {"a": "y"}], most=60, target=50)
    assert [(p["n_rows"], p["oversized"]) for p in big] == [(1, False), (1, True), (1, False)]


def test_more_registers(spark, tmp_path):
    with sqlite3.connect(tmp_path / "r.sqlite") as db:
        db.execute("create table files (id text, valid int, blob blob)")
        db.executemany("insert into files values (?, ?, ?)", [("a", 1, b"x"), ("b", 0, None), ("c", None, None)])
    db.close()
    got = registers.sqlite_rows(spark, str(tmp_path / "r.sqlite"), "select id, valid from files where valid is not 0", "id string, valid int").collect()
    assert {(r.id, r.valid) for r in got} == {("a", 1), ("c", None)}
    (tmp_path / "r2.json").write_text(json.dumps({"anomaly_patterns": [{"type": "z", "pattern": "q"}]}))
    (tmp_path / "r1.json").write_text(json.dumps({"anomaly_patterns": [{"type": "b", "pattern": "x"}, {"type": "a", "pattern": "y"}]}))
    assert [r.rule for r in registers.rules(spark, str(tmp_path / "r?.json")).collect()] == ["b", "a", "z"]
    (tmp_path / "cat.json").write_text(json.dumps({"documents": [{"id": "1", "title": "T", "aliases": ["x", ""]}, {"id": "2", "title": "T"}]}))
    assert {(r.alias, r.id) for r in registers.catalogue_aliases(spark, str(tmp_path / "cat.json")).collect()} == {("T", "1"), ("x", "1"), ("T", "2")}
    with zipfile.ZipFile(tmp_path / "c.zip", "w") as z:
        for n in ("b/Zwei.pdf", "a/zwei.PDF", "x.txt", "Eins.pdf"):
            z.writestr(n, n)
    found = registers.collection(spark, str(tmp_path / "c.zip")).collect()
    assert [(r.member, r.id[:4]) for r in found] == [("a/zwei.PDF", "zwei"), ("b/Zwei.pdf", "zwei"), ("Eins.pdf", "eins")] and len({r.id for r in found}) == 3
    for i in range(4):
        (tmp_path / f"run{i}.json").write_text(json.dumps({"conversation_id": "c" if i % 2 else "d", "n": i}))
        import os

        os.utime(tmp_path / f"run{i}.json", (10_000 + i, 10_000 + i))
    runs = lambda *a: [r.n for r in registers.run_logs(spark, str(tmp_path / "run*.json"), *a).collect()]
    assert runs(2, "conversation_id string, n int") == [3, 2] and runs(5, "conversation_id string, n int", "c") == [3, 1]
    for p in ("left", "right"):
        (tmp_path / "scores" / p).mkdir(parents=True)
        (tmp_path / "scores" / p / "s.json").write_text(json.dumps({"case_id": "1", "score": 2.0}))
    assert {(r.profile, r.score) for r in registers.artefacts(spark, str(tmp_path / "scores/*/*.json"), "case_id string, score double").collect()} == {("left", 2.0), ("right", 2.0)}


def test_more_sinks(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    old = spark.createDataFrame([("d", 0), ("d", 4)], "doc string, pos int")
    new = spark.createDataFrame([("d", "b"), ("d", "a"), ("e", "c")], "doc string, name string")
    assert {(r.doc, r.name, r.pos) for r in sinks.continue_positions(old, new, "doc", "pos", ["name"]).collect()} == {("d", "a", 5), ("d", "b", 6), ("e", "c", 0)}
    nodes = spark.createDataFrame([("n1", "A", "it's\nme", ["x"]), ("n2", "A", None, None), ("n3", "B", "y", None)], "id string, label string, title string, arr array<string>")
    edges = spark.createDataFrame([("n1", "n2", "NEXT")], "start_node_id string, end_node_id string, type string")
    sinks.write_csv(nodes, at("csv"), "label", ("title",))
    assert spark.read.option("header", "true").option("multiLine", "true").csv(at("csv")).columns[:2] == ["title", "id"] and sinks.checksums(spark, at("csv")).where("path like '%.csv'").count() >= 2
    assert [s.split(" ")[0] for s in sinks.load_statements(nodes, "label", "id", ["title"])] == ["CREATE", "CREATE", "LOAD", "LOAD"] and "-[:NEXT]->" in sinks.edge_statements(edges, "type", "id")[0]
    inline = {r.label: r.statement for r in sinks.inline_statements(nodes, "label", "id", ["title"], spread=1).collect()}
    assert inline["A"] == "UNWIND [{id: 'n1', title: 'it\\'s\\nme'}, {id: 'n2', title: null}] AS row MERGE (n:A {id: row.id}) SET n += row;"
    assert sinks.write_graph(nodes, edges, at("graph"))["labels"] == {"A": 2, "B": 1}
    asked = spark.createDataFrame([("p", "query", "x"), ("p", "query", "x"), ("p", "document", "x"), ("p", "query", None)], "profile string, purpose string, text string")
    miss = sinks.cache_misses(asked, spark.createDataFrame([], "profile string, purpose string, text_hash string"))
    assert miss.count() == 2 and sinks.cache_misses(asked, miss.where("purpose = 'query'")).count() == 1
    sinks.write_copies(nodes, at("copies"))
    assert spark.read.json(at("copies/json")).count() == 3 and "arr" not in spark.read.option("header", "true").csv(at("copies/csv")).columns
    pages = spark.createDataFrame([("d", 1, "a"), ("d", 2, "a"), ("e", 1, "b")], "document_id string, page int, text string")
    refs = sinks.publish_pages(pages, at("pages"))
    sinks.publish_pages(pages.limit(2), at("pages"))
    assert spark.read.parquet(at("pages")).count() == 2 and sinks.orphan_pages(spark.read.parquet(at("pages")), refs.where("document_id = 'd'")).count() == 1
    for text in ("one", "two"):
        sinks.write_text(spark, at("m.json"), text)
    assert (tmp_path / "m.json").read_text() == "two"
    sinks.append_journal(spark.createDataFrame([("i", "new", 1)], "item_id string, status string, seq bigint").coalesce(1), at("journal"))
    assert [(r.item_id, r.status) for r in registers.journal(spark, at("journal")).collect()] == [("i", "new")]
    assert "| b | 2 | x |" in sinks.markdown(spark.createDataFrame([("b", 2, "x"), ("a", 1, "y")], "code string, occurrences bigint, examples string"), "Audit")
    chunks = spark.createDataFrame([("d", 1, "§ <1>", "a & b", None, None), ("d", 2, "T", None, ["x"], [["1"], ["2"]]), ("d", 3, "W", None, [str(i) for i in range(13)], [[str(i) for i in range(13)]])], "document_id string, place int, label string, text string, columns array<string>, rows array<array<string>>")
    html = [r.html for r in sinks.rendered(chunks).orderBy("place").collect()]
    assert html[0] == "<h3>§ &lt;1&gt;</h3><p>a &amp; b</p>" and html[1].endswith("<tr><td>2</td></tr></table>") and html[2].count("<dt>") == 13
    for status in ("start", "done"):
        sinks.store_runs(spark.createDataFrame([("r1" if status == "start" else "r2", status), ("r2", status)], "run_id string, status string").dropDuplicates(), at("runs"))
    assert {(r.run_id, r.status) for r in spark.read.parquet(at("runs")).collect()} == {("r1", "start"), ("r2", "done")}


def test_file_faults(spark, tmp_path):
    from normwerk.sources import packages

    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("a", "b")
    good = (tmp_path / "z.zip").read_bytes()
    cases = [("p", b"%PDF-1.7 x %%EOF", "pdf", None), ("q", b"%PDF-1.7 x", "pdf", "no_pdf"), ("z", good, "zip", None), ("y", good[:20], "zip", "no_zip"), ("x", b"<a/>", "xml", None), ("w", b"<a>", "xml", "no_xml"), ("h", b"<a/>", "xhtml", "no_html"), ("e", b"", "xml", "empty"), ("d", b"<!DOCTYPE a [<!ELEMENT a ANY>]><a/>", "xml", "internal_dtd")]
    df = spark.createDataFrame([(p, bytearray(d), k) for p, d, k, _ in cases], "path string, content binary, kind string")
    assert {r.path: r.fault for r in packages.file_faults(df).collect()} == {p: f for p, _, _, f in cases if f}


def test_embedding_and_plan(spark):
    from normwerk.operators import vectors as V

    a, b, c = V.hash_embedding("Deich und Siel"), V.hash_embedding("siel UND deich"), V.hash_embedding("Drachen")
    dot = lambda x, y: sum(p * q for p, q in zip(x, y))
    assert abs(dot(a, b) - 1) < 1e-9 and dot(a, c) < 0.9 and abs(dot(V.hash_embedding(""), V.hash_embedding("")) - 1) < 1e-9
    texts = spark.createDataFrame([("1", "Deich"), ("2", None)], "item_id string, text string")
    assert [(r.item_id, len(r.vector)) for r in V.embedded(texts).collect()] == [("1", 64)]
    p = spark.createDataFrame([(str(i), "h", "x" * 936) for i in range(20)], "passage_id string, input_hash string, text string")
    plan = V.build_plan(p, p.limit(5), 1e6 / 3, 10_500.0, buckets=4).collect()
    assert sorted(r.state for r in plan) == ["budget_stopped"] * 5 + ["planned"] * 10 + ["unchanged"] * 5
