import json
import zipfile

import pytest

from normwerk.sources import acts, packages, registers, sinks
from normwerk.streaming import fold


def norm(label="", title="", body="", divisions=(), more=""):
    """One norm; divisions are (code, label, title)."""
    levels = "".join(f"<gliederungseinheit><gliederungskennzahl>{c}</gliederungskennzahl><gliederungsbez>{d}</gliederungsbez><gliederungstitel>{t}</gliederungstitel></gliederungseinheit>" for c, d, t in divisions)
    return f"<norm><metadaten><jurabk>WaldWO</jurabk>{more}{levels}<enbez>{label}</enbez><titel>{title}</titel></metadaten><textdaten><text><Content>{body}</Content></text></textdaten></norm>"


def grid(head, rows):
    line = lambda cells: "<row>" + "".join(f"<entry>{c}</entry>" for c in cells) + "</row>"
    return f'<table><tgroup cols="{len(head)}"><thead>{line(head)}</thead><tbody>{"".join(map(line, rows))}</tbody></tgroup></table>'


FELLING = "<dokumente doknr='W77'>" + "".join(
    [
        norm(more="<kurzue>Waldwegeordnung</kurzue><langue>Ordnung der Waldwege</langue>"),
        norm("Eingangsformel", body="<P>Aufgrund des Forstrechts wird verordnet:</P>"),
        norm(divisions=[("010", "Teil 1", "Wege")]),
        norm(divisions=[("010010", "Kapitel 1", "Breiten")]),
        norm("§ 3", "Rückewege", "<P>Rückewege sind<BR/>unbefestigt.</P><P>Ihre Breite steht im Wegebuch.</P>", [("010010", "Kapitel 1", "Breiten")]),
        norm("§ 4", "Lagerplätze", "<P>Holz lagert <I>neben</I> dem Weg.</P>" + grid(["Baum", "Tage"], [["Eiche", "40"], ["Fichte", "12"], ["Erle", "9"]]), [("010010", "Kapitel 1", "Breiten")]),
        norm("§ 3", "Noch einmal", "<P>Zweite Fassung.</P>", [("010010", "Kapitel 1", "Breiten")]),
        norm(divisions=[("020", "Teil 2", "Schluss")]),
        norm("Schlussformel", body="<P>Der Landtag hat zugestimmt.</P>", divisions=[("020", "Teil 2", "Schluss")]),
        norm("Anhang A", "Schilder", grid(["Form", "Farbe"], [["Raute", "gelb"], ["Pfeil", "blau"], ["Kreis", "rot"], ["Tafel", ""], ["Band", "weiß"]]) + "<P>Noch Schilder</P>" + grid(["Form", "Höhe"], [["Raute", "50"], ["Pfeil", "60"], ["Kreis", "70"], ["Tafel", "80"], ["Pfahl", "90"]])),
    ]
) + "</dokumente>"
REEF = """<ACT><TITLE><TI>Directive on reef surveys</TI></TITLE><PREAMBLE><PREAMBLE.INIT>Having regard to the tides,</PREAMBLE.INIT><GR.CONSID><CONSID>(7) Reefs move.</CONSID><CONSID>(8) Charts age.</CONSID></GR.CONSID></PREAMBLE>
<ENACTING.TERMS><ARTICLE><TI.ART>Article 14</TI.ART><STI.ART>Depths</STI.ART><PARAG><NO.PARAG>3.</NO.PARAG><ALINEA>Soundings are taken at noon.</ALINEA><ALINEA>Twice a year.</ALINEA></PARAG></ARTICLE>
<ARTICLE><TI.ART>Article 15</TI.ART><ALINEA>Charts are public.</ALINEA></ARTICLE></ENACTING.TERMS>
<ANNEX><TITLE><TI>ANNEX IV</TI></TITLE><CONTENTS><TBL COLS="2" NO.SEQ="9"><TITLE><TI>Buoys</TI></TITLE><CORPUS><ROW TYPE="HEADER"><CELL>Shape</CELL><CELL>Light</CELL></ROW><ROW><CELL COLSPAN="2">can</CELL></ROW><ROW><CELL>spar</CELL><CELL>green</CELL></ROW></CORPUS></TBL></CONTENTS></ANNEX></ACT>"""
QUAY = '<CONS.ACT><INFO.CONSLEG CONSLEG.REF="2041D0310" START.DATE="20410503" END="20500101"/><CONS.DOC><TITLE><TI>Quay decision</TI></TITLE><ENACTING.TERMS><DIVISION><TITLE><TI>TITLE II Berths</TI></TITLE><ARTICLE><TI.ART>Article 2a</TI.ART><ALINEA>Berths are numbered.</ALINEA></ARTICLE></DIVISION></ENACTING.TERMS><FINAL>Done at sea.</FINAL></CONS.DOC></CONS.ACT>'


def zipped(path, files):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in files.items():
            z.writestr(name, data)


def test_packages(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "felling.xml").write_text(FELLING)
    (d / "quay.xml").write_text("<!-- " + "tide " * 30_000 + "-->\n" + QUAY)
    zipped(d / "reef.zip", {"reef.doc.xml": "<DOC>" + "y" * 9000 + "</DOC>", "reef.xml": REEF, "chart.png": "p"})
    zipped(d / "outside.zip", {"a/../../x.xml": "<ACT/>"})
    zipped(d / "swollen.zip", {"x.xml": " " * 9_000_000})
    (d / "late_dtd.xml").write_text("<!--" + "x" * 2_000_000 + '--><!DOCTYPE ACT [<!ELEMENT ACT ANY>]><ACT/>')
    (d / "entity.xml").write_text('<!DOCTYPE ACT [<!ENTITY b "c">]><ACT/>')
    (d / "page.xml").write_text("<html/>")
    (d / "cut.xml").write_text(FELLING[:300])
    opened = packages.read_packages(spark, str(d), ("dokumente", "CONS.ACT", "ACT")).cache()
    found = {r.path.rsplit("/", 1)[1]: r for r in opened.collect()}
    refused = {"outside.zip": "unsafe_member", "swollen.zip": "compression_ratio", "late_dtd.xml": "internal_dtd", "entity.xml": "entity_declaration", "page.xml": "unexpected_root"}
    assert {k: r.issue for k, r in found.items()} == dict.fromkeys(found) | refused and len(found) == 9
    assert found["reef.zip"].member == "reef.xml" and [a.name for a in found["reef.zip"].assets] == ["chart.png", "reef.doc.xml"] and found["quay.xml"].root == "CONS.ACT"
    kinds = {(r.path.rsplit("/", 1)[1], r.record_kind) for r in acts.extract_acts(packages.good(opened)).collect()}
    assert ("cut.xml", "issue") in kinds and {f for f, k in kinds if k == "document"} == {"felling.xml", "quay.xml", "reef.zip"}


def rows_of(xml):
    return {i: (kind, parent, fields) for kind, i, parent, _, fields in acts.parse(xml)}


def test_statute_of_norms():
    rows = rows_of(FELLING)
    [(doc, (_, _, meta))] = [(i, r) for i, r in rows.items() if r[0] == "document"]
    assert meta["number"] == "W77" and meta["short_title"] == "Waldwegeordnung"
    unit = lambda key: f"unit_waldwo_{key}__{doc}"
    units = {i: (r[1], r[2]["unit_type"]) for i, r in rows.items() if r[0] == "unit"}
    assert units[unit("gliederung_010010")] == (unit("gliederung_010"), "division") and units[unit("gliederung_020")] == (doc, "division")
    assert units[unit("para_3")] == units[unit("para_3_part_2")] == (unit("gliederung_010010"), "paragraph")
    assert units[unit("eingangsformel")] == (doc, "preamble") and units[unit("schlussformel")][1] == "final" and units[unit("anhang_a")][1] == "annex"
    texts = [r[2]["text"] for r in rows.values() if r[0] == "chunk"]
    assert "Rückewege sind unbefestigt." in texts and "Holz lagert neben dem Weg." in texts
    table = rows[unit("anhang_a_tabelle_1")][2]
    assert table["columns"] == ["Form", "Farbe", "Höhe"] and table["row_count"] == 5  # four keys of five agree
    assert rows[unit("para_4_tabelle_1") + "_r1"][2]["cells"] == {"Baum": "Fichte", "Tage": "12"}


def test_groups_of_one_table():
    group = lambda head, *rows: grid(head, rows)[len("<table>") : -len("</table>")]
    same = f"<table>{group(['a', 'b'], ['1', '2'])}{group(['a', 'b'], ['3', '4'])}</table>"
    other = f"<table>{group(['a', 'b'], ['5', '6'])}{group(['c'], ['7'])}</table>"
    rows = rows_of(f"<dokumente doknr='T'>{norm()}{norm('§ 1', 'x', same + other)}</dokumente>")
    tables = [r[2] for r in rows.values() if r[2].get("unit_type") == "table"]
    assert [(t["columns"], t["row_count"], t["multi_tgroup_layout"]) for t in tables] == [(["a", "b"], 2, False), (["a", "b"], 1, True), (["c"], 1, True)]


def test_acts_of_articles():
    rows = rows_of(REEF)
    [doc] = [i for i, r in rows.items() if r[0] == "document"]
    base = doc.replace("doc_eu_", "celex_")
    assert rows[f"unit_{base}_art_14"][2]["title"] == "Depths" and rows[f"chunk_{base}_art_14_abs_3"][2]["text"] == "3. Soundings are taken at noon. Twice a year."
    assert [r[2]["text"] for i, r in rows.items() if "erwaegungsgrund" in i] == ["(7) Reefs move.", "(8) Charts age."]
    [table] = [i for i, r in rows.items() if r[2].get("unit_type") == "table"]
    assert rows[table][1] == f"unit_{base}_anhang_iv" and rows[f"{table}_r0"][2]["cells"] == {"Shape": "can", "Light": "can"}
    quay = rows_of(QUAY)
    assert quay["doc_eu_2041d0310"][2]["in_force"] is False and quay["unit_celex_2041d0310_art_2a"][1].startswith("unit_celex_2041d0310_gliederung_title_ii")


def test_tables():
    assert acts.expand([[("a", 1, 2), ("b", 2, 1)], [("c", 1, 1)]], 3) == [["a", "b", "b"], ["a", "c", ""]]
    assert acts.header_columns([["x", "x", ""], ["x", "y", ""]], 3) == ["x", "x / y", "column_3"]
    a = (["k", "v"], [["1", "a"], ["2", "b"]])
    assert acts.continue_table(a, (["k", "v"], [["3", "c"]]))[1] == [["1", "a"], ["2", "b"], ["3", "c"]]
    assert acts.continue_table(a, (["k", "w"], [["1", "c"], ["2", "d"]])) == (["k", "v", "w"], [["1", "a", "c"], ["2", "b", "d"]])
    assert acts.continue_table(a, (["k", "w"], [["8", "c"], ["9", "d"]])) is None
    assert acts.continue_table(a, (["k", "w"], [["1", "c"]])) is None
    many = (["k", "v"], [["1", "a"], ["", "b"], ["", "c"], ["", "d"], ["5", "e"]])
    assert acts.continue_table(many, (["other", "w"], [["1", "A"], ["", "B"], ["", "C"], ["", "D"], ["6", "E"]])) is None  # one key of two agrees
    assert acts.continue_table((["k", "v"], [["1", "a"], ["", "b"]]), (["Schlüssel", "w"], [["1", "A"], ["", "B"]]))[0] == ["k", "v", "w"]


def test_registers(spark, tmp_path):
    (tmp_path / "m1.json").write_text(json.dumps({"entries": [{"output_path": "x", "status": "ok"}, {"output_path": "y"}]}))
    (tmp_path / "m2.json").write_text(json.dumps({"results": [{"output_path": "z"}]}))
    (tmp_path / "m3.json").write_text("{broken")
    entries = registers.manifest(spark, str(tmp_path / "m*.json"))
    assert {r.output_path for r in entries.collect()} == {"x", "y", "z"}
    assert {r.output_path for r in registers.missing(entries, spark.createDataFrame([("x",)], "path string")).collect()} == {"y", "z"}
    j = tmp_path / "j"
    j.mkdir()
    (j / "a.jsonl").write_text('{"item_id":"i","status":"new","seq":1}\n{"item_id":"k","status":"new","seq":2}\n{"item_id":"i","status":"done","seq":3}\n{"item_id":"k","sta')
    assert {(r.item_id, r.status) for r in registers.journal(spark, str(j)).collect()} == {("i", "done"), ("k", "new")}
    (j / "a.jsonl").write_text('{"item_id":"i"\n{"item_id":"k","status":"new","seq":2}\n')
    with pytest.raises(Exception, match="damaged"):
        registers.journal(spark, str(j)).collect()
    (tmp_path / "n.csv").write_text('document_key,citation_alias_keys,text\nd1,|a|b|,"x\ny"\nd2,|b||,z\n')
    rows = registers.csv_chunks(spark, str(tmp_path / "n.csv"))
    assert {(r.alias, tuple(r.ids)) for r in registers.csv_aliases(rows).collect()} == {("a", ("d1",)), ("b", ("d1", "d2"))}
    (tmp_path / "c.xml").write_text("<items><item><title>A</title><link>https://h/a/xml.zip</link></item><item><title></title><link>https://h/b.zip</link></item></items>")
    assert [(r.title, r.url) for r in registers.catalogue(spark, str(tmp_path / "c.xml")).collect()] == [("A", "https://h/a/xml.zip")]
    html = '<p>Ein &sect; 1<br>und <b>mehr</b></p><script>p</script><ul><li>x</li></ul><a href="/a/xml.zip">XML</a><a href="https://h/a/xml.zip">again</a><a href="/c-xml.zip">c</a><a href="/d.zip">d</a><a href="https://other/xml.zip">XML</a>'
    pages = spark.createDataFrame([(1, html), (2, None)], "page_id int, html string")
    assert [(r.url, r.score, r["rank"]) for r in registers.page_links(pages, "h").orderBy("rank").collect()] == [("https://h/a/xml.zip", 17, 1), ("https://h/c-xml.zip", 5, 2)]
    assert [(r.tag, r.text) for r in registers.html_blocks(pages).orderBy("position").collect()] == [("p", "Ein § 1 und mehr"), ("li", "x")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "L", 1, ["x"]), ("b", "M", 2, ["y"])], "id string, label string, n int, arr array<string>")
    v1 = sinks.publish({"nodes": df}, str(tmp_path / "index"))
    v2 = sinks.publish({"nodes": df.limit(1)}, str(tmp_path / "index"))
    assert v1 != v2 and sinks.current(spark, str(tmp_path / "index"), "nodes").count() == 1
    sinks.write_csv(df, str(tmp_path / "csv"), "label")
    assert {(r.id, r.label) for r in spark.read.option("header", "true").csv(str(tmp_path / "csv")).collect()} == {("a", "L"), ("b", "M")}
    new = spark.createDataFrame([("a", "L", 9, ["z"])], df.schema)
    assert {(r.id, r.n) for r in sinks.upsert(df, new, ["id"]).collect()} == {("a", 9), ("b", 2)}
    assert {(r.id, r.n) for r in sinks.first_wins(df.unionByName(new), ["id"], ["n"]).collect()} == {("a", 1), ("b", 2)}
    assert len(sinks.load_statements(df, "label", "id", ["n"])) == 4
    assert len(sinks.load_statements(spark.range(1300).selectExpr("concat('L', id) as label", "id"), "label", "id", ["id"])) == 2600


def test_fold_batch_and_stream(spark, tmp_path):
    rows = [(1, 1, "start", 1.0), (1, 2, "delta", 2.5), (1, 2, "delta", 2.5), (2, 5, "start", None), (1, 3, "done", None), (2, 6, "done", 4.0)]
    schema = "run_id bigint, seq bigint, kind string, value double"
    batch = {tuple(r) for r in fold.fold(spark.createDataFrame(rows, schema)).collect()}
    assert batch == {(1, 3, 1, 3, "done", 3.5), (2, 2, 5, 6, "done", 4.0)}
    source = str(tmp_path / "events")
    spark.createDataFrame([rows[4], *rows[1:3]], schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).parquet(source)

    def keep(df, _):
        df.write.mode("append").parquet(str(tmp_path / "out"))

    for more in (None, [rows[0], rows[3], rows[5], rows[4]]):
        if more:
            spark.createDataFrame(more, schema).coalesce(1).write.mode("append").parquet(source)
        q = fold.fold_stream(stream).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    last = {tuple(r) for r in out.groupBy("run_id").agg({"n_events": "max", "total": "max"}).select("run_id", "max(n_events)", "max(total)").collect()}
    assert last == {(1, 3, 3.5), (2, 2, 4.0)}
