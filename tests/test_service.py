"""The retrieval tools on a small index: arguments out of bounds, cascades and outcomes."""

import duckdb
import pytest

from normwerk.operators import index as ix
from normwerk.plans import service
from normwerk.service import Outcome, Tools, answer, payload

DOCS = [("d1", "marsch", "Marschenordnung", "gii"), ("d2", "deich", "Deichordnung", "gii"), ("d3", "celex_1", "Dyke regulation", "eurlex"), ("d4", "deich_alt", "deichordnung", "gii")]
ALIASES = [("d1", "MarschO"), ("d2", "DeichO"), ("d4", "Deich-O"), ("d3", "Dyke regulation"), ("d1", "Marschenordnung"), ("d2", "Deichordnung"), ("d4", "Deichordnung alt")]
UNITS = [
    ("u0", "d1", None, "g0", "division", "Teil 1", "1", "Gräben", "MarschO Teil 1", 1), ("u1", "d1", "u0", "g1", "paragraph", "§ 6", "6", "Siele", "MarschO § 6", 2), ("u2", "d1", "u1", "g2", "subsection", "Abs. 2", "2", None, "MarschO § 6 Abs. 2", 3),
    ("u3", "d1", "u1", "g3", "subsection", "Abs. 3", "3", None, "MarschO § 6 Abs. 3", 4), ("u4", "d1", "u0", "g4", "paragraph", "§ 7", "7", "Leere", "MarschO § 7", 5), ("u5", "d2", None, "h1", "paragraph", "§ 6", "6", "Deiche", "DeichO § 6", 1), ("u6", "d1", "gone", "g6", "annex", "Anlage 1", "1", "Karten", "MarschO Anlage 1", 6),
]
TEXTS = [("p1", "d1", "u1", "Siele werden im Herbst geöffnet.", 1), ("p2", "d1", "u2", "Der Sielwärter öffnet das Siel.", 2), ("p3", "d1", "u3", "x" * 600, 3), ("p4", "d2", "u5", "Deiche werden im Herbst geschaut. HERBST.", 1), ("p5", "d1", "u6", " ", 9), ("p6", "d3", None, "Dykes are inspected.", 1)]


@pytest.fixture(scope="module")
def tools(spark, tmp_path_factory):
    docs = spark.createDataFrame(DOCS, "document_id string, document_key string, title string, source_kind string")
    units = spark.createDataFrame(UNITS, "unit_id string, document_id string, parent_unit_id string, global_key string, unit_type string, label string, number string, title string, legal_citation string, sequence int")
    rows = [(p, d, u, None, next((x[8] for x in UNITS if x[0] == u), None), t, n) for p, d, u, t, n in TEXTS]
    passages = spark.createDataFrame(rows, "passage_id string, document_id string, unit_id string, title string, legal_citation string, text string, sort_order int")
    index = ix.build(docs, spark.createDataFrame(ALIASES, "document_id string, alias string"), units, passages, str(tmp_path_factory.mktemp("index")))
    vectors = spark.createDataFrame([("p1", [1.0, 0.0]), ("p4", [0.8, 0.6]), ("p6", [0.0, 1.0])], "passage_id string, vector array<float>")
    edges = spark.createDataFrame([("u1", "u5"), ("u1", "u5"), ("u5", "u2"), ("u1", "u6")], "start_node_id string, end_node_id string")
    register = spark.createDataFrame([("d1", "Marschen", 3, "a"), ("x", "Marschen alt", 9, "b")], "id string, title string, graph_mention_count int, category string")
    return Tools(index, register, edges, vectors, lambda q: [1.0, 0.0])


def ids(df, column="document_id"):
    return [r[column] for r in df.collect()]


def test_documents(tools):
    assert ids(tools.find_documents("deich o", limit=0)) == ["d2"]  # the limit is one at least; exact by title, then id
    assert ids(tools.find_documents("DEICH-O", limit=99)) == ["d2", "d4"]
    ranked = tools.find_documents("Deichordnung neu", "de").collect()
    assert ranked[0].document_id in ("d2", "d4") and {r.document_id for r in ranked} == {"d2", "d4"} and all(r.score < 0 for r in ranked)
    assert ids(tools.find_documents("dyke regulation", "EU")) == ["d3"] and ids(tools.find_documents("dyke", "gii")) == [] and ids(tools.find_documents("§§")) == []
    assert tools.resolve_document("d3", "de").document_id == "d3"  # an id in any corpus
    assert answer(lambda: tools.outline("nothing of it")) == {"ok": False, "status": "document_not_found"}
    assert ids(tools.find_documents("deicho", corpus="unknown")) == []


def test_outline(tools):
    assert [(r.unit_id, r.depth, r.truncated) for r in tools.outline("MarschO", 1).collect()] == [("u0", 0, False), ("u1", 1, False), ("u4", 1, False), ("u6", 0, False)]
    assert [(r.unit_id, r.truncated) for r in tools.outline("d1", 7, 2).collect()] == [("u0", True), ("u1", True)]


def test_units(tools):
    assert ids(tools.find_units("d1", "§ 6"), "unit_id") == ["u1"] and ids(tools.find_units("d1", "g3"), "unit_id") == ["u3"] and ids(tools.find_units("d1", " "), "unit_id") == []
    assert ids(tools.find_units("d1", "Karten der Gräben"), "unit_id") == ["u0", "u6"] or set(ids(tools.find_units("d1", "Karten der Gräben"), "unit_id")) == {"u0", "u6"}
    assert tools.resolve_unit("d1", "§ 6 Abs. 3") == "u3" and tools.resolve_unit("d1", "MarschO § 6 Absatz 2") == "u2"
    assert tools.resolve_unit("d1", "§ 6 Abs. 9") == "u1"  # its unit, nothing that is only alike
    assert answer(lambda: tools.structural_unit("d1", "§ 99 Abs. 1")) == {"ok": False, "status": "unit_not_found"}
    whole = tools.structural_unit("d1", "§ 6 Abs. 2").collect()
    assert [(r.passage_id, r.matching) for r in whole] == [("p2", True)]
    below = tools.structural_unit("d1", "§ 6", max_chars=10).collect()  # 500 at least
    assert [(r.passage_id, r.truncated) for r in below] == [("p1", True), ("p2", True)]
    assert ids(tools.structural_unit("d1", "§ 6", include_descendants=False), "passage_id") == ["p1"] == ids(tools.unit_content("u1"), "passage_id")
    for unit in ("§ 7", "Anlage 1", "§ 6 Abs. 3"):  # no passage, a blank one, one longer than the budget
        assert answer(lambda unit=unit: tools.structural_unit("d1", unit, max_chars=1)) == {"ok": False, "status": "no_text"}


def test_search(tools):
    hits = lambda *a, **k: ids(tools.search_corpus(*a, **k)[0], "passage_id")
    assert hits("Herbst Siele") == ["p1"] and hits("Herbst Sturm") == hits("herbst") and set(hits("herbst")) == {"p1", "p4"}
    assert hits("Herbst", document_ref="DeichO") == ["p4"] and hits("inspected", corpus="de") == [] and hits("Herbst", document_ref="none")[:0] == []
    assert tools.search_corpus("Herbst", document_ref="none such")[1] == ["document_not_found"]
    assert hits("?", mode="semantic") == ["p1", "p4", "p6"] and hits("?", mode="semantic", limit=1) == ["p1"]
    assert hits("Dykes", mode="hybrid")[0] == "p6" or hits("Dykes", mode="hybrid")[0] == "p1"
    bare = Tools(tools.index)
    assert bare.search_corpus("Herbst", mode="hybrid")[1] == ["lexical_fallback"]
    assert answer(lambda: bare.search_corpus("x", mode="semantic")[0])["ok"] is False and answer(lambda: tools.search_corpus("x", mode="best")[0])["ok"] is False
    # a term in two spellings counts twice
    once, twice = (tools.index.search("passages", q).collect() for q in ("herbst", "herbst HERBST"))
    assert [round(2 * r.score, 5) for r in once] == [round(r.score, 5) for r in twice]


def test_context_register_references_status(tools):
    assert [(r.passage_id, r.truncated) for r in tools.context(["p2", "p1", "p6"], 1, 9).collect()] == [("p1", False), ("p2", False), ("p3", False), ("p6", False)]
    assert [(r.passage_id, r.truncated) for r in tools.context(["p2"], 1, 1, 1).collect()] == [("p1", True), ("p2", True)]
    assert answer(lambda: tools.context([])) == {"ok": False, "status": "passage_ids must not be empty"}
    assert [(r.id, r.indexed_for_fulltext) for r in tools.search_register("marschen").collect()] == [("d1", True), ("x", False)] and ids(tools.search_register("marschen", "b"), "id") == ["x"]
    assert [(r.source_node_id, r.target_node_id, r.neighbor_node_id, r.n) for r in tools.references("u5", "both").collect()] == [("u1", "u5", "u1", 2), ("u5", "u2", "u2", 1)]
    assert answer(lambda: tools.references("u5", "sideways"))["ok"] is False and answer(lambda: tools.status("nothing"))["ok"] is False
    assert {(r.component, r.name, r.total) for r in tools.status().collect()} >= {("retrieval", "passages", 6), ("neo4j", "rows", 4), ("vectors", "rows", 3), ("external_register", "rows", 2)}
    assert payload(tools.find_documents("deicho")) == [{"document_id": "d2", "document_key": "deich", "title": "Deichordnung", "matched_alias": "DeichO"}, {"document_id": "d4", "document_key": "deich_alt", "title": "deichordnung", "matched_alias": "Deich-O"}][: len(payload(tools.find_documents("deicho")))]


def test_queries_without_their_law(tools, monkeypatch):
    monkeypatch.setattr(service, "tools", lambda spark, root: tools)
    for query in ("tool_find_units", "tool_find_units_ranked", "tool_outline", "tool_structural_unit"):
        names = [c[0] for c in _small_sql(query).description]
        got = service.QUERIES[query](tools.index.spark, "")
        assert sorted(got.columns) == sorted(names) and got.collect() == []
    # another law that is named alike isn't asked
    assert service._of_law(tools, lambda: pytest.fail("asked"), "a int").collect() == []


def test_outcomes_of_queries(tools):
    """A unit without text keeps its rows, as in the SQL; a bad argument stays an error."""
    documents = tools.index.table("documents").replace("marsch", "eibarbg", ["document_key"])
    index = type("Stub", (), {"spark": tools.index.spark, "table": lambda self, name: documents})()
    t = type("Stub", (), {"index": index})()
    blank = service._of_law(t, lambda: tools.structural_unit("d1", "Anlage 1"), "a int").collect()
    assert [(r.passage_id, r.text, r.truncated) for r in blank] == [("p5", " ", False)]
    with pytest.raises(Outcome, match="direction"):
        service._of_law(t, lambda: tools.references("u5", "sideways"), "a int")


def _small_sql(query, root="/root/testdata/sf0.001"):
    db = duckdb.connect()
    for t in ("core_laws", "structural_units", "chunks"):
        db.execute(f"create view {t} as select * from '{root}/{t}.parquet'")
    return db.execute(service.SQL[query])


@pytest.fixture(scope="module")
def no_unit(tmp_path_factory):
    """The law alone, without the units that the queries ask for."""
    root, db = str(tmp_path_factory.mktemp("no_unit")), duckdb.connect()
    kept = {"structural_units": "document_key = 'eibarbg' and unit_type not in ('paragraph', 'article', 'annex') and not regexp_matches(label, '^\\D*1$')", "chunks": "document_id in (select document_id from structural_units)"}
    for t in ("core_laws", "structural_units", "chunks", "refers_to_edges", "register_documents"):
        db.execute(f"create table {t} as select * from '/root/testdata/sf0.001/{t}.parquet' where {kept.get(t, 'true')}")
        db.execute(f"copy {t} to '{root}/{t}.parquet'")
    return root


def test_queries_without_their_unit(spark, no_unit):
    for query in ("tool_find_units", "tool_structural_unit"):
        assert _small_sql(query, no_unit).fetchall() == [] == service.QUERIES[query](spark, no_unit).collect()
