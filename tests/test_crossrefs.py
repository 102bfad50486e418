"""Citations and what they mean: lists and ranges, names, chains, acts, headings, tables, roll-up."""

import pytest

from normwerk.operators import citations, crossrefs

LAWS = [("hafen", "Hafenordnung", "HafenO"), ("lotse", "Deutsches Lotsgesetz", "LotsG"), ("doppel1", "Doppelgesetz", None), ("doppel2", "Doppelgesetz", None)]
KEYS = ["hafen", "hafen_para_3", "hafen_para_4", "hafen_para_4_abs_2", "hafen_para_9", "hafen_para_9_abs_1", "hafen_para_9_abs_2", "hafen_art_2", "hafen_anlage_1", "lotse", "lotse_para_3", "lotse_para_5", "lotse_para_7", "verordnung_eu_2016_679", "verordnung_eu_2016_679_art_6", "tafel_para_8"]


# text, enclosing unit, table context, what is found
I, X, MISSING = "internal", "exact", "target_unit_missing"
CASES = [
    ("Nach § 4 Abs. 2 Nr. 1 und § 77 gilt Anlage 8.", None, [("hafen_para_4_abs_2", I, X), ("hafen_para_77", I, MISSING), ("hafen_anlage_8", I, MISSING)]),
    ("Artikel 2 und Artikel 99 gelten.", None, [("hafen_art_2", I, X)]),  # articles only if there
    ("Absatz 2 und Absatz 7 gelten nicht.", None, [("hafen_para_9_abs_2", "bare", X)]),
    ("§ 3 Abs. 9 gilt.", None, [("hafen_para_3_abs_9", I, "nearest_ancestor")]),
    ("§ 9 Abs. 1 gilt.", None, []),  # the unit itself
    ("Es gilt § 5 LotsG.", None, [("lotse_para_5", "external_name", X)]),
    ("Es gelten § 3, § 5 und § 7 des Deutschen Lotsgesetzes.", None, [("lotse_para_3", "external_chain", X), ("lotse_para_5", "external_chain", X), ("lotse_para_7", "external_name", X)]),
    ("§ 5 LotsG gilt. Ferner § 7 desselben Gesetzes.", None, [("lotse_para_5", "external_name", X), ("lotse_para_7", "external_back", X)]),
    ("§ 4 der Hafenordnung gilt.", None, [("hafen_para_4", I, X)]),  # its own name
    ("§ 3 des Doppelgesetzes gilt.", None, [("hafen_para_3", I, X)]),  # an ambiguous name names nothing
    ("nach Artikel 6 der Verordnung (EU) 2016/679 zulässig", None, [("verordnung_eu_2016_679_art_6", "external_act", X)]),
    ("die Durchführungsverordnung (EU) 2016/679 gilt", None, [("verordnung_eu_2016_679", "external_act", X)]),
    ("die Richtlinie 2008/98/EG gilt", None, [("richtlinie_2008_98_eg", "external_act", MISSING)]),
    ("Das Deutsche Lotsgesetz wird wie folgt geändert:\n1. § 5 wird aufgehoben.\n2. In § 7 wird das Wort gestrichen.", None, [("lotse_para_5", "scope", X), ("lotse_para_7", "scope", X)]),
    ("siehe § 8 und § 3", "tafel", [("tafel_para_8", "context", X), ("hafen_para_3", I, X)]),
    ("nichts", None, []), ("", None, []), (None, None, []),
]


def test_what_citations_mean(spark):
    rows = [(str(i), "hafen", "hafen_para_9_abs_1", context, text) for i, (text, context, _) in enumerate(CASES)]
    chunks = spark.createDataFrame(rows, "source_id string, document_key string, unit_key string, context_key string, text string")
    aliases = crossrefs.alias_index(spark.createDataFrame(LAWS, "document_key string, title string, abbreviation string"), ["title", "abbreviation"])
    targets = spark.createDataFrame([(k,) for k in KEYS], "key string")
    got = {i: [] for i in range(len(CASES))}
    for r in crossrefs.references(chunks, aliases, targets).collect():
        assert r.mention_text == CASES[int(r.source_id)][0][r.char_start : r.char_end]
        got[int(r.source_id)].append((r.char_start, r.requested_key, r.reference_kind, r.resolution))
    assert {i: [x[1:] for x in sorted(v)] for i, v in got.items()} == {i: c[2] for i, c in enumerate(CASES)}


def test_lists_and_ranges():
    assert citations.target_keys("§§", "3 bis 5") == ["para_3", "para_4", "para_5"]
    assert citations.target_keys("§§", "3 bis 90") == ["para_3", "para_90"]
    assert citations.target_keys("§§", "3 und 4 Abs. 2") == ["para_3", "para_4_abs_2"]
    assert citations.target_keys("§", "5 Abs. 1 und 3") == ["para_5_abs_1", "para_5_abs_3"]
    assert citations.target_keys("§", "7 Satz 2") == ["para_7"]
    assert citations.target_keys("Art.", "4 Abs. 2") == ["art_4"]


def test_rollup_and_levels(spark):
    r = spark.createDataFrame([("c1", "lotse", "lotse_para_5_abs_9", "lotse_para_5"), ("c1", "fern", "fern_para_1", None), ("c2", "hafen", "hafen_para_3", "hafen_para_3")], "source_id string, target_document_key string, requested_key string, resolved_key string")
    s = spark.createDataFrame([("c1", "u1", "d1"), ("c2", "u2", "d1")], "source_id string, unit_id string, document_id string")
    t = spark.createDataFrame([("lotse_para_5", "c9", "u9", "d9", "lotse"), ("hafen_para_3", "c3", "u3", "d1", "hafen")], "key string, chunk_id string, unit_id string, document_id string, document_key string")
    e = crossrefs.edges(r, s, t)
    got = {(x.level, x.start_node_id, x.end_node_id, x.end_kind) for x in e.collect()}
    assert got == {("chunk", "c1", "c9", "chunk"), ("unit", "u1", "u9", "unit"), ("document", "d1", "d9", "document"), ("chunk", "c1", "target:fern_para_1", "placeholder"), ("unit", "u1", "target:fern_para_1", "placeholder"), ("document", "d1", "target:fern", "placeholder"), ("chunk", "c2", "c3", "chunk"), ("unit", "u2", "u3", "unit")}
    kinds = spark.createDataFrame([(x, {"c": "chunk", "u": "unit", "d": "document"}[x[0]]) for x in "c1 c2 c3 c9 u1 u2 u3 u9 d1 d9".split()], "node_id string, kind string")
    assert crossrefs.assert_levels(e, kinds).count() == len(got)
    with pytest.raises(Exception, match="leaves its level"):
        crossrefs.assert_levels(spark.createDataFrame([("unit", "u1", "c9", "unit")], "level string, start_node_id string, end_node_id string, end_kind string"), kinds).collect()
