"""Orphan references, hierarchies and nested payloads against brute force on small rows."""

import datetime as dt
import json
import random

import pytest

from normwerk.functions import deepjson
from normwerk.operators import hierarchy as H
from normwerk.operators import nested, references

T0 = dt.datetime(2024, 1, 1)


def at(days):
    return T0 + dt.timedelta(days=days)


# ---- references ----

REFS = "record_table string, record_key string, ref_key string, ref_ts timestamp"
PARENTS = "parent_key string, parent_ts timestamp, alive boolean"


def orphans_by_hand(refs, parents):
    rows = {}
    for key, ts, alive in parents:
        k = (key or "").strip().lower()
        rows.setdefault(k, []).append(ts if alive else None)
    out = []
    for t, rk, key, ts in refs:
        k = (key or "").strip().lower()
        if not k:
            continue
        if k not in rows:
            out.append((t, rk, "missing"))
        elif not [x for x in rows[k] if x]:
            out.append((t, rk, "withdrawn"))
        elif ts is None or min(x for x in rows[k] if x) > ts:
            out.append((t, rk, "later"))
    return sorted(out, key=str)


def test_orphans_random_keys(spark):
    rng = random.Random(3)
    keys = [f"a_{i}" for i in range(700) if i % 97] + ["a_007", "a_07", "b", "B12", "c" + "9" * 25, "c" + "9" * 24, "0", "00", "x_-1", "über_3"]
    parents = [(rng.choice(["", " "]) + k + rng.choice(["", "  "]), at(rng.randint(0, 60)) if rng.random() > 0.02 else None, rng.random() > 0.2 if rng.random() > 0.02 else None) for k in keys if rng.random() > 0.1 for _ in range(rng.choice([1, 1, 2]))]
    asked = [*keys, "a_701", "a_-1", "a_", "a", "zz", None, "", "  ", "ÜBER_3", "a_0000"]
    refs = [("r", f"k{i}", rng.choice([k, k.upper() if k else k, f" {k} " if k else k]) if k else k, at(rng.randint(0, 60)) if rng.random() > 0.05 else None) for i, k in enumerate(asked * 3)]
    refs += [("r", "hot", "a_5", at(50))] * 400  # repeated and hot
    got = references.orphan_references(spark.createDataFrame(refs, REFS), spark.createDataFrame(parents, PARENTS), hot_rows=100)
    assert sorted(((r.record_table, r.record_key, r.reason) for r in got.collect()), key=str) == orphans_by_hand(refs, parents)


def test_orphans_empty_and_clashing_columns(spark):
    refs = spark.createDataFrame([], REFS)
    parents = spark.createDataFrame([], PARENTS)
    assert references.orphan_references(refs, parents).count() == 0
    some = spark.createDataFrame([("r", "1", "k1", at(1))], REFS).selectExpr("*", "'x' as runs_", "1 as n", "'m' as month")
    assert [r.reason for r in references.orphan_references(some, parents).collect()] == ["missing"]
    assert [(r.month, r.n_records) for r in references.count_orphans(references.orphan_references(some.drop("month"), parents)).collect()] == [("2024-01", 1)]


# ---- hierarchies ----

ROWS = "record_table string, node_id string, parent_id string, stamp timestamp, place string"


def tree_by_hand(rows):
    newest = {}
    for t, n, p, s, _ in rows:
        if n is None:
            continue
        p = p if p and p.strip() else None
        k = (s is not None, s or T0, p is not None, p or "")
        if (t, n) not in newest or k > newest[t, n][0]:
            newest[t, n] = (k, p)
    parent = {k: v[1] for k, v in newest.items()}
    out, below = {}, dict.fromkeys(parent, 0)
    for t, n in parent:
        walk, x = [], n
        while x is not None and (t, x) in parent and x not in walk:
            walk.append(x)
            x = parent[t, x]
        for a in walk[1:]:
            below[t, a] += 1
        if x in walk:
            ring = walk[walk.index(x) :]
            out[t, n] = (parent[t, n], None, None, None, min(ring), n in ring)
        else:
            out[t, n] = (parent[t, n], walk[-1], len(walk) - 1, walk[::-1], None, False)
    return {k: (*v, below[k]) for k, v in out.items()}


def rows_of(df):
    return {(r.record_table, r.node_id): (r.parent_id, r.root_id, r.depth, r.path, r.cycle_id, r.on_cycle, r.n_descendants) for r in df.collect()}


def forest(seed, n):
    rng = random.Random(seed)
    rows = []
    for t in ("u", "c"):
        for i in range(n):
            p = rng.choice([None, "", " ", f"n{rng.randrange(n)}", f"n{max(0, i - 1)}", f"n{i // 3}", "gone", f"n{i}" if rng.random() < 0.05 else f"n{i + 1}"])
            rows.append((t, f"n{i}", p, at(rng.randint(0, 5)) if rng.random() > 0.1 else None, rng.choice([None, "d1", "d2"])))
    rows += [(t, n, f"n{rng.randrange(50)}", at(9), p) for t, n, _, _, p in rng.sample(rows, n // 10)]
    rows += rows[:5] + [("u", None, "n1", at(1), "d1")]
    return rows


@pytest.mark.parametrize("seed,contract,largest", [(1, 200_000, 100_000), (2, 7, 100_000), (3, 7, 10), (4, 50, 0)])
def test_hierarchy(spark, monkeypatch, seed, contract, largest):
    rows = forest(seed, 150)
    monkeypatch.setattr(H, "CONTRACT_ROWS", contract)
    got = rows_of(H.hierarchy(spark.createDataFrame(rows, ROWS), max_component=largest))
    assert got == tree_by_hand(rows)


def test_contract_any_batch():
    tops = H._contract_rows(["t"] * 6, ["a", "b", "c", "x", "y", "z"], ["b", "a", "b", None, "x", "far"])
    assert tops == (["a", "a", "a", "x", "x", "z"], [None, None, None, None, None, "far"])


def test_long_chain_across_batches(spark, monkeypatch):
    rows = [("u", f"n{i}", f"n{i - 1}" if i else None, at(1), f"p{i % 7}") for i in range(300)] + [("u", f"m{i}", f"m{(i + 1) % 60}", at(1), f"p{i % 9}") for i in range(60)]
    df = spark.createDataFrame(rows, ROWS)
    # batches of one row: everything is left to the global labelling
    links = df.selectExpr("record_table", "node_id", "parent_id", "node_id as top", "parent_id as next")
    labels = {r.top: r.component for r in H._label_open(links).collect()}
    assert {labels[f"n{i}"] for i in range(1, 300)} == {"n0"}
    assert len({labels[f"m{i}"] for i in range(60)}) == 1
    got = rows_of(H.hierarchy(df))
    assert got["u", "n299"][2] == 299 and got["u", "n0"][6] == 299 and got["u", "m5"][4] == "m0"
    assert rows_of(H.hierarchy(df, max_component=50)) == got


def test_hierarchy_empty_and_descendants(spark):
    assert H.hierarchy(spark.createDataFrame([], ROWS)).count() == 0
    rows = [("u", "a", None, at(1), None), ("u", "b", "a", at(1), None), ("u", "c", "b", at(1), None)]
    pairs = H.descendants(H.hierarchy(spark.createDataFrame(rows, ROWS))).collect()
    assert sorted((r.ancestor_id, r.descendant_id, r.distance) for r in pairs) == [("a", "b", 1), ("a", "c", 2), ("b", "c", 1)]


# ---- nested payloads ----

PAYLOAD = {
    "results": [
        {
            "output_path": "x",
            "payload": {
                "documents": {
                    "document_id": "d1",
                    "structural_units": json.dumps([{"unit_id": "u1", "children": {"unit_id": "u2", "chunks": [{"chunk_id": "c1", "child_chunks": [{"chunk_id": "c2", "unit_id": "u1"}]}]}}, {"unit_id": "u3", "parent_unit_id": "u1"}, {"unit_id": "u4", "parent_unit_id": ""}]),
                    "chunks": [{"chunk_id": "c3", "unit_id": "u3"}, {"chunk_id": "c4", "unit_id": None}, {"chunk_id": 5}],
                }
            },
        }
    ]
}
CASES = {
    "cases": [
        {"id": "k1", "dialogue": {"facts": {"f1": {"answer": "text"}, "f2": {"answer": [{"id": "a1", "text": "x"}, {"id": "a2"}, None]}, "f3": {"match": "m"}}}},
        {"id": "k2", "dialogue": {"facts": [{"id": "f4", "answer": {"text": "y", "certain": True}}, {"id": "f5", "answer": {"id": "a3"}}]}},
        {"id": "k3", "dialogue": None},
        {"id": "k4", "dialogue": {"facts": {"id": "f6", "match": ["z"]}}},
    ]
}


def test_flatten(spark):
    rows = [(1, json.dumps(PAYLOAD)), (2, json.dumps(CASES)), (3, '{"documents": ['), (4, None), (5, " "), (6, "[]"), (7, "null"), (8, json.dumps(json.dumps({"documents": [{"document_id": "d9", "structural_units": None, "chunks": []}]}))), (2, json.dumps(CASES))]
    df = spark.createDataFrame(rows, "payload_id bigint, payload string").selectExpr("*", "'x' as record_kind", "1 as position")
    got = {(r.payload_id, r.record_kind, r.record_id, r.parent_id) for r in nested.flatten(df).collect()}
    assert got == {
        (1, "document", "d1", ""), (1, "unit", "u1", "d1"), (1, "unit", "u2", "u1"), (1, "unit", "u3", "u1"), (1, "unit", "u4", "d1"),
        (1, "chunk", "c1", "u2"), (1, "chunk", "c2", "c1"), (1, "chunk", "c3", "u3"), (1, "chunk", "c4", "d1"), (1, "chunk", "5", "d1"),
        (2, "case", "k1", ""), (2, "fact", "f1", "k1"), (2, "fact", "f2", "k1"), (2, "fact", "f3", "k1"), (2, "answer", "a1", "f2"), (2, "answer", "a2", "f2"),
        (2, "case", "k2", ""), (2, "fact", "f4", "k2"), (2, "fact", "f5", "k2"), (2, "answer", "a3", "f5"), (2, "case", "k3", ""), (2, "case", "k4", ""), (2, "fact", "f6", "k4"),
        (3, "invalid", "", ""), (8, "document", "d9", ""),
    }


def test_flatten_deep_and_tables(spark, tmp_path):
    deep = {"unit_id": "u300"}
    for i in range(299, -1, -1):
        deep = {"unit_id": f"u{i}", "children": [deep]}
    df = spark.createDataFrame([(1, json.dumps({"documents": [{"document_id": "d", "structural_units": deep}]}))], "payload_id bigint, payload string")
    tagged = nested.flatten(df)
    assert tagged.where("record_kind = 'unit'").count() == 301
    nested.write_tables(tagged, str(tmp_path / "t"))
    again = spark.read.parquet(str(tmp_path / "t"))
    units = nested.typed_table(again, "unit")
    assert {(r.unit_id, r.parent_id) for r in units.collect()} >= {("u0", "d"), ("u300", "u299")}
    assert nested.flatten(df.limit(0)).count() == 0


def test_no_bound_on_levels_and_encodings(spark):
    levels = 700
    deep = "".join('{"unit_id": "u%d", "children": [' % i for i in range(levels)) + "]}" * levels
    often = json.dumps([{"chunk_id": "c"}])
    for _ in range(7):
        often = json.dumps(often)
    rows = [(1, '{"structural_units": [' + deep + "]}"), (2, '{"chunks": ' + often + "}"), (3, '{"document_id": "d", "chunks": ' + json.dumps("[" * 500_000 + "]" * 500_000) + "}")]
    got = nested.flatten(spark.createDataFrame(rows, "payload_id bigint, payload string")).collect()
    assert {(r.record_id, r.parent_id) for r in got if r.payload_id == 1} == {(f"u{i}", f"u{i - 1}" if i else "") for i in range(levels)}
    assert [r.record_id for r in got if r.payload_id == 2] == ["c"] and not [r for r in got if r.payload_id == 3]


def test_json_of_any_depth():
    rng = random.Random(8)

    def value(depth):
        kind = rng.randrange(7 if depth else 4)
        return [None, True, rng.choice([0, -1.5, 1e300, 12345678901234567890]), rng.choice(["", 'a"\\\n', "ü€😀"]), [value(depth - 1) for _ in range(rng.randrange(4))] if depth else 0, {str(i): value(depth - 1) for i in range(rng.randrange(4))} if depth else 0, []][kind]

    for _ in range(300):
        v = value(4)
        assert deepjson._dumps(v) == json.dumps(v, ensure_ascii=False) and deepjson._loads(json.dumps(v)) == v
    for bad in ("", "[1,]", '{"a" 1}', "[1", "1 2", '{"a":1,}', "[01]", '"a', "{1:2}", "tru", "[1}"):
        with pytest.raises(ValueError):
            deepjson._loads(bad)
    deep = "[" * 200_000 + "1" + "]" * 200_000
    assert deepjson.dumps(deepjson.loads(deep)) == deep


def test_units_nested_deeper_than_json_recurses(spark):
    n = 60_000
    text = '{"documents": [{"document_id": "d", "structural_units": [' + "".join(f'{{"unit_id": "u{i}", "children": [' for i in range(n)) + "]}" * n + "]}]}"
    got = nested.flatten(spark.createDataFrame([(1, text), (2, "[" * 300_000)], "payload_id bigint, payload string")).groupBy("payload_id", "record_kind").count().collect()
    assert {(r.payload_id, r.record_kind): r["count"] for r in got} == {(1, "document"): 1, (1, "unit"): n, (2, "invalid"): 1}
