import json
import random

import numpy as np
import pytest

from normwerk.llm import split as S


def greedy(length, at, rank, limit, overlap):
    """The same rule, one cut after the other."""
    cuts, here = [0], 0
    while here < length:
        reach = limit if here == 0 else limit - overlap
        high = min(here + reach, length)
        if high == length:
            here = length
        else:
            near = [(r, p) for p, r in zip(at, rank) if here < p <= high]
            natural = [(r, p) for r, p in near if r >= S.SPACE]
            far = [(r, p) for r, p in natural if p > here + reach // 2]
            here = max(far)[1] if far else max(p for _, p in natural or near)
        cuts.append(here)
    return cuts


@pytest.mark.parametrize("seed", range(6))
def test_doubling_is_greedy(seed):
    rng = random.Random(seed)
    lengths, bounds = [], []
    for _ in range(20):
        n = rng.choice([0, 1, 50, 51, 99, 400, 3000])
        at = sorted(rng.sample(range(1, n), min(n - 1, n // rng.choice([2, 7, 30])))) if n > 1 else []
        hard = S._hard_boundaries(np.full(n, ord("x"), np.uint32), np.array(at, np.int64), 43)[0].tolist()
        both = sorted([(p, rng.randint(1, 5)) for p in at] + [(p, 0) for p in hard])
        lengths.append(n)
        bounds.append((np.array([p for p, _ in both], np.int64), np.array([r for _, r in both], np.int8)))
    got = S.solve(lengths, bounds, 50, 7)
    for n, (at, rank), cuts in zip(lengths, bounds, got):
        assert cuts.tolist() == (greedy(n, at.tolist(), rank.tolist(), 50, 7) if n else [0, 0][:len(cuts)])


def texts():
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefghijkäöüß", k=rng.randint(1, 12)))
    prose = "".join(word().capitalize() + " " + " ".join(word() for _ in range(rng.randint(3, 20))) + rng.choice([". ", ".\n", ".\n\n", "; ", ".\r\n\r\n"]) for _ in range(400))
    return {
        "prose": prose, "wall": "x" * 30_001, "marks": "a" + "é" * 9000, "spaces": " " * 9000, "emoji": "👍🏽" * 5000, "lines": "\n".join("y" * 90 for _ in range(200)),
        "mixed": "z" * 4100 + " " + prose[:5000], "edge": "q" * 4001, "leading": " \n" * 50 + "w" * 5000, "lone": "\ud800" * 10 if False else "u" * 4500,
    }


def test_pieces(spark):
    t = texts()
    rows = [("chunk", k, v) for k, v in t.items()] + [("chunk", "fits", "x" * 4000), ("chunk", "empty", ""), ("chunk", "null", None), ("chunk", None, "x" * 5000)]
    tables = {"t200": [{"a": str(i), "b": "" if i % 9 == 0 else "v"} for i in range(200)], "t60": [{"a": 1}] * 60, "t61": [None, [], {}, "s"] * 15 + [1]}
    rows += [("table", k, json.dumps(v)) for k, v in tables.items()] + [("table", "bad", "[1, 2"), ("table", "object", '{"a": 1}')]
    df = spark.createDataFrame(rows, "item_type string, item_id string, content string").selectExpr("*", "1 as start", "'x' as piece_no")
    got = {}
    for r in S.split_oversized(df).collect():
        got.setdefault(r.item_id, []).append(r)
    assert set(got) == {*t, "t200", "t61"}
    for k, pieces in got.items():
        pieces.sort(key=lambda r: r.piece_no)
        whole, limit, overlap, load = (tables[k], 60, 3, json.loads) if k in tables else (t[k], 4000, 200, lambda x: x)
        assert [p.piece_no for p in pieces] == list(range(len(pieces))) and {p.n_pieces for p in pieces} == {len(pieces)} and len(pieces) > 1
        back = load(pieces[0].content)
        for before, p in zip(pieces, pieces[1:]):
            c = load(p.content)
            assert p.overlap == min(overlap, before.end) and c[: p.overlap] == load(before.content)[-p.overlap :]
            back = back + c[p.overlap :]
        assert back == whole
        assert all(len(load(p.content)) <= limit for p in pieces)


def test_natural_boundaries():
    text = ("Satz eins hat viele Worte. " * 100 + "\n\n") * 4
    parts = S.cut_texts([text], 4000, 200)[0]
    assert all(text[:b].endswith("\n\n") or b == len(text) for _, b in parts)
    plain = "Nach Abs. 2 gilt Nr. 3 des Gesetzes sinngemäß. " * 200
    assert all(plain[:b].endswith("sinngemäß. ") for _, b in S.cut_texts([plain], 4000, 200)[0])
    rows = [{"n": str(i), "v": "x"} for i in range(50)] + [{"n": "Teil B", "v": ""}] + [{"n": str(i), "v": "x"} for i in range(100)]
    assert S.cut_tables([[json.dumps(r) for r in rows]], 60, 3)[0][0] == (0, 50)
    # a natural boundary in the nearer half comes before a place inside a word
    assert S.cut_texts(["Wort " * 100 + "x" * 9000], 4000, 200)[0][0] == (0, 500)


def test_tables_are_cut_in_their_text(spark):
    rows = ['{"a": 1.10}', '{"a":12345678901234567890.123}', '{"a": "raw\ttab, [x] \\" {y"}', "[1, [2, {}]]", '"s, \\\\"', "null", "1e400"] * 20
    text = " [ " + " ,\n".join(rows) + " ] "
    assert [text[a:b] for a, b in S.elements(text)] == rows and S.elements("[]") == S.elements(" [ ] ") == [] and S.elements("[7]") == [(1, 2)]
    df = spark.createDataFrame([("table", "t", text), ("table", "deep", "[" + ",".join(["[" * 900 + "]" * 900] * 70) + "]")], "item_type string, item_id string, content string")
    pieces = sorted((r for r in S.split_oversized(df).collect() if r.item_id == "t"), key=lambda r: r.piece_no)
    back = [e for r in pieces for e in [r.content[a:b] for a, b in S.elements(r.content)][r.overlap :]]
    assert back == rows and len(pieces) == 3 and {r.item_id for r in S.split_oversized(df).collect()} == {"t", "deep"}


def test_empty_input(spark):
    assert S.split_oversized(spark.createDataFrame([], "item_type string, item_id string, content string")).count() == 0
    with pytest.raises(ValueError):
        S.split_oversized(spark.createDataFrame([], "item_type string, item_id string, content string"), 100, 50)
