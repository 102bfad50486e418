import random

import numpy as np
import pytest

from normwerk.llm import leakage as L


def longest(a, b):
    best, prev = 0, {}
    for x in a:
        row = {}
        for j, y in enumerate(b):
            if x == y:
                row[j] = prev.get(j - 1, 0) + 1
                best = max(best, row[j])
        prev = row
    return best


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(30)] + ["Prüfung", "straße", "Ölung"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.choice([9, 10, 30, 80]))) for i in range(12)] + [(50, "Die " * 30), (51, ""), (52, None), (None, text(30))]
    docs = []
    for i in range(60):
        span = rng.choice(items[:12])[1].split()
        n = rng.choice([8, 9, 10, 11, 25])
        at = rng.randrange(max(1, len(span) - n))
        part = " ".join(span[at : at + n])
        form = rng.choice([str, str.upper, lambda s: s.replace(" ", ", \n"), lambda s: s.replace("rü", "rü"), lambda s: s.replace("ü", "ü-\n"), lambda s: s.replace("w1", "ｗ１"), lambda s: s.replace("straße", "stra­\nße")])
        docs.append((i, f"{text(rng.randint(0, 40))} {form(part)}. {text(rng.randint(0, 40))}"))
    return docs + [(100, None), (101, ""), (102, "die " * 5000), (None, "die " * 20), (0, docs[0][1])], items


@pytest.mark.parametrize("seed,bound", [(1, 2_000_000), (2, 0)])
def test_every_shared_span_is_found(spark, monkeypatch, seed, bound):
    docs, items = corpus(seed)
    monkeypatch.setattr(L, "MOST_BROADCAST", bound)
    monkeypatch.setattr(L, "MOST_IDS", bound)
    d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 as id", "2 as position")
    got = {(r.doc_id, r.item_id): r.n_words for r in L.leaks(d, spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    want = {}
    for di, dt in docs:
        for ii, it in items:
            if di is not None and ii is not None and dt and it and (n := longest(L.words(dt), L.words(it))) >= 10:
                want[di, ii] = n
    assert got == want and (102, 50) in got
    assert L.leaks(d.limit(0), spark.createDataFrame(items, "item_id bigint, text string")).count() == 0


def test_words():
    assert L.words("Kalk-\n ausgleich STRASSE straße ﬀ ä x_y 1a") == ["kalkausgleich", "strasse", "strasse", "ff", "ä", "x", "y", "1a"]
    assert L.words("3-\n4 End- und") == ["3", "4", "end", "und"]


def test_guarantee():
    rng = np.random.default_rng(1)
    for _ in range(300):
        span = rng.integers(0, 5, 10).astype(np.uint64)
        a, b = (np.concatenate([rng.integers(0, 5, rng.integers(0, 9)).astype(np.uint64), span, rng.integers(0, 5, rng.integers(0, 9)).astype(np.uint64)]) for _ in range(2))
        assert set(L.fingerprints_of(a, 7, 4)[0]) & set(L.fingerprints_of(b, 7, 4)[0])
