import numpy as np
import pytest

from normwerk.llm import neighbours as N

SCHEMA = "vec_id bigint, profile string, vector array<float>"


def by_hand(rows, k, floor=-2, query=lambda i: True):
    good = {}
    for i, p, v in rows:
        if v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = (p, np.asarray(v, np.float32).astype(float))
    out = set()
    for i, (p, v) in good.items():
        if query(i):
            s = sorted((-float(v @ w / np.linalg.norm(v) / np.linalg.norm(w)), j) for j, (q, w) in good.items() if j != i and q == p)
            out |= {(i, j, r + 1) for r, (c, j) in enumerate(s[:k]) if -c >= floor}
    return out


def rows(seed, n):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 8))
    out = [(int(i), "p" if rng.random() < 0.8 else "q", (centres[rng.integers(6)] + rng.normal(size=8) * rng.choice([0.02, 0.5, 2])).astype(np.float32).tolist()) for i in range(n)]
    odd = [(n, "p", None), (n + 1, "p", []), (n + 2, "p", [0.0] * 8), (n + 3, "p", [float("nan")] + [1.0] * 7), (n + 4, "p", [float("inf")] + [1.0] * 7), (n + 5, "p", [1.0] * 7), (n + 6, "p", [None] + [1.0] * 7), (n + 7, "alone", [1.0] * 8)]
    return out + odd + out[:5]


@pytest.mark.parametrize("seed,blocks", [(1, 8), (2, 1)])
def test_nearest_is_exact(spark, monkeypatch, seed, blocks):
    data = rows(seed, 400)
    monkeypatch.setattr(N, "LEAST_BLOCKS", blocks)
    df = spark.createDataFrame(data, SCHEMA).selectExpr("*", "1 as rank", "2 as similarity")
    got = {(r.vec_id, r.neighbour_id, r.rank) for r in N.nearest(df, k=5, dimensions=8).collect()}
    assert got == by_hand(data, 5)
    near = {(r.vec_id, r.neighbour_id, r.rank) for r in N.nearest(df, k=3, dimensions=8, min_similarity=0.9).collect()}
    assert near == by_hand(data, 3, 0.9)
    from pyspark.sql import functions as F

    some = {(r.vec_id, r.neighbour_id, r.rank) for r in N.nearest(df, k=4, dimensions=8, is_query=F.col("vec_id") % 20 == 0).collect()}
    assert some == by_hand(data, 4, query=lambda i: i % 20 == 0)


def test_copies_and_ties(spark):
    data = [(i, "p", [1.0, 2.0] + [0.0] * 6) for i in range(9)] + [(20, "p", [2.0, 4.0] + [0.0] * 6)]
    got = {(r.vec_id, r.neighbour_id) for r in N.nearest(spark.createDataFrame(data, SCHEMA), k=5, dimensions=8).collect()}
    assert {(8, j) for j in range(5)} <= got and {(0, j) for j in range(1, 6)} <= got and len(got) == 50
    assert N.nearest(spark.createDataFrame([], SCHEMA), dimensions=8).count() == 0


def test_panels_match(monkeypatch):
    monkeypatch.setattr(N, "PANEL_ROWS", 7)
    monkeypatch.setattr(N, "PANEL_COLUMNS", 11)
    rng = np.random.default_rng(5)
    a, b = (x / np.linalg.norm(x, axis=1)[:, None] for x in (rng.normal(size=(40, 16)), rng.normal(size=(50, 16))))
    ha, hb = N.tile(np.arange(40), a, np.arange(100, 150), b, False, True, 3, -np.inf)
    s = a @ b.T
    assert (ha.nbr == np.argsort(-s, axis=1, kind="stable")[:, :3] + 100).all()
    assert (hb.nbr == np.argsort(-s.T, axis=1, kind="stable")[:, :3]).all()
