import random

import pytest
from pyspark.sql import functions as F

from normwerk.llm import mixing as M

COUNTED = "doc_id bigint, source string, tokens bigint"
TARGETS = "source string, target_share double, max_repeats int"


def data(seed):
    rng = random.Random(seed)
    docs = [(i, rng.choice(["big", "Big ", "BIG", "big", "small", "tiny", "other", None]), rng.randint(0, 60)) for i in range(3000)]
    docs = [d for d in docs if d[1] != "tiny" or d[0] % 7 == 0]
    return docs + docs[:30] + [(None, "big", 5), (9001, "big", None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_shares(spark, seed):
    docs = data(seed)
    targets = [("big", 0.5, 1), ("Small", 0.3, 2), ("tiny", 0.1, 4), ("absent", 0.1, 3), ("none", None, 1)]
    m = M.mix(spark.createDataFrame(docs, COUNTED).withColumn("place", F.lit(1)), spark.createDataFrame(targets, TARGETS))
    rows = {r.source: r for r in m.shares.collect()}
    assert set(rows) == {"big", "small", "tiny", "absent"} and rows["absent"].actual_share == 0
    for s, want in (("big", 0.5 / 0.9), ("small", 0.3 / 0.9), ("tiny", 0.1 / 0.9)):
        assert abs(rows[s].actual_share - want) < 0.002 and rows[s].most_repeats <= rows[s].max_repeats
    chosen = m.chosen.collect()
    tokens = {d[0]: d[2] for d in docs}
    assert len({r.doc_id for r in chosen}) == len(chosen) and all(tokens[r.doc_id] == r.tokens > 0 for r in chosen)
    # the largest total: one source is used up to its cap
    supply = {}
    for i, s, n in {d[0]: d for d in docs}.values():
        if i is not None and s and n:
            supply[s.strip().lower()] = supply.get(s.strip().lower(), 0) + n
    assert any(r.tokens >= supply[s] * r.max_repeats - 60 for s, r in rows.items() if s in supply)
    order = M.in_order(m.positions).collect()
    assert len(order) == sum(r.copies for r in chosen) and all(0 <= r.position <= 1 for r in order)
    # over any stretch the sources have the scheduled shares: big falls, the others rise
    half = [r for r in order if r.position <= 0.5]
    first = sum(r.tokens for r in half)
    shares = {s: 0.5 / 0.9 if s == "big" else (0.3 if s == "small" else 0.1) / 0.9 for s in ("big", "small", "tiny")}
    for s, knots in M.tilt(shares, {"small", "tiny"}, 0.5).items():
        w0, w1 = knots[0][1], (knots[0][1] + knots[1][1]) / 2
        assert abs(sum(r.tokens for r in half if r.source == s) / first - shares[s] * (w0 + w1) / 2) < 0.02


def test_total_and_empty(spark):
    docs = [(i, "a" if i % 2 else "b", 10) for i in range(200)]
    t = spark.createDataFrame([("a", 0.7, 1), ("b", 0.3, 9)], TARGETS)
    m = M.mix(spark.createDataFrame(docs, COUNTED), t, total_tokens=1000)
    assert {r.source: r.tokens for r in m.shares.collect()} == {"a": 700, "b": 300}
    assert M.mix(spark.createDataFrame([], COUNTED), t).positions.count() == 0
    assert M.mix(spark.createDataFrame([(1, "a", 5)], COUNTED), t).shares.where("source = 'a'").first().actual_share == 1.0


def test_tokens(spark):
    df = spark.createDataFrame([(1, "a", "Das ist ein Satz."), (2, "a", None), (3, "b", ""), (4, "b", "wort " * 20000), (5, "b", "<|endoftext|>")], "doc_id bigint, source string, text string").withColumn("tokens", F.lit(1))
    got = {r.doc_id: r.tokens for r in M.count_tokens(df).collect()}
    assert got[2] == got[3] == 0 and got[1] >= 4 and got[4] >= 20000 and got[5] > 1


def test_inverse(spark):
    knots = [(0.0, 0.5, 0.0), (0.4, 1.5, 0.4), (1.0, 0.5, 1.0)]
    df = spark.createDataFrame([(c / 50, knots) for c in range(51)], "c double, knots array<struct<t:double,w:double,c:double>>")
    for r in df.select("c", M._invert(F.col("c"), F.col("knots")).alias("t")).collect():
        t = r.t
        integral = 0.5 * t + 1.25 * t * t if t <= 0.4 else 0.4 + (t - 0.4) * (1.5 + 1.5 - (t - 0.4) / 0.6) / 2
        assert abs(integral - r.c) < 1e-9


def test_given_schedules(spark):
    rows = [(i, "a" if i % 2 else "b", 10) for i in range(4000)]
    counted = spark.createDataFrame(rows, "doc_id bigint, source string, tokens bigint")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], "source string, target_share double, max_repeats int")
    made = M.mix(counted, targets, schedules={"a": [(0, 1.0), (0.5, 3.0), (1, 1.0)], "b": [(0, 3.0), (0.5, 1.0), (1, 3.0)]})
    got = [(r.position, r.source) for r in M.in_order(made.positions).collect()]
    share = lambda low, high: sum(s == "a" for p, s in got if low <= p < high) / max(1, sum(low <= p < high for p, s in got))
    assert len(got) == 4000 and abs(share(0, 0.05) - 0.27) < 0.06 and abs(share(0.45, 0.55) - 0.73) < 0.06 and abs(share(0.95, 1.01) - 0.27) < 0.06
    with pytest.raises(ValueError):
        M.relative({"a": [(0, 1.0), (0.5, 1.0)]}, {"a"})
