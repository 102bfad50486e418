"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight at every time t of training (0 at the start, 1 at the end); the weights of all sources add up to 1
at any t, and the mean weight of a source is its target share. Integrating a source's schedule gives the tokens demanded of
it up to t. A source's documents stand in a hashed order, pass after pass; the place of a document in this stream of tokens
is put through the inverse of the demand, which gives its training position. Sorting all documents by position by range
makes the mixture: at any point of the sorted result the sources have the shares that the schedule asks for.

The running sums of tokens are made in two steps (by hash bucket, then inside the bucket), so that a source that holds
most of the corpus is still spread over the whole cluster.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..durable import materialize

#: Buckets of a source's hashed order; each is summed by one task at a time.
BUCKETS = 4096
#: A public byte-level vocabulary of merge ranks, and the pattern that splits text before the merges.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _counter(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64

        import tiktoken
        from pyspark import SparkFiles

        with open(SparkFiles.get(name), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            n = pa.array([len(encoding.encode_ordinary(t)) if t else 0 for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], n], [*batch.schema.names[:-1], "tokens"])

    return run


def count_tokens(documents: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """documents(doc_id, source, text) -> (doc_id, source, tokens): whole texts, 0 for null or empty ones.

    The vocabulary at ``path`` of the driver is sent to all executors.
    """
    documents.sparkSession.sparkContext.addFile(path)
    chosen = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(_counter(path.rsplit("/", 1)[-1]), "doc_id bigint, source string, tokens bigint")


def source_key(source: Column) -> Column:
    """A source's name irrespective of letter case, outer spaces and separators."""
    return F.regexp_replace(F.lower(F.trim(source)), r"[\s\-_]+", "_")


def tilt(shares: dict[str, float], rising: set[str], slope: float) -> dict[str, list[tuple[float, float]]]:
    """Schedules in which the sources of ``rising`` go from (1 - slope) to (1 + slope) times their share and the others make room."""
    up = sum(v for k, v in shares.items() if k in rising)
    down = sum(v for k, v in shares.items() if k not in rising)
    slope = 0.0 if not up or not down else min(slope, 1.0, down / up)
    return {k: [(0.0, 1 - s), (1.0, 1 + s)] for k in shares for s in [slope if k in rising else -slope * up / down if down else 0.0]}


def relative(schedules: dict[str, list[tuple[float, float]]], sources: set[str]) -> dict[str, list[tuple[float, float]]]:
    """Given weights over time as multiples of a source's mean weight; a source without a schedule keeps its weight.

    A schedule is a list of (time, weight) from time 0 to time 1, in order, linear in between, with weights above 0.
    """
    out = {s: [(0.0, 1.0), (1.0, 1.0)] for s in sources}
    for s, knots in schedules.items():
        times = [t for t, _ in knots]
        if len(knots) < 2 or times[0] != 0 or times[-1] != 1 or any(b <= a for a, b in zip(times, times[1:])) or any(w <= 0 for _, w in knots):
            raise ValueError(f"the schedule of {s} must go from time 0 to 1 with weights above 0")
        mean = sum((b - a) * (v + w) / 2 for (a, v), (b, w) in zip(knots, knots[1:]))
        if s in out:
            out[s] = [(float(t), w / mean) for t, w in knots]
    return out


@dataclass
class Mixture:
    """positions(position, doc_id, source, pass, tokens), unsorted; chosen(doc_id, source, tokens, copies); shares(...)."""

    positions: DataFrame
    chosen: DataFrame
    shares: DataFrame


def _invert(demand: Column, knots: Column) -> Column:
    """The time at which the integral of a piecewise linear schedule reaches ``demand``; knots(t, w, c) with c the integral up to t."""
    at = F.greatest(F.lit(1), F.least(F.size(knots) - 1, F.size(F.filter(knots, lambda k: k["c"] <= demand))))
    a, b = F.element_at(knots, at), F.element_at(knots, at + 1)
    width = b["t"] - a["t"]
    left = F.greatest(demand - a["c"], F.lit(0.0))
    bend = (b["w"] - a["w"]) / width
    # w a + bend/2 x^2 = left, in the form that stays exact for small bends
    root = 2 * left / (a["w"] + F.sqrt(F.greatest(a["w"] * a["w"] + 2 * bend * left, F.lit(0.0))))
    return F.least(F.lit(1.0), a["t"] + F.when(left > 0, F.least(width, root)).otherwise(F.lit(0.0)))


def mix(counted: DataFrame, targets: DataFrame, total_tokens: float | None = None, slope: float = 0.5, seed: int = 7, schedules: dict[str, list[tuple[float, float]]] | None = None) -> Mixture:
    """counted(doc_id, source, tokens), targets(source, target_share, max_repeats) -> the mixture.

    The total is the largest one that every source can serve with its documents used at most max_repeats times, or
    ``total_tokens`` if that is smaller; the shares are then met but for half a document a source. Whole passes over a
    source come first, and the last pass ends where the demand does. Sources without any tokens or not among the targets
    give nothing, and the shares of the others are scaled up; the report has them with what they reach. A share of null or
    not above 0 asks for nothing; null max_repeats counts as 1. Documents with a null id or source or without tokens are
    never chosen; a repeated doc_id is one document. Each source follows its schedule of
    ``schedules`` (see ``relative``): its share of the whole is its target, its weight at a time goes with the schedule. Without
    any, the sources that may be repeated rise over the training by ``slope``.
    """
    goals = targets.select(source_key(F.col("source")).alias("source"), F.col("target_share").cast("double").alias("share"), F.coalesce("max_repeats", F.lit(1)).cast("int").alias("max_repeats"))
    goals = goals.where("source is not null and share > 0 and max_repeats > 0").groupBy("source").agg(F.sum("share").alias("share"), F.max("max_repeats").alias("max_repeats"))
    docs = counted.where("doc_id is not null and source is not null and tokens > 0").groupBy("doc_id").agg(F.max(F.struct(source_key(F.col("source")).alias("source"), F.col("tokens"))).alias("d")).select("doc_id", "d.source", "d.tokens")
    place = F.xxhash64("doc_id", F.lit(seed))
    docs = docs.join(F.broadcast(goals.select("source")), "source", "left_semi")  # a list of sources, written by hand
    docs = materialize(docs.withColumns({"place": place, "bucket": F.shiftright(place, 52) + BUCKETS // 2}), "counted")
    buckets = materialize(docs.groupBy("source", "bucket").agg(F.sum("tokens").alias("tokens")), "buckets")  # at most BUCKETS a source

    supply = {r["source"]: r["tokens"] for r in buckets.groupBy("source").agg(F.sum("tokens").alias("tokens")).collect()}  # one row a target
    goal = {r["source"]: (r["share"], r["max_repeats"]) for r in goals.collect()}
    whole = sum(goal[s][0] for s in supply)
    shares = {s: goal[s][0] / whole for s in supply}
    most = min((supply[s] * goal[s][1] / shares[s] for s in supply), default=0.0)
    total = min(most, total_tokens) if total_tokens is not None else most
    followed = tilt(shares, {s for s in supply if goal[s][1] > 1}, slope) if schedules is None else relative(schedules, set(supply))

    rows = []
    for s in supply:
        knots, c = [], 0.0
        for n, (t, w) in enumerate(followed[s]):
            if n:
                t0, w0 = followed[s][n - 1]
                c += (t - t0) * (w + w0) / 2
            knots.append((t, w, c))
        rows.append((s, shares[s] * total, supply[s], goal[s][1], knots))
    spark = counted.sparkSession
    plan = F.broadcast(spark.createDataFrame(rows, "source string, demand double, supply bigint, max_repeats int, knots array<struct<t:double,w:double,c:double>>"))

    before = F.coalesce(F.sum("tokens").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = buckets.select("source", "bucket", before.alias("offset"))
    inside = F.coalesce(F.sum("tokens").over(Window.partitionBy("source", "bucket").orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = docs.select("doc_id", "source", "tokens", "bucket", inside.alias("inside")).join(offsets, ["source", "bucket"]).join(plan, "source")
    start = F.col("offset") + F.col("inside")
    passes = F.floor(F.col("demand") / F.col("supply"))
    rest = F.col("demand") - passes * F.col("supply")
    last = F.when(start + F.col("tokens") / 2 <= rest, 1).otherwise(F.lit(0))
    copies = F.least((passes + last).cast("int"), F.col("max_repeats"))
    chosen = placed.select("doc_id", "source", "tokens", start.alias("start"), "demand", "supply", "knots", copies.alias("copies")).where("copies > 0")
    each = chosen.withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    reached = (F.col("pass") * F.col("supply") + F.col("start") + F.col("tokens") / 2) / F.col("demand")
    positions = each.select(_invert(F.least(reached, F.lit(1.0)), F.col("knots")).alias("position"), "doc_id", "source", "pass", "tokens")
    made = chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.count(F.lit(1)).alias("n_documents"), F.sum("copies").cast("bigint").alias("n_rows"), F.max("copies").alias("most_repeats"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    report = goals.join(made, "source", "left").select("source", F.col("share").alias("target_share"), zero("tokens"), zero("n_documents"), zero("n_rows"), "max_repeats", zero("most_repeats"))
    everything = F.sum("tokens").over(Window.partitionBy())  # one row a target
    report = report.withColumn("actual_share", F.when(everything > 0, F.col("tokens") / everything).otherwise(F.lit(0.0)))
    return Mixture(positions, chosen.select("doc_id", "source", "tokens", "copies"), report)


def in_order(positions: DataFrame) -> DataFrame:
    """The training order: a range sort by position, ties by source, pass and document."""
    return positions.orderBy("position", "source", "pass", "doc_id")
