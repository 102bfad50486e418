"""Vector search for single queries, and what keeps an index of vectors up to date."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.normalize import dot, valid_vector


def unit_length(v: Column) -> Column:
    norm = F.sqrt(dot(v, v))
    return F.transform(v, lambda x: x.cast("double") / norm)


def search(vectors: DataFrame, id_column: str, vector: str, query: list[float], dimensions: int, limit: int, where: Column | None = None) -> DataFrame:
    """The ``limit`` nearest by cosine among those that pass the filter, which comes before the ranking."""
    q = F.array(*[F.lit(float(x)) for x in query])
    rows = vectors.where(valid_vector(F.col(vector), dimensions))
    rows = rows.where(where) if where is not None else rows
    cosine = dot(F.col(vector), q) / F.sqrt(dot(F.col(vector), F.col(vector))) / F.sqrt(dot(q, q))
    return rows.select(id_column, F.round(cosine, 6).alias("score")).orderBy(F.col("score").desc(), id_column).limit(limit)


def input_hash(citation: Column, title: Column, text: Column) -> Column:
    return F.sha2(F.concat_ws("\n", F.coalesce(citation, F.lit("")), F.coalesce(title, F.lit("")), F.coalesce(text, F.lit(""))), 256)


def hydrate(hits: DataFrame, passages: DataFrame, key: str, stored: str, current: str) -> DataFrame:
    """Hits with their passages, only where the stored hash is still that of the passage."""
    return hits.join(passages, key).where(F.col(stored) == F.col(current))


def to_embed(passages: DataFrame, stored: DataFrame, key: list[str], cost: Column, budget: float, order: list[str], least_cost: float = 1.0) -> DataFrame:
    """Passages without a stored vector of the same key, in order, while their running cost keeps within the budget.

    No passage costs less than ``least_cost``, so not more than budget / least_cost of them can be within it; only so many
    reach the one task that sums them up.
    """
    missing = passages.join(stored.select(*key).distinct(), key, "left_anti").withColumn("cost", F.greatest(cost, F.lit(least_cost)))
    first = missing.orderBy(*order).limit(int(budget // least_cost) + 1)
    total = F.sum("cost").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return first.withColumn("running_cost", total).where(F.col("running_cost") <= budget)


def hash_embedding(text: str, dimensions: int = 64) -> list[float]:
    """A vector of unit length without a model: each word adds to the places that its hash names. Equal texts are equal, texts that
    share words are near; for tests and for work without a network. A text without words points to the first place."""
    out = [0.0] * dimensions
    for word in re.findall(r"\w+", text.casefold()):
        digest = hashlib.sha256(word.encode()).digest()
        for k in range(4):
            out[int.from_bytes(digest[4 * k : 4 * k + 3], "big") % dimensions] += 1.0 if digest[4 * k + 3] & 1 else -1.0
    length = math.sqrt(sum(x * x for x in out))
    return [x / length for x in out] if length else [1.0] + [0.0] * (dimensions - 1)


def _encode(encode: Callable[[list[str]], list[list[float]]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            vectors = encode(texts) if texts else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vectors, pa.list_(pa.float32()))], ["item_id", "vector"])

    return run


def embedded(texts: DataFrame, encode: Callable[[list[str]], list[list[float]]] = lambda texts: [hash_embedding(t) for t in texts]) -> DataFrame:
    """texts(item_id, text) -> (item_id, vector) by any function that makes vectors of a list of texts, batch by batch."""
    chosen = texts.where("text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text")
    return chosen.mapInArrow(_encode(encode), "item_id string, vector array<float>")


def build_plan(passages: DataFrame, stored: DataFrame, price_per_million: float, budget: float, buckets: int = 1024) -> DataFrame:
    """passages(passage_id, input_hash, text), stored(passage_id, input_hash) -> (passage_id, input_hash, cost, state).

    What is stored with the same hash is ``unchanged``. The others are ``planned`` as long as the running cost stays within the
    budget, in the order of a hash, and ``budget_stopped`` from then on. The running sum is made by bucket and then inside of it.
    """
    known = stored.select("passage_id", "input_hash").distinct().withColumn("_known", F.lit(True))
    rows = passages.join(known, ["passage_id", "input_hash"], "left").withColumn("cost", F.when(F.col("_known"), 0.0).otherwise((F.octet_length("text") + 64) * 3 * price_per_million / 1e6))
    place = F.xxhash64("passage_id")
    rows = rows.withColumns({"_place": place, "_bucket": F.pmod(F.shiftright(place, 40), F.lit(buckets))})
    sums = rows.groupBy("_bucket").agg(F.sum("cost").alias("_sum"))
    before = sums.select("_bucket", F.coalesce(F.sum("_sum").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("_before"))  # a row a bucket
    inside = F.sum("cost").over(Window.partitionBy("_bucket").orderBy("_place", "passage_id"))
    total = rows.join(F.broadcast(before), "_bucket").withColumn("_total", F.col("_before") + inside)
    state = F.when(F.col("_known"), "unchanged").when(F.col("_total") <= budget, "planned").otherwise("budget_stopped")
    return total.select("passage_id", "input_hash", "cost", state.alias("state"))
