"""The most similar vectors of every vector, exactly, by a block matrix join.

Vectors of a profile are hashed into blocks, and every pair of blocks is one tile. In a tile the vectors are quantised to 8
bits; one matrix product of the small integers (held as float32, in which these products are exact) gives all dot products
with a known bound of the quantisation error. Only pairs whose bound reaches the k-th best similarity found so far are
computed again in double precision. Each tile keeps k neighbours a vector (a heap), and the heaps of all tiles are merged.

The error bound makes the result exact: no pair is lost to quantisation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..durable import materialize

#: Rows of a block at most (on average; blocks are made by a hash): 64 numbers each, 8 MB a block.
BLOCK_ROWS = 32_768
#: Blocks of a profile at least, so that small inputs use all cores too.
LEAST_BLOCKS = 8
#: Rows and columns of a product held at once.
PANEL_ROWS, PANEL_COLUMNS = 1024, 8192

_PAIRS = "vec_id bigint, neighbour_id bigint, similarity double"


def usable(vectors: DataFrame, dimensions: int) -> DataFrame:
    """vectors(vec_id, profile, vector) -> one row a vec_id with ``dimensions`` finite numbers, not all zero.

    Of repeated rows of a vec_id the greatest (profile, vector) counts.
    """
    numbers = F.transform("vector", lambda x: x.cast("float"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    return (
        vectors.where("vec_id is not null and profile is not null and vector is not null")
        .where(F.size("vector") == dimensions)
        .where(F.coalesce(fine, F.lit(False)))
        .groupBy("vec_id")
        .agg(F.max(F.struct(F.col("profile"), numbers.alias("vector"))).alias("v"))
        .select(F.col("vec_id").cast("bigint").alias("vec_id"), "v.profile", "v.vector")
    )


def quantise(rows: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """(integers as float32, common scale, norm of each row's rounding error) of rows of unit length."""
    scale = float(np.abs(rows).max()) / 127 or 1.0
    q = np.rint(rows / scale)
    return q.astype(np.float32), scale, np.sqrt(((rows - q * scale) ** 2).sum(1))


class Heaps:
    """The k best neighbours of each row, by similarity, then by id."""

    def __init__(self, ids: np.ndarray, k: int, floor: float):
        self.ids, self.k = ids, k
        self.sim = np.full((len(ids), k), -np.inf)
        self.nbr = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.floor = floor

    def bar(self) -> np.ndarray:
        return np.maximum(self.sim[:, -1], self.floor)

    def push(self, row: np.ndarray, nbr: np.ndarray, sim: np.ndarray) -> None:
        keep = sim >= self.bar()[row]
        row, nbr, sim = row[keep], nbr[keep], sim[keep]
        if not len(row):
            return
        touched = np.unique(row)
        r = np.concatenate([row, np.repeat(touched, self.k)])
        n = np.concatenate([nbr, self.nbr[touched].ravel()])
        s = np.concatenate([sim, self.sim[touched].ravel()])
        order = np.lexsort((n, -s, r))
        r, n, s = r[order], n[order], s[order]
        place = np.arange(len(r)) - np.searchsorted(r, r, "left")
        best = place < self.k
        self.sim[r[best], place[best]] = s[best]
        self.nbr[r[best], place[best]] = n[best]


def tile(ids_a: np.ndarray, a: np.ndarray, ids_b: np.ndarray, b: np.ndarray, same: bool, both: bool, k: int, floor: float) -> list[Heaps]:
    """Neighbours of a's rows among b's, and with ``both`` of b's among a's too; ``same``: b is a. Rows have unit length."""
    qa, sa, ea = quantise(a)
    qb, sb, eb = quantise(b)
    heaps_a, heaps_b = Heaps(ids_a, k, floor), Heaps(ids_b, k, floor)
    # |x.y - sa sb qx.qy| <= |x'||ey| + |ex||y'| + |ex||ey|, with |x'| <= 1 + |ex|
    top_b = float(eb.max(initial=0))
    error = (1 + ea) * top_b + ea * (1 + top_b) + ea * top_b + 1e-6
    unit = sa * sb
    for c in range(0, len(b), PANEL_COLUMNS):
        cols = slice(c, min(len(b), c + PANEL_COLUMNS))
        for r in range(0, len(a), PANEL_ROWS):
            rows = slice(r, min(len(a), r + PANEL_ROWS))
            product = qa[rows] @ qb[cols].T
            bar = heaps_a.bar()[rows]
            open_rows = np.flatnonzero(np.isinf(bar))
            if len(open_rows) and product.shape[1] > k:
                # nothing known yet: the k-th largest lower bound of this panel is a bar (one more, as a row may meet itself)
                nth = product.shape[1] - min(k + 1, product.shape[1])
                kth = np.partition(product[open_rows], nth, axis=1)[:, nth]
                bar = bar.copy()
                bar[open_rows] = kth * unit - error[rows][open_rows]
            close = product >= ((bar - error[rows]) / unit)[:, None]
            if both and not same:
                bar_b = heaps_b.bar()[cols]
                blank = np.flatnonzero(np.isinf(bar_b))
                if len(blank) and product.shape[0] > k:
                    nth = product.shape[0] - k
                    kth = np.partition(product[:, blank], nth, axis=0)[nth]
                    bar_b = bar_b.copy()
                    bar_b[blank] = kth * unit - error[rows].max()
                close |= product >= ((bar_b - error[rows].max()) / unit)[None, :]
            i, j = np.nonzero(close)
            i, j = i + r, j + c
            if same or not both:
                other = ids_a[i] != ids_b[j]
                i, j = i[other], j[other]
            for p in range(0, len(i), 1_000_000):
                x, y = i[p : p + 1_000_000], j[p : p + 1_000_000]
                exact = np.einsum("ij,ij->i", a[x], b[y]).round(12)  # copies tie
                heaps_a.push(x, ids_b[y], exact)
                if both and not same:
                    heaps_b.push(y, ids_a[x], exact)
    return [heaps_a, heaps_b] if both and not same else [heaps_a]


def _tiles(k: int, floor: float, both: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sides = None, ([], [])

        def solved() -> Iterator[pa.RecordBatch]:
            (ida, a), (idb, b) = ((np.concatenate([x[0] for x in s]), np.concatenate([x[1] for x in s]).astype(np.float64)) if s else (np.zeros(0, np.int64), None) for s in sides)
            same = both and key[1] == key[2]
            if same:
                idb, b = ida, a
            if not len(ida) or not len(idb):
                return
            a = a / np.linalg.norm(a, axis=1)[:, None]
            b = a if same else b / np.linalg.norm(b, axis=1)[:, None]
            for h in tile(ida, a, idb, b, same, both, k, floor):
                r, c = np.nonzero(np.isfinite(h.sim))
                yield pa.RecordBatch.from_arrays([pa.array(h.ids[r]), pa.array(h.nbr[r, c]), pa.array(h.sim[r, c])], ["vec_id", "neighbour_id", "similarity"])

        for batch in batches:
            profile, i, j, side = (batch.column(n).to_pylist() for n in range(4))
            ids = batch.column(4).to_numpy()
            flat = batch.column(5).flatten().to_numpy(zero_copy_only=False)
            vectors = flat.reshape(len(ids), -1)
            at = 0
            for n in range(1, len(ids) + 1):
                if n == len(ids) or (profile[n], i[n], j[n], side[n]) != (profile[at], i[at], j[at], side[at]):
                    if (profile[at], i[at], j[at]) != key:
                        if key is not None:
                            yield from solved()
                        key, sides = (profile[at], i[at], j[at]), ([], [])
                    sides[side[at]].append((ids[at:n], vectors[at:n]))
                    at = n
        if key is not None:
            yield from solved()

    return run


def nearest(vectors: DataFrame, k: int = 5, dimensions: int = 64, min_similarity: float | None = None, is_query: Column | None = None) -> DataFrame:
    """vectors(vec_id, profile, vector) -> (vec_id, neighbour_id, similarity, rank), rank 1..k, by cosine.

    Neighbours share the profile and are another vec_id; of equal similarities the smaller id comes first. Vectors that are
    null, of another length, not finite or all zero, and null ids or profiles, take no part. Repeated rows of a vec_id are
    one vector. ``min_similarity`` leaves out neighbours below it, which never changes the ranks of the others and lets
    most of a tile be passed over. ``is_query`` restricts the vectors for which neighbours are sought, not those among
    which. A profile with fewer than k other vectors gives as many as there are. An empty input gives an empty result.
    """
    chosen = usable(vectors, dimensions)
    if is_query is not None:
        chosen = chosen.withColumn("_q", F.coalesce(is_query, F.lit(False)))
    chosen = materialize(chosen, "vectors")
    n_asked = F.count(F.lit(1)) if is_query is None else F.count_if(F.col("_q"))
    counts = chosen.groupBy("profile").agg(F.count(F.lit(1)).alias("n"), n_asked.alias("q")).select(
        "profile", F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.least(F.lit(LEAST_BLOCKS), F.ceil(F.col("n") / 64))).cast("int").alias("blocks"),
        F.greatest(F.lit(1), F.ceil(F.col("q") / BLOCK_ROWS)).cast("int").alias("asked_blocks"),
    )
    counts = materialize(counts, "blocks")
    n_profiles, n_tiles = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("blocks") * (F.col("blocks") + 1 if is_query is None else F.col("asked_blocks"))), F.lit(0))).first()
    if n_profiles <= 100_000:
        counts = F.broadcast(counts)
    placed = chosen.join(counts, "profile").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    if is_query is None:
        # tile (i, j) with i <= j; a block is side 0 of the tiles it begins and side 1 of those it ends
        tiles = F.transform(every, lambda o: F.struct(F.least(F.col("block"), o).alias("i"), F.greatest(F.col("block"), o).alias("j"), F.when(o >= F.col("block"), 0).otherwise(1).alias("side")))
        spread = placed.withColumn("t", F.explode(tiles))
    else:
        # the vectors that ask are in blocks of their own, one if they are few, and all others are copied only to those
        own = F.pmod(F.xxhash64("vec_id"), F.col("asked_blocks")).cast("int")
        asked = placed.where("_q").withColumn("t", F.explode(F.transform(every, lambda o: F.struct(own.alias("i"), o.alias("j"), F.lit(0).alias("side")))))
        asking = F.sequence(F.lit(0), F.col("asked_blocks") - 1)
        among = placed.withColumn("t", F.explode(F.transform(asking, lambda o: F.struct(o.alias("i"), F.col("block").alias("j"), F.lit(1).alias("side")))))
        spread = asked.unionByName(among)
    n_parts = int(min(20_000, max(1, n_tiles)))
    tiled = spread.select("profile", "t.i", "t.j", "t.side", "vec_id", "vector").repartition(n_parts, "profile", "i", "j").sortWithinPartitions("profile", "i", "j", "side")
    floor = -np.inf if min_similarity is None else float(min_similarity)
    found = tiled.mapInArrow(_tiles(k, floor, is_query is None), _PAIRS)
    order = Window.partitionBy("vec_id").orderBy(F.col("similarity").desc(), "neighbour_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
