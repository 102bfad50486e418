"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot if it has more than one in HOT_SHARE of the rows, so there are fewer hot keys than that, however many rows.
HOT_SHARE = 10_000
#: Part of the rows that are counted to find the hot keys. It only decides how the rows are spread, never which come out.
SAMPLED = 0.05


def hot_keys(rows: DataFrame, on: list[str], hot_rows: int, sampled: float = SAMPLED) -> DataFrame:
    """(on, _salts): the keys of ``rows``, a part ``sampled`` of all, that have more than ``hot_rows`` and one in HOT_SHARE of
    all rows, and by how many salts each is to be spread so that a salt has about so many rows."""
    counts = rows.groupBy(*on).agg((F.count(F.lit(1)) / sampled).alias("_n"))
    size = counts.agg(F.greatest(F.lit(float(hot_rows)), F.coalesce(F.sum("_n"), F.lit(0.0)) / HOT_SHARE).alias("_size"))
    return counts.crossJoin(F.broadcast(size)).where("_n > _size").select(*on, F.ceil(F.col("_n") / F.col("_size")).cast("int").alias("_salts"))  # one row of size


def salted_left_join(
    left: DataFrame, right: DataFrame, on: list[str], spread_by: list[Column], hot_rows: int = 200_000, how: str = "left", counted: DataFrame | None = None
) -> DataFrame:
    """``left`` join ``right`` on ``on`` where keys of ``left`` may be heavily skewed and are never null.

    Rows of a hot key are spread over sub-keys by a hash of ``spread_by`` (deterministic, so a recomputed task gives the
    same rows), the more the hotter it is; the matching rows of ``right`` are repeated once a sub-key. ``right`` must be
    small per key. ``counted``: a part SAMPLED of the keys of ``left``, if it is cheaper to have than by sampling ``left``.
    """
    hot = F.broadcast(hot_keys(left.sample(SAMPLED, 7) if counted is None else counted, on, hot_rows))
    spread = F.pmod(F.xxhash64(*spread_by), F.col("_salts")).cast("int")
    salted_left = left.join(hot, on, "left").withColumn("_salt", F.when(F.col("_salts").isNotNull(), spread).otherwise(F.lit(0))).drop("_salts")
    every = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    salted_right = right.join(hot, on, "left").withColumn("_salt", F.explode(every)).drop("_salts")
    return salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")
