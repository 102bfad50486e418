"""Segmentation, packing and carry-over along an order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def overlap_windows(tokens: Column, size: int, overlap: int) -> Column:
    """Consecutive windows of ``size`` tokens, each starting max(size - overlap, 1) after the one before; the last may be shorter."""
    step = max(size - overlap, 1)
    starts = F.filter(F.sequence(F.lit(0), F.greatest(F.size(tokens) - 1, F.lit(0)), F.lit(step)), lambda s: (s == 0) | (s + overlap < F.size(tokens)))
    return F.when(F.size(tokens) > 0, F.transform(starts, lambda s: F.slice(tokens, s + 1, F.lit(size)))).otherwise(F.array().cast("array<array<string>>"))


def segment(rows: DataFrame, group: list[str], order: list[str], is_heading: Column) -> DataFrame:
    """Adds ``segment`` (0 before the first heading) and ``heading_place``: rows from a heading to the next are one segment."""
    by = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("segment", F.sum(F.when(is_heading, 1).otherwise(0)).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def forward_fill(rows: DataFrame, group: list[str], order: list[str], column: str, name: str) -> DataFrame:
    by = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(name, F.last(column, ignorenulls=True).over(by))


def pack(sizes: Column, target: int) -> Column:
    """Greedy bins: the bin number of each item in order; a bin is closed before the item that would exceed ``target``."""
    start = F.struct(F.lit(0).alias("bin"), F.lit(0).cast("bigint").alias("fill"), F.array().cast("array<int>").alias("bins"))

    def add(a: Column, x: Column) -> Column:
        over = (a["fill"] > 0) & (a["fill"] + x > target)
        bin_ = F.when(over, a["bin"] + 1).otherwise(a["bin"])
        return F.struct(bin_.alias("bin"), F.when(over, x.cast("bigint")).otherwise(a["fill"] + x).alias("fill"), F.concat(a["bins"], F.array(bin_)).alias("bins"))

    return F.aggregate(sizes, start, add, lambda a: a["bins"])


def within_budget(rows: DataFrame, group: list[str], order: list[str], size: str, most_size: int, most_rows: int) -> DataFrame:
    """The first rows of each group up to a budget; the first row that overflows ends it, later smaller ones stay out."""
    by = Window.partitionBy(*group).orderBy(*order)
    total = F.sum(size).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumns({"_t": total, "_n": F.row_number().over(by)}).where((F.col("_t") <= most_size) & (F.col("_n") <= most_rows)).drop("_t", "_n")


def running_suffix(rows: DataFrame, base: str, order: list[str], pattern: str = "_part_") -> DataFrame:
    """A unique name a row: the second occurrence of a base gets ``_part_2`` and so on."""
    n = F.row_number().over(Window.partitionBy(base).orderBy(*order))
    return rows.withColumn("unique_name", F.when(n == 1, F.col(base)).otherwise(F.concat(F.col(base), F.lit(pattern), n.cast("string"))))


def neighbours(hits: DataFrame, rows: DataFrame, group: str, place: str, before: int, after: int) -> DataFrame:
    """Rows within ``before`` and ``after`` places of a hit in its group, each once. hits(group, place).

    The hits are spread over the places they reach, so the join is on equal keys only.
    """
    reach = hits.select(group, F.explode(F.sequence(F.col(place) - before, F.col(place) + after)).alias(place)).distinct()
    return rows.join(reach, [group, place], "left_semi")


def as_of_next(left: DataFrame, right: DataFrame, on: list[str], at: str, right_at: str, within: int | float, carry: str) -> DataFrame:
    """left with the nearest ``carry`` of right at or after ``at`` and no farther than ``within``, by one sorted pass over both."""
    a = left.withColumns({"_at": F.col(at).cast("double"), "_side": F.lit(0), "_c": F.lit(None)})
    b = right.select(*on, F.col(right_at).cast("double").alias("_at"), F.struct(F.col(right_at).cast("double").alias("at"), F.col(carry).alias("v")).alias("_c")).withColumn("_side", F.lit(1))
    a = a.withColumn("_c", F.lit(None).cast(b.schema["_c"].dataType))
    both = a.unionByName(b, allowMissingColumns=True)
    later = Window.partitionBy(*on).orderBy(F.col("_at").desc(), F.col("_side").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = both.withColumn("_n", F.last("_c", ignorenulls=True).over(later)).where("_side = 0")
    near = F.col("_n.at") - F.col("_at") <= within
    return seen.withColumns({f"next_{carry}": F.when(near, F.col("_n.v")), "gap": F.when(near, F.col("_n.at") - F.col("_at"))}).drop("_at", "_side", "_c", "_n")
