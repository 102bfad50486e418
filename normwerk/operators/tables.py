"""Tables held as JSON rows: columns, matrices, text, parts and shape checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .segments import pack

ROWS = "array<map<string,string>>"


def parsed(rows_json: Column) -> Column:
    return F.from_json(rows_json, ROWS)


def unique_columns(names: Column) -> Column:
    """Column names made usable: blanks become column_N, the second of a name gets __2 and so on."""
    named = F.transform(names, lambda x, i: F.when(F.trim(F.coalesce(x, F.lit(""))) == "", F.concat(F.lit("column_"), (i + 1).cast("string"))).otherwise(F.trim(x)))
    return F.transform(named, lambda x, i: F.concat(x, F.when(F.size(F.filter(F.slice(named, F.lit(1), i), lambda y: y == x)) > 0, F.concat(F.lit("__"), (F.size(F.filter(F.slice(named, F.lit(1), i), lambda y: y == x)) + 1).cast("string"))).otherwise(F.lit(""))))


def header_paths(header_matrix: Column) -> Column:
    """Names of columns from a header of several rows: equal neighbours collapse, levels are joined by `` / ``."""
    width = F.coalesce(F.array_max(F.transform(header_matrix, lambda r: F.size(r))), F.lit(0))

    def path(i: Column) -> Column:
        cells = F.filter(F.transform(header_matrix, lambda r: F.trim(F.coalesce(F.get(r, i), F.lit("")))), lambda c: c != "")
        return F.array_join(F.filter(cells, lambda c, k: (k == 0) | (F.get(cells, k - 1) != c)), " / ")

    return unique_columns(F.when(width > 0, F.transform(F.sequence(F.lit(0), width - 1), path)).otherwise(F.array().cast("array<string>")))


def expand_spans(cells: DataFrame, table: str) -> DataFrame:
    """cells(table, row, column, row_span, column_span, text) -> one row a covered place, with whether it is the origin."""
    every = cells.select(
        table, F.col("row").alias("_r"), F.col("column").alias("_c"), "text",
        F.explode(F.sequence(F.col("row"), F.col("row") + F.greatest(F.coalesce("row_span", F.lit(1)), F.lit(1)) - 1)).alias("row"),
        F.sequence(F.col("column"), F.col("column") + F.greatest(F.coalesce("column_span", F.lit(1)), F.lit(1)) - 1).alias("_cs"),
    )
    return every.select(table, "row", F.explode("_cs").alias("column"), "text", "_r", "_c").select(table, "row", "column", "text", ((F.col("row") == F.col("_r")) & (F.col("column") == F.col("_c"))).alias("is_origin"))


def row_texts(rows: Column) -> Column:
    """Each row's values joined by `` | ``; values equal to the one before in the row become ``↳``."""
    def text(r: Column) -> Column:
        values = F.map_values(r)
        return F.array_join(F.transform(values, lambda v, i: F.when((i > 0) & (v == F.get(values, i - 1)) & (v != ""), F.lit("↳")).otherwise(F.coalesce(v, F.lit("")))), " | ")

    return F.transform(rows, text)


def parts(tables: DataFrame, key: str, rows_json: str, target: int) -> DataFrame:
    """Tables in parts of whole rows of at most ``target`` words where rows allow: (key, part, n_parts, first_row, n_rows, words).

    A row beyond the target is a part of its own, flagged ``oversized``.
    """
    texts = tables.select(key, row_texts(parsed(F.col(rows_json))).alias("_t")).where("_t is not null and size(_t) > 0")
    words = F.transform("_t", lambda s: F.size(F.filter(F.split(s, r"\s+"), lambda w: w != "")))
    packed = texts.withColumn("_w", words).withColumn("_b", pack(F.col("_w"), target))
    each = packed.select(key, F.posexplode(F.arrays_zip("_w", "_b")).alias("_i", "_x"))
    out = each.groupBy(key, F.col("_x._b").alias("part")).agg(F.min("_i").alias("first_row"), F.count(F.lit(1)).alias("n_rows"), F.sum("_x._w").alias("words"))
    n = packed.select(key, (F.array_max("_b") + 1).alias("n_parts"))
    return out.join(n, key).withColumn("oversized", F.col("words") > target)


def shape_findings(tables: DataFrame, key: str, rows_json: str, row_count: str) -> DataFrame:
    """Tables whose declared and real numbers of rows differ, or whose rows do not share their columns."""
    rows = parsed(F.col(rows_json))
    names = F.transform(rows, lambda r: F.array_join(F.array_sort(F.map_keys(r)), "|"))
    n = F.json_array_length(rows_json)
    out = tables.where(F.col(rows_json).isNotNull()).select(key, F.col(row_count).alias("declared"), n.alias("actual"), F.size(F.array_distinct(names)).alias("n_shapes"))
    return out.where("declared is null or declared <> actual or n_shapes > 1")
