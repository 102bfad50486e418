"""Audits: duplicates, counts, inventories and bounded examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def duplicates(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def findings(rows: DataFrame, code: Column, example: Column, most: int = 3) -> DataFrame:
    """Occurrences of each code and its first ``most`` distinct examples in order; rows whose code is null are none.

    Each task keeps only its first examples of a code before any are shuffled, so a code with any number of occurrences stays small.
    """
    marked = rows.select(code.alias("code"), example.cast("string").alias("example")).where("code is not null")
    return _counted(marked, most)


def _counted(marked: DataFrame, most: int) -> DataFrame:
    pairs = marked.groupBy("code", "example").agg(F.count(F.lit(1)).alias("_n"))
    counts = pairs.groupBy("code").agg(F.sum("_n").alias("occurrences"))
    first = pairs.select("code", "example", F.row_number().over(Window.partitionBy("code").orderBy(F.col("example").asc_nulls_last())).alias("_r")).where(F.col("_r") <= most)
    shown = first.groupBy("code").agg(F.concat_ws(", ", F.array_sort(F.collect_list("example"))).alias("examples"))
    return counts.join(shown, "code")


def audit(rows: DataFrame, rules: dict[str, Column], example: Column, most: int = 3) -> DataFrame:
    """All findings of one kind of record in one pass: (code, occurrences, examples). A row may break several rules; a rule
    that is null for a row is not broken."""
    broken = F.array_compact(F.array(*[F.when(rule, F.lit(code)) for code, rule in rules.items()]))
    return _counted(rows.select(F.explode(broken).alias("code"), example.cast("string").alias("example")), most)


def verdict(findings_: DataFrame, severities: dict[str, str], fail_on: str = "error") -> DataFrame:
    """(n_findings, n_occurrences, failed) of all findings; ``fail_on`` is the least severity at which an audit fails."""
    order = ("info", "warning", "error")
    level = F.create_map(*[F.lit(v) for pair in severities.items() for v in pair])[F.col("code")]
    grave = F.coalesce(level, F.lit("error")).isin(*order[order.index(fail_on) :])
    return findings_.agg(F.count(F.lit(1)).alias("n_findings"), F.coalesce(F.sum("occurrences"), F.lit(0)).alias("n_occurrences"), F.coalesce(F.bool_or(grave), F.lit(False)).alias("failed"))


def leaked_ids(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """Texts that show an internal id between two word boundaries. texts(item_id, text), ids(id), ids of letters, digits and underscores.

    The texts' own words are joined with the ids, so that no text meets all ids.
    """
    words = texts.select("item_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9_]+"), 0))).alias("id")).where(F.col("id").contains("_") | F.col("id").rlike("[0-9]"))
    return words.join(ids.select("id").where("id is not null").distinct(), "id").select("item_id", "id").distinct()


def mention_inventory(mentions: DataFrame, group: Column, source: str, document: str, text: str, most: int = 3) -> DataFrame:
    """Mentions by group: how many, in how many sources and documents, and a few of the texts; most frequent first by rank."""
    keyed = mentions.select(group.alias("grp"), F.col(source).alias("s"), F.col(document).alias("d"), F.col(text).alias("t")).where("grp is not null")
    totals = keyed.groupBy("grp").agg(F.count(F.lit(1)).alias("n_mentions"), F.countDistinct(F.when(F.col("s") != "", F.col("s"))).alias("n_sources"), F.countDistinct(F.when(F.col("d") != "", F.col("d"))).alias("n_documents"))
    first = keyed.where("t <> ''").select("grp", "t").distinct().withColumn("_r", F.row_number().over(Window.partitionBy("grp").orderBy("t"))).where(F.col("_r") <= most)
    samples = first.groupBy("grp").agg(F.concat_ws(" ; ", F.array_sort(F.collect_list("t"))).alias("samples"))
    return totals.join(samples, "grp", "left").withColumnRenamed("grp", "target")


def bucket(n: Column) -> Column:
    return F.when(n >= 100, "A").when(n >= 10, "B").otherwise("C")


def coverage(rows: DataFrame, flag: Column, by: list[str] | None = None) -> DataFrame:
    """total, covered and their ratio to six places (null without rows), with its status."""
    grouped = rows.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("total"), F.count_if(flag).alias("covered"))
    ratio = F.round(F.when(F.col("total") > 0, F.col("covered") / F.col("total")), 6)
    return grouped.withColumn("ratio", ratio).withColumn("status", F.when(F.col("ratio") >= 0.9, "aligned").when(F.col("ratio") >= 0.4, "partial").otherwise("low"))


def null_if_any(total: Column, value: Column) -> Column:
    """A sum that is null if any input is."""
    return F.when(F.count(F.lit(1)) == F.count(value), total)


def reconcile(left: DataFrame, right: DataFrame, key: str, position: str) -> DataFrame:
    """Full outer join by key with multiplicity: all right rows of a key go to the left's first row of it.

    left(key, left_id, position), right(key, right_id) -> (key, left_id, n_right, status).
    """
    first = left.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(position)))
    counts = right.groupBy(key).agg(F.count(F.lit(1)).alias("_r"))
    both = first.join(counts.withColumn("_n", F.lit(1)), [key, "_n"], "full")
    n = F.coalesce("_r", F.lit(0))
    return both.select(key, "left_id", n.alias("n_right"), F.when(F.col("left_id").isNull(), "right_only").when(n > 0, "both").when(F.col("_n") > 1, "repeated").otherwise("left_only").alias("status"))
