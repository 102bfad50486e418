"""Measures of retrieval and of judged benchmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranks(results: DataFrame) -> DataFrame:
    """results(case_id, item_id, position) -> rank of each item's first place in its list, without gaps."""
    first = results.groupBy("case_id", "item_id").agg(F.min("position").alias("position"))
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("case_id").orderBy("position", "item_id")))


def retrieval_metrics(gold: DataFrame, ranked: DataFrame, k: int) -> DataFrame:
    """One row: micro recall at k, mean reciprocal rank (0 for a miss), share of cases with all evidence; null without gold.

    gold(case_id, item_id), ranked(case_id, item_id, rank). Cases without gold are in no denominator.
    """
    hit = gold.distinct().join(ranked.where(F.col("rank") <= k), ["case_id", "item_id"], "left")
    case = hit.groupBy("case_id").agg(F.count(F.lit(1)).alias("n"), F.count("rank").alias("found"), F.coalesce(1 / F.min("rank"), F.lit(0.0)).alias("rr"))
    return case.agg(
        F.count(F.lit(1)).alias("n_cases"), F.round(F.sum("found") / F.sum("n"), 6).alias("recall"), F.round(F.avg("rr"), 6).alias("mrr"),
        F.round(F.avg(F.when(F.col("n") == F.col("found"), 1.0).otherwise(0.0)), 6).alias("all_evidence"),
    )


def set_measures(gold: DataFrame, found: DataFrame) -> DataFrame:
    """Precision, recall and F1 a case of gold(case_id, item_id) against found(case_id, item_id)."""
    g, f = gold.distinct().withColumn("_g", F.lit(1)), found.distinct().withColumn("_f", F.lit(1))
    case = g.join(f, ["case_id", "item_id"], "full").groupBy("case_id").agg(F.count("_g").alias("g"), F.count("_f").alias("f"), F.count(F.col("_g") + F.col("_f")).alias("b"))
    p, r = F.when(F.col("f") > 0, F.col("b") / F.col("f")), F.when(F.col("g") > 0, F.col("b") / F.col("g"))
    f1 = F.when(F.col("g") + F.col("f") > 0, 2 * F.col("b") / (F.col("g") + F.col("f")))
    return case.select("case_id", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(f1, 6).alias("f1"))


def rubric(scores: DataFrame, cap: float) -> DataFrame:
    """scores(task_id, judge, weight, score 0..4, fatal) -> weighted mean over judges / 4; a strict majority of fatal votes caps it."""
    judge = scores.groupBy("task_id", "judge").agg((F.sum(F.col("weight") * F.col("score")) / F.sum("weight") / 4).alias("s"), F.max("fatal").alias("fatal"))
    task = judge.groupBy("task_id").agg(F.avg("s").alias("s"), F.count_if("fatal").alias("votes"), F.count(F.lit(1)).alias("n_judges"))
    fatal = F.col("votes") * 2 > F.col("n_judges")
    return task.select("task_id", "n_judges", fatal.alias("is_fatal"), F.round(F.when(fatal, F.least(F.col("s"), F.lit(cap))).otherwise(F.col("s")), 6).alias("score"))


def stability(runs: DataFrame, by: list[str], value: str) -> DataFrame:
    return runs.groupBy(*by).agg(F.count(value).alias("n"), F.round(F.avg(value), 6).alias("mean"), F.round(F.stddev_samp(value), 6).alias("stdev"))


def paired(rows: DataFrame, case: str, profile: str, value: str, left: str, right: str, least: float) -> DataFrame:
    """Left against right by case: difference and who wins, with a threshold for ties."""
    both = rows.groupBy(case).agg(F.max(F.when(F.col(profile) == left, F.col(value))).alias("l"), F.max(F.when(F.col(profile) == right, F.col(value))).alias("r")).where("l is not null and r is not null")
    d = F.round(F.col("l") - F.col("r"), 6)
    return both.select(case, d.alias("difference"), F.when(d > least, "left").when(d < -least, "right").otherwise("tie").alias("winner"))


def rank_fusion(lists: DataFrame, constant: int = 60) -> DataFrame:
    """lists(source, item_id, rank) -> items by the sum of 1 / (constant + rank); ties by the semantic rank, then id."""
    once = lists.groupBy("source", "item_id").agg(F.min("rank").alias("rank"))
    return once.groupBy("item_id").agg(F.round(F.sum(1 / (constant + F.col("rank"))), 9).alias("score"), F.min(F.when(F.col("source") == "semantic", F.col("rank"))).alias("semantic_rank"))
