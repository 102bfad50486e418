"""Projections of results: evidence, compact addresses, families of targets, and the look-up cascades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import normalize as N

# Status words that say a text is not in force.
NEGATIVE = ("repealed", "aufgehoben", "außer kraft", "not_in_force", "expired", "withdrawn", "removed")


def evidence(status: Column, valid_from: Column, published: Column, source: Column) -> Column:
    """What is known about the standing of a text: only explicit negatives make it not in force, all else is unknown."""
    plain = F.lower(F.trim(F.coalesce(status, F.lit(""))))
    negative = plain.isin(*NEGATIVE)
    cautions = F.array_distinct(F.array_compact(F.array(
        F.when(negative, F.lit("not_in_force")), F.when(F.trim(F.coalesce(valid_from, F.lit(""))) == "", F.lit("no_start_of_validity")), F.when(F.trim(F.coalesce(published, F.lit(""))) == "", F.lit("no_date_of_publication")), F.when(source.isNull(), F.lit("source_unknown")),
    )))
    return F.struct(F.when(negative, "not_in_force").otherwise("unknown").alias("legal_status"), F.array_join(cautions, ",").alias("cautions"))


def address(reference: Column, title: Column) -> Column:
    """A reference with its title, which is left out where it is blank or says the same."""
    t = F.when((F.trim(title) != "") & (N.citation_key(title) != N.citation_key(reference)), F.trim(title))
    return F.concat_ws(" – ", F.when(F.trim(reference) != "", F.trim(reference)), t)


def family(key: Column) -> Column:
    """The family of a target key: case law, European act, German act, treaty, generic word or unclassified."""
    return (
        F.when(key.rlike("^(?:bverfg|bgh|eugh|bverwg|c_\\d+_\\d+|ecli)"), "case_law").when(key.rlike("^celex_"), "celex").when(key.rlike("^(?:gesetz|verordnung|richtlinie|anlage|vertrag)$"), "generic")
        .when(key.rlike("(?:vertrag|abkommen|uebereinkommen|konvention)"), "treaty").when(key.rlike("(?:g|gesetz|gb|ordnung|v|verordnung)$"), "german_act").otherwise("unclassified")
    )


def cascade(asked: DataFrame, key: list[str], *steps: tuple[str, DataFrame]) -> DataFrame:
    """The matches of the first step that has any for a question; steps(key..., target).

    Later steps are only for questions that no earlier one answers, so an exact hit keeps out all that only look alike.
    """
    out, left = None, asked.select(*key).distinct()
    for n, (name, found) in enumerate(steps):
        hit = left.join(found.select(*key, "target").distinct(), key).withColumns({"step": F.lit(name), "step_no": F.lit(n)})
        out = hit if out is None else out.unionByName(hit)
        left = left.join(hit.select(*key).distinct(), key, "left_anti")
    missed = left.withColumns({"target": F.lit(None).cast("string"), "step": F.lit("none"), "step_no": F.lit(len(steps))})
    return out.unionByName(missed)


def rank_stack(rows: DataFrame, group: list[str], order: list[str], rank: Column, most: int) -> DataFrame:
    """Each row's parent by heading ranks: the last row before it of a smaller rank, none in between of that rank or less.

    One running value a rank: the place of the last row with it, forgotten when a smaller rank comes.
    """
    by = Window.partitionBy(*group).orderBy(*order)
    placed = rows.withColumns({"_r": rank, "_p": F.row_number().over(by)})
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    best = F.lit(None).cast("int")
    for r in range(most):
        # nearest row of rank r; it counts only for rows of a greater rank, and the nearest of all smaller ranks wins
        last = F.max(F.when(F.col("_r") == r, F.col("_p"))).over(before)
        best = F.greatest(best, F.when(F.col("_r") > r, last))
    linked = placed.withColumn("_up", best)
    up = placed.select(*group, F.col("_p").alias("_up"), F.struct(*order).alias("parent"))
    return linked.join(up, [*group, "_up"], "left").drop("_p", "_r", "_up")


def scopes(marks: DataFrame, group: list[str], at: str, carry: str) -> DataFrame:
    """Blocks from each mark to the next of its group: (group, start, end, carry), end excluded and null at the last."""
    by = Window.partitionBy(*group).orderBy(at)
    return marks.select(*group, F.col(at).alias("start"), F.lead(at).over(by).alias("end"), F.col(carry).alias("scope"))


def in_scope(rows: DataFrame, marks: DataFrame, group: list[str], at: str, mark_at: str, carry: str) -> DataFrame:
    """Rows with the last mark at or before them, by one sorted pass over both; null before the first mark."""
    a = rows.withColumns({"_at": F.col(at), "_side": F.lit(1), "_c": F.lit(None).cast(marks.schema[carry].dataType)})
    b = marks.select(*group, F.col(mark_at).alias("_at"), F.col(carry).alias("_c")).withColumn("_side", F.lit(0))
    by = Window.partitionBy(*group).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = a.unionByName(b, allowMissingColumns=True).withColumn("scope", F.last("_c", ignorenulls=True).over(by))
    return both.where("_side = 1").drop("_at", "_side", "_c")


def without_blanks(fields: dict) -> dict:
    """The fields that say something: no nulls, empty texts or empty lists."""
    return {k: v for k, v in fields.items() if v is not None and v != "" and v != []}
