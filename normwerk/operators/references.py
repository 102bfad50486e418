"""References to records that do not exist, are withdrawn, or arrive only later.

Every key is a prefix and an integer: the number it ends in, or else the letters it ends in, read as one. Within a prefix the
sorted integers of the parents are compressed into runs of consecutive values; a run is its first and last integer and the
earliest and latest time from which its keys are usable. It ends where the next integer is not there, where the state changes
(usable or never usable), and where the times lie more than GAP apart. A reference is matched as-of to the run that starts at
or before its integer, and it is an orphan if its integer lies beyond the run's end or its time before the run's first. Only
a reference whose time falls between a run's first and last is compared with its own key's time.

Runs are cut at multiples of BLOCK: a group of the join then holds at most BLOCK runs however dense the key range is, and
the as-of match is an equi-join on (prefix, block) followed by a look-up in a short sorted array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..durable import materialize
from ..skew import SAMPLED, salted_left_join

BLOCK = 256
#: Seconds between the times of neighbours in a run, at most.
GAP = 3600
#: Letters at the end of a key that make its integer if it ends in no number: 8 bits each.
LETTERS = 6
#: White space that may surround a key.
OUTER = " \t\r\n\f   　"


def comparable_key(key: Column) -> Column:
    """Keys compare without outer spaces and letter case; blank keys are null."""
    plain = F.lower(F.btrim(key, F.lit(OUTER)))
    return F.when(plain != "", plain)


def split_key(key: Column) -> tuple[Column, Column]:
    """(prefix, integer) of which the key can be made again, so that equal pairs are equal keys.

    A number at the end is the integer. Else it is made of the last LETTERS characters if they are ASCII, and the prefix says
    so by a mark that no key begins with; else it is -1 and the prefix the whole key.
    """
    digits = F.regexp_extract(key, r"(?:0|[1-9][0-9]{0,16})$", 0)
    # leading zeros stay in the prefix: of "a007" the integer is 7 and the prefix "a00"
    number = digits.try_cast("bigint")
    tail = F.right(key, F.lit(LETTERS))
    code = F.conv(F.hex(tail), 16, 10).cast("bigint")
    lettered = F.octet_length(tail) == LETTERS
    head = lambda n: F.substring(key, F.lit(1), F.char_length(key) - n)
    prefix = F.when(number.isNotNull(), head(F.char_length(digits))).when(lettered, F.concat(F.lit(" "), head(F.lit(LETTERS)))).otherwise(key)
    return prefix, F.when(number.isNotNull(), number).when(lettered, code).otherwise(F.lit(-1))


def usable_keys(parents: DataFrame) -> DataFrame:
    """parents(parent_key, parent_ts, alive) -> (prefix, n, usable_from), one row a key; null: never usable."""
    keyed = parents.select(comparable_key(F.col("parent_key")).alias("k"), F.when(F.col("alive"), F.col("parent_ts")).alias("ts")).where("k is not null")
    prefix, number = split_key(F.col("k"))
    return keyed.select(prefix.alias("prefix"), number.alias("n"), "ts").groupBy("prefix", "n").agg(F.min("ts").alias("usable_from"))


def key_runs(keys: DataFrame) -> DataFrame:
    """(prefix, n, usable_from) -> (prefix, block, runs), runs sorted by start: array of (start, end, first, last)."""
    members = keys.withColumn("block", F.floor(F.col("n") / BLOCK)).groupBy("prefix", "block").agg(F.array_sort(F.collect_list(F.struct("n", "usable_from"))).alias("m"))  # at most BLOCK

    def begins(i: Column) -> Column:
        here, before = F.get("m", i), F.get("m", i - 1)
        apart = F.abs(F.unix_micros(here["usable_from"].cast("timestamp")) - F.unix_micros(before["usable_from"].cast("timestamp"))) > GAP * 1_000_000
        return (i == 0) | (here["n"] != before["n"] + 1) | (here["usable_from"].isNull() != before["usable_from"].isNull()) | F.coalesce(apart, F.lit(False))

    starts = F.filter(F.sequence(F.lit(0), F.size("m") - 1), begins)

    def run(s: Column, i: Column) -> Column:
        end = F.coalesce(F.get("starts", i + 1), F.size("m"))
        times = F.transform(F.slice("m", s + 1, end - s), lambda x: x["usable_from"])
        return F.struct(F.get("m", s)["n"].alias("start"), F.get("m", end - 1)["n"].alias("end"), F.array_min(times).alias("first"), F.array_max(times).alias("last"))

    return members.withColumn("starts", starts).select("prefix", "block", F.transform("starts", run).alias("runs"))


def orphan_references(refs: DataFrame, parents: DataFrame, hot_rows: int = 200_000) -> DataFrame:
    """The rows of ``refs`` whose key names no usable parent, with the reason.

    refs(record_table, record_key, ref_key, ref_ts, ...), parents(parent_key, parent_ts, alive). A parent is usable for a
    reference if one of its rows is alive and not later than the reference. Null or blank ref_key is no reference. A null
    ref_ts has no parent in time, a null alive or parent_ts makes a row unusable. Repeated rows come out as often as they
    come in. Reasons: ``missing`` (no row), ``withdrawn`` (rows, none alive), ``later`` (alive only after the reference).
    """

    def asked_of(rows: DataFrame) -> DataFrame:
        prefix, number = split_key(F.col("_k"))
        keyed = rows.withColumn("_k", comparable_key(F.col("ref_key"))).where("_k is not null").withColumns({"prefix": prefix, "_n": number})
        return keyed.withColumn("block", F.floor(F.col("_n") / BLOCK)).drop("_k")

    keys = materialize(usable_keys(parents), "keys")
    counted = asked_of(refs.select("ref_key").sample(SAMPLED, 7)).select("prefix", "block")  # of one column, and few of its rows are split
    joined = salted_left_join(asked_of(refs), key_runs(keys), ["prefix", "block"], [F.col("record_key"), F.col("ref_ts")], hot_rows=hot_rows, counted=counted)
    run = F.try_element_at(F.filter("runs", lambda r: r["start"] <= F.col("_n")), F.lit(-1))  # as-of: the last that starts no later
    ts = F.col("ref_ts")
    reason = (
        F.when(F.col("_run").isNull() | (F.col("_n") > F.col("_run.end")), F.lit("missing"))
        .when(F.col("_run.first").isNull(), F.lit("withdrawn"))
        .when(ts.isNull() | (F.col("_run.first") > ts), F.lit("later"))
        .when(F.col("_run.last") > ts, F.lit("between"))
    )
    judged = joined.withColumn("_run", run).withColumn("reason", reason).where("reason is not null").drop("block", "runs", "_run")
    judged = materialize(judged, "judged")
    between = judged.where("reason = 'between'").join(keys.withColumnRenamed("n", "_n"), ["prefix", "_n"]).where("usable_from > ref_ts").withColumn("reason", F.lit("later"))
    return judged.where("reason <> 'between'").drop("prefix", "_n").unionByName(between.drop("prefix", "_n", "usable_from"))


def count_orphans(orphans: DataFrame) -> DataFrame:
    """Orphan records per table, month of the reference and reason; a repeated record counts once."""
    return (
        orphans.groupBy("record_table", "record_key", "reason").agg(F.min("ref_ts").alias("ref_ts"))
        .groupBy("record_table", F.date_format("ref_ts", "yyyy-MM").alias("month"), "reason")
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
