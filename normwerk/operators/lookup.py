"""Finding documents and units by name: exact, unique-only, by suffix, by longest prefix, by nearest existing ancestor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Levels below a unit that a key may be shortened by, in the order in which they are tried.
LEVEL = r"_(?:buchst|nr|satz|abs|tabelle)_[^_]+$"


def unique_aliases(aliases: DataFrame, alias: Column, target: str) -> DataFrame:
    """alias -> its target if it has exactly one; ``n_targets`` tells unique from ambiguous ones. Blank aliases are none."""
    keyed = aliases.select(alias.alias("alias_key"), F.col(target).alias("t")).where("alias_key <> '' and t is not null").distinct()
    return keyed.groupBy("alias_key").agg(F.count(F.lit(1)).alias("n_targets"), F.min("t").alias("t")).select("alias_key", "n_targets", F.when(F.col("n_targets") == 1, F.col("t")).alias("target"))


def ranked_search(rows: DataFrame, id_column: str, title: str, mentions: str, query: str, limit: int) -> DataFrame:
    """Register search: an exact id or title before a prefix before any part; then by mentions, title and id."""
    q = query.lower().replace("\\", "\\\\")
    t = F.lower(F.col(title))
    wanted = F.when((F.lower(id_column) == q) | (t == q), 0).when(t.startswith(q), 1).when(t.contains(q) | F.lower(id_column).contains(q), 2)
    best = rows.withColumn("match_rank", wanted).where("match_rank is not null").groupBy(id_column, title).agg(F.min("match_rank").alias("match_rank"), F.max(mentions).alias("mentions"))
    return best.orderBy("match_rank", F.col("mentions").desc_nulls_last(), title, id_column).limit(limit)


def by_unique_suffix(asked: DataFrame, units: DataFrame, asked_key: str, unit_key: str, scope: list[str]) -> DataFrame:
    """asked(scope, asked_key) matched to the one unit in scope whose key ends with it; nothing if two do."""
    u = units.select(*[F.col(c).alias(f"u_{c}") for c in scope], F.col(unit_key).alias("_k"), F.col("unit_id").alias("_u"))
    both = asked.join(u, [F.col(c) == F.col(f"u_{c}") for c in scope]).where(F.col("_k").endswith(F.col(asked_key)) & (F.col(asked_key) != ""))
    return both.groupBy(*scope, asked_key).agg(F.countDistinct("_u").alias("n"), F.min("_u").alias("unit_id")).where("n = 1").drop("n")


def ancestors_of_key(key: Column) -> Column:
    """A key and its ancestors, nearest first: levels below a unit are stripped one by one, as many as there are."""
    step = lambda a: F.concat(a, F.array(F.regexp_replace(F.element_at(a, -1), LEVEL, "")))
    most = F.greatest(F.lit(1), F.regexp_count(key, F.lit(LEVEL[:-1])))
    return F.array_distinct(F.aggregate(F.sequence(F.lit(1), most), F.array(key), lambda a, _: step(a)))


def nearest_ancestor(asked: DataFrame, asked_key: str, keys: DataFrame) -> DataFrame:
    """asked with ``resolved_key`` (the key itself or its nearest existing ancestor), ``steps`` and ``resolution``.

    Distinct asked keys are resolved once each and joined back; keys(key) need not be unique.
    """
    wanted = asked.select(F.col(asked_key).alias("_a")).where("_a is not null").distinct()
    tried = wanted.select("_a", F.posexplode(ancestors_of_key(F.col("_a"))).alias("steps", "key"))
    found = tried.join(keys.select("key").distinct(), "key").groupBy("_a").agg(F.min_by("key", "steps").alias("resolved_key"), F.min("steps").alias("steps"))
    out = asked.join(found, F.col(asked_key) == F.col("_a"), "left").drop("_a")
    return out.withColumn("resolution", F.when(F.col("steps") == 0, "exact").when(F.col("steps") > 0, "nearest_ancestor").otherwise("target_unit_missing"))


def longest_prefix(rows: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Each row's parent: the longest proper prefix of its key that is a parent key. Prefixes are exploded and joined, no theta join."""
    prefixes = rows.select(key).distinct().withColumn("_p", F.explode(F.when(F.char_length(key) > 1, F.transform(F.sequence(F.lit(1), F.char_length(key) - 1), lambda n: F.substring(F.col(key), F.lit(1), n)))))
    found = prefixes.join(parents.select(F.col(parent_key).alias("_p")).distinct(), "_p").groupBy(key).agg(F.max_by("_p", F.char_length("_p")).alias("parent_key"))
    return rows.join(found, key, "left")


def preferred_first(rows: DataFrame, group: list[str], kind: str, order: list[str], then: list[str]) -> DataFrame:
    """One row a group: the first kind of ``order`` that it has, else any, by ``then``."""
    rank = F.coalesce(F.array_position(F.array(*[F.lit(k) for k in order]), F.col(kind)), F.lit(0))
    by = Window.partitionBy(*group).orderBy(F.when(rank > 0, rank).otherwise(len(order) + 1), *then)
    return rows.withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n")


def latest(rows: DataFrame, key: list[str], stamp: str) -> DataFrame:
    """One row a key, that of the latest stamp; of equal ones the greatest. A map-side combined aggregate, no window."""
    rest = [c for c in rows.columns if c not in key]
    picked = rows.groupBy(*key).agg(F.max(F.struct(F.col(stamp).alias("_s"), *rest)).alias("_r"))
    return picked.select(*key, *[F.col(f"_r.{c}") for c in rest])


def numbered(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """A place for each row of a short list."""
    return rows.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def first_step(rows: DataFrame, step: str) -> DataFrame:
    """The rows of the smallest step that has any."""
    least = rows.agg(F.min(step).alias("_least"))
    return rows.crossJoin(F.broadcast(least)).where(F.col(step) == F.col("_least")).drop(step, "_least")  # one row


def upper_levels(rows: DataFrame, node: str, parent: str, most: int) -> DataFrame:
    """The rows up to ``most`` levels below a root, with their ``depth``: one join a level, none to build whole trees.

    A root has no parent among the rows.
    """
    ids = rows.select(F.col(node).alias(parent)).distinct()
    level = rows.join(ids, parent, "left_anti").select(*rows.columns).withColumn("depth", F.lit(0))
    out = level
    for d in range(1, most + 1):
        level = rows.join(level.select(F.col(node).alias(parent)), parent, "left_semi").withColumn("depth", F.lit(d))
        out = out.unionByName(level)
    return out
