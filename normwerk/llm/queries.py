"""Queries of the problems tagged llm: p1, p2 and p6 to p10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import canonical, leakage, mixing, neighbours, repair, residue, split


def _items(spark: SparkSession, root: str) -> DataFrame:
    chunks, units = table(spark, root, "chunks"), table(spark, root, "structural_units")
    return chunks.select(F.lit("chunk").alias("item_type"), F.col("chunk_id").alias("item_id"), F.col("text").alias("content")).unionByName(
        units.select(F.lit("table").alias("item_type"), F.col("unit_id").alias("item_id"), F.col("rows_json").alias("content"))
    )


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    return split.split_oversized(_items(spark, root)).select("item_type", "item_id").distinct()


def p1_pieces(spark: SparkSession, root: str) -> DataFrame:
    """All pieces of all oversized items; only the oversized ones are shuffled, to bring repeated rows together."""
    over = split.oversized(_items(spark, root), 4000, 60).groupBy("item_type", "item_id").agg(F.max("content").alias("content"))
    return split.split_oversized(over)


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    near = neighbours.nearest(table(spark, root, "passage_vectors"), k=5, dimensions=64, min_similarity=0.88)
    return near.select(F.least("vec_id", "neighbour_id").alias("vec_id_a"), F.greatest("vec_id", "neighbour_id").alias("vec_id_b")).distinct()


def p2_neighbours(spark: SparkSession, root: str) -> DataFrame:
    """The 5 most similar vectors of every vector whose id is divisible by 20, among all."""
    near = neighbours.nearest(table(spark, root, "passage_vectors"), k=5, dimensions=64, is_query=F.col("vec_id") % 20 == 0)
    return near.select("vec_id", "neighbour_id", F.round("similarity", 6).alias("similarity"), "rank")


def _mapped(spark: SparkSession, root: str) -> DataFrame:
    # the name as typed; where there is none, its stored normal form (which may be stale, so it comes second)
    name = F.coalesce(F.when(F.trim("alias") != "", F.col("alias")), F.col("normalized_alias"))
    return canonical.map_names(table(spark, root, "aliases").select(F.col("alias_id").alias("name_id"), name.alias("name")), table(spark, root, "core_laws"))


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    return _mapped(spark, root).where("law_key is not null").select(F.col("name_id").alias("alias_id"), "law_key")


def p6_mapping(spark: SparkSession, root: str) -> DataFrame:
    """Every alias with its entry, or with method ``none``."""
    return _mapped(spark, root).select(F.col("name_id").alias("alias_id"), "name", "law_key", "method", F.round("jaccard", 6).alias("jaccard"), "edits")


def _texts(spark: SparkSession, root: str) -> DataFrame:
    register, aliases = table(spark, root, "register_documents"), table(spark, root, "aliases")
    return register.select(F.lit("register_documents").alias("record_table"), F.col("id").alias("record_key"), F.col("title").alias("text")).unionByName(
        aliases.select(F.lit("aliases").alias("record_table"), F.col("alias_id").cast("string").alias("record_key"), F.col("alias").alias("text"))
    )


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    return repair.repair(_texts(spark, root)).where("odd_characters or look_alikes > 0").select("record_table", "record_key").distinct()


def p7_repaired(spark: SparkSession, root: str) -> DataFrame:
    """Every title and alias in its one consistent form."""
    return repair.repair(_texts(spark, root)).distinct()


def p8_found(spark: SparkSession, root: str) -> DataFrame:
    return leakage.leaks(table(spark, root, "documents", True, ("doc_id", "text")), table(spark, root, "eval_cases")).select("doc_id", "item_id")


def p8_leaks(spark: SparkSession, root: str) -> DataFrame:
    """Every leak with the longest shared run and the share of the item that it is."""
    return leakage.leaks(table(spark, root, "documents", True, ("doc_id", "text")), table(spark, root, "eval_cases")).withColumn("item_share", F.round("item_share", 6))


def _mixture(spark: SparkSession, root: str) -> mixing.Mixture:
    return mixing.mix(mixing.count_tokens(table(spark, root, "documents", True, ("doc_id", "source", "text"))), table(spark, root, "mix_targets"))


def p9_mixture(spark: SparkSession, root: str) -> DataFrame:
    """The chosen documents in training order, each as often as it is used."""
    return mixing.in_order(_mixture(spark, root).positions)


def p9_chosen(spark: SparkSession, root: str) -> DataFrame:
    return _mixture(spark, root).chosen


def p9_shares(spark: SparkSession, root: str) -> DataFrame:
    return _mixture(spark, root).shares.withColumn("actual_share", F.round("actual_share", 6))


def p10_found(spark: SparkSession, root: str) -> DataFrame:
    return residue.residue(table(spark, root, "documents", True, ("doc_id", "text"))).where("has_placeholder or is_page or is_filler").select("doc_id").distinct()


def p10_clean(spark: SparkSession, root: str) -> DataFrame:
    """The documents that are left, without their texts."""
    return residue.without_residue(table(spark, root, "documents", True, ("doc_id", "source", "text"))).drop("text")


QUERIES = {
    f.__name__: f
    for f in (
        p1_found, p1_pieces, p2_found, p2_neighbours, p6_found, p6_mapping, p7_found, p7_repaired, p8_found, p8_leaks, p9_mixture, p9_chosen, p9_shares, p10_found, p10_clean,
    )
}

_USABLE = """
with usable as (
  select vec_id, any_value(profile) as profile, any_value(vector)::double[] as v from passage_vectors
  where vector is not null and len(vector) = 64 and profile is not null
    and len(list_filter(vector, lambda x: x is not null and isfinite(x))) = 64 and len(list_filter(vector, lambda x: x <> 0)) > 0
  group by vec_id
), pairs as (
  select a.vec_id, b.vec_id as neighbour_id, round(list_cosine_similarity(a.v, b.v), 12) as s
  from usable a join usable b on a.profile = b.profile and a.vec_id <> b.vec_id {where}
), ranked as (select *, row_number() over (partition by vec_id order by s desc, neighbour_id) as rank from pairs)
"""

SQL = {
    "p1_found": """select distinct 'chunk' as item_type, chunk_id as item_id from chunks where length(text) > 4000
        union all select distinct 'table', unit_id from structural_units where json_array_length(case when json_valid(rows_json) then rows_json::json end) > 60""",
    "p2_found": _USABLE.format(where="") + "select distinct least(vec_id, neighbour_id) as vec_id_a, greatest(vec_id, neighbour_id) as vec_id_b from ranked where rank <= 5 and s >= 0.88",
    "p2_neighbours": _USABLE.format(where="where a.vec_id % 20 = 0") + "select vec_id, neighbour_id, round(s, 6) as similarity, rank::int as rank from ranked where rank <= 5",
}
