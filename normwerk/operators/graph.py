"""The property graph of a corpus: nodes, containment and sequence edges, hops, checks and merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..durable import materialize
from ..functions import normalize as N
from ..skew import salted_left_join


def edge_id(kind: Column, start: Column, end: Column, qualifier: Column | None = None) -> Column:
    return N.hash_id("rel_", 16, kind, start, end, qualifier if qualifier is not None else F.lit(""))


def edges(rows: DataFrame, kind: str, start: str, end: str) -> DataFrame:
    """Distinct edges (edge_id, type, start_node_id, end_node_id) of one type from two columns; nulls and blanks make none."""
    pairs = rows.select(F.lit(kind).alias("type"), F.col(start).alias("start_node_id"), F.col(end).alias("end_node_id")).where("trim(start_node_id) <> '' and trim(end_node_id) <> ''").distinct()
    return pairs.select(edge_id(F.col("type"), F.col("start_node_id"), F.col("end_node_id")).alias("edge_id"), "type", "start_node_id", "end_node_id")


def next_edges(rows: DataFrame, kind: str, parent: list[str], node: str, order: list[str]) -> DataFrame:
    """Edges between neighbouring siblings with their place among them."""
    by = Window.partitionBy(*parent).orderBy(*order)
    pairs = rows.select(F.col(node).alias("start_node_id"), F.lead(node).over(by).alias("end_node_id"), F.row_number().over(by).alias("sequence")).where("end_node_id is not null")
    return pairs.select(F.lit(kind).alias("type"), "start_node_id", "end_node_id", "sequence")


def dangling(graph_edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with an endpoint that is no node, and which."""
    ids = nodes.select("node_id").distinct()
    marked = graph_edges.join(ids.select(F.col("node_id").alias("start_node_id"), F.lit(True).alias("_s")), "start_node_id", "left").join(ids.select(F.col("node_id").alias("end_node_id"), F.lit(True).alias("_e")), "end_node_id", "left")
    missing = F.when(F.col("_s").isNull() & F.col("_e").isNull(), "both").when(F.col("_s").isNull(), "start").when(F.col("_e").isNull(), "end")
    return marked.withColumn("missing", missing).where("missing is not null").drop("_s", "_e")


def hops(graph_edges: DataFrame, starts: DataFrame, k: int, direction: str = "outgoing") -> DataFrame:
    """(start_id, node_id, distance) of all nodes within k hops, the shortest distance each. starts(start_id)."""
    out = graph_edges.select(F.col("start_node_id").alias("_a"), F.col("end_node_id").alias("_b"))
    back = graph_edges.select(F.col("end_node_id").alias("_a"), F.col("start_node_id").alias("_b"))
    step = {"outgoing": out, "incoming": back, "both": out.unionByName(back)}[direction].where("_a is not null and _b is not null").distinct()
    reached = starts.select("start_id", F.col("start_id").alias("node_id"), F.lit(0).alias("distance")).distinct()
    front = reached
    for d in range(1, k + 1):
        new = front.join(step, F.col("node_id") == F.col("_a")).select("start_id", F.col("_b").alias("node_id")).distinct()
        front = materialize(new.join(reached.select("start_id", "node_id"), ["start_id", "node_id"], "left_anti").withColumn("distance", F.lit(d)), "front")
        reached = reached.unionByName(front)
    return reached.where("distance > 0")


def closure(graph_edges: DataFrame, starts: DataFrame) -> DataFrame:
    """(start_id, node_id) of all that is reached along the edges, however far, the start itself only by a cycle; one join a level."""
    step = graph_edges.select(F.col("start_node_id").alias("_a"), F.col("end_node_id").alias("_b")).where("_a is not null and _b is not null").distinct()
    reached = front = materialize(starts.select("start_id", F.col("start_id").alias("_a")).distinct().join(step, "_a").select("start_id", F.col("_b").alias("node_id")).distinct(), "front")
    while not front.isEmpty():
        new = front.join(step, F.col("node_id") == F.col("_a")).select("start_id", F.col("_b").alias("node_id")).distinct()
        front = materialize(new.join(reached, ["start_id", "node_id"], "left_anti"), "front")
        reached = reached.unionByName(front)
    return reached


def conflicts(rows: DataFrame, key: str) -> DataFrame:
    """Keys whose rows differ: (key, n_rows, n_versions). Equal rows of a key are one version."""
    content = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in rows.columns if c != key])
    return rows.select(key, content.alias("_c")).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("_c").alias("n_versions")).where("n_versions > 1")


def merge_unique(rows: DataFrame, key: str) -> DataFrame:
    """Equal duplicates of a key collapse; differing ones raise when the result is read."""
    bad = F.assert_true(F.col("_v") == 1, "a duplicate id has unequal content").isNull()
    content = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in rows.columns if c != key])
    rest = [c for c in rows.columns if c != key]
    one = rows.withColumn("_c", content).groupBy(key).agg(F.countDistinct("_c").alias("_v"), F.max(F.struct(*rest)).alias("_r"))
    return one.where(bad).select(key, *[F.col(f"_r.{c}") for c in rest])


def rollup(references: DataFrame, chunk: str, unit: str, document: str, target: DataFrame) -> DataFrame:
    """Three levels of edges for resolved chunk references: chunk to chunk or unit, unit to unit, document to document.

    target(key, unit_id, document_id). No edge from a unit or document to itself.
    """
    # a few targets are named by a large part of all references
    hit = salted_left_join(references.where("key is not null"), target.withColumnsRenamed({"unit_id": "_tu", "document_id": "_td"}), ["key"], [F.col(chunk), F.col(unit)], how="inner")
    level = lambda name, a, b: hit.select(F.lit(name).alias("level"), F.col(a).alias("start_node_id"), F.col(b).alias("end_node_id"))
    every = level("chunk", chunk, "_tu").unionByName(level("unit", unit, "_tu")).unionByName(level("document", document, "_td"))
    return every.where("start_node_id <> end_node_id").distinct()


def close_aliases(placeholders: DataFrame, documents: DataFrame) -> DataFrame:
    """placeholders(document_key) -> the document that takes its place, null where the alias is ambiguous.

    documents(document_id, document_key, base_celex, published): several documents of one key are ambiguous unless all have
    the same base CELEX number; then the latest published is it, then the greatest id.
    """
    agreed = (F.count(F.lit(1)) == 1) | ((F.count("base_celex") == F.count(F.lit(1))) & (F.count_distinct("base_celex") == 1))
    latest = F.max_by("document_id", F.struct("published", "document_id"))
    best = documents.groupBy("document_key").agg(F.when(agreed, latest).alias("document_id"), F.count(F.lit(1)).alias("n_documents"))
    return placeholders.select("document_key").distinct().join(best, "document_key", "left")
