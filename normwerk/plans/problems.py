"""Queries of the general data problems: orphan references (p3), hierarchies (p4), nested payloads (p5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import hierarchy, nested, references
from ..session import table


def _orphans(spark: SparkSession, root: str) -> DataFrame:
    edges, units, register = (table(spark, root, t) for t in ("refers_to_edges", "structural_units", "register_documents"))
    refs = edges.select(
        F.lit("refers_to_edges").alias("record_table"), F.col("reference_id").alias("record_key"), F.col("target_global_key").alias("ref_key"),
        F.col("extracted_at").alias("ref_ts"), F.coalesce("resolution_status", F.lit("none")).alias("claimed"),
    )
    unit_keys = units.select(F.col("global_key").alias("parent_key"), F.col("loaded_at").alias("parent_ts"), (F.col("record_state") == "active").alias("alive"))
    children = register.select(
        F.lit("register_documents").alias("record_table"), F.col("id").alias("record_key"), F.col("parent_document_id").alias("ref_key"),
        F.col("registered_at").alias("ref_ts"), F.lit("none").alias("claimed"),
    )
    documents = register.select(F.col("id").alias("parent_key"), F.col("registered_at").alias("parent_ts"), F.coalesce(F.col("corpus_status") != "removed", F.lit(False)).alias("alive"))
    return references.orphan_references(refs, unit_keys).unionByName(references.orphan_references(children, documents))


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    return _orphans(spark, root).select("record_table", "record_key").distinct()


def p3_orphans(spark: SparkSession, root: str) -> DataFrame:
    """Every orphan record with its reason and what the extractor believed."""
    return _orphans(spark, root).select("record_table", "record_key", "ref_key", "reason", "claimed").distinct()


def p3_by_month(spark: SparkSession, root: str) -> DataFrame:
    return references.count_orphans(_orphans(spark, root))


def _trees(spark: SparkSession, root: str, paths: bool = True) -> DataFrame:
    units, chunks = table(spark, root, "structural_units"), table(spark, root, "chunks")
    rows = units.select(
        F.lit("structural_units").alias("record_table"), F.col("unit_id").alias("node_id"), F.col("parent_unit_id").alias("parent_id"), F.col("loaded_at").alias("stamp"), F.col("document_id").alias("place")
    ).unionByName(
        chunks.select(F.lit("chunks").alias("record_table"), F.col("chunk_id").alias("node_id"), F.col("parent_chunk_id").alias("parent_id"), F.col("loaded_at").alias("stamp"), F.col("document_id").alias("place"))
    )
    return hierarchy.hierarchy(rows, paths=paths)


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    return _trees(spark, root, paths=False).where("cycle_id is not null").select("record_table", "node_id", "cycle_id")


def p4_hierarchy(spark: SparkSession, root: str) -> DataFrame:
    return _trees(spark, root).select("record_table", "node_id", "parent_id", "root_id", "depth", F.concat_ws("/", "path").alias("path"), "n_descendants", "cycle_id", "on_cycle")


def p4_descendants(spark: SparkSession, root: str) -> DataFrame:
    return hierarchy.descendants(_trees(spark, root))


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    tagged = nested.flatten(table(spark, root, "raw_payloads", True, ("payload_id", "payload")))
    return tagged.where("record_kind <> 'invalid'").select("payload_id", "record_kind", "record_id", "parent_id").distinct()


def p5_records(spark: SparkSession, root: str) -> DataFrame:
    """The tagged rows themselves, fields included; repeated payloads once."""
    return nested.flatten(table(spark, root, "raw_payloads", True, ("payload_id", "payload"))).distinct()


def p5_chunks(spark: SparkSession, root: str) -> DataFrame:
    """One of the flat tables that the tags make: all chunks of all payloads."""
    return nested.typed_table(nested.flatten(table(spark, root, "raw_payloads", True, ("payload_id", "payload"))).distinct(), "chunk")


QUERIES = {f.__name__: f for f in (p3_found, p3_orphans, p3_by_month, p4_found, p4_hierarchy, p4_descendants, p5_found, p5_records, p5_chunks)}

_TRIM = "' ' || chr(9) || chr(13) || chr(10) || chr(12) || chr(160) || chr(8199) || chr(8239) || chr(12288)"
_ORPHANS = f"""
with refs as (
  select 'refers_to_edges' as record_table, reference_id as record_key, target_global_key as ref_key, extracted_at as ref_ts,
         coalesce(resolution_status, 'none') as claimed, lower(trim(target_global_key, {_TRIM})) as k from refers_to_edges
), parents as (
  select lower(trim(global_key, {_TRIM})) as k, min(loaded_at) filter (where record_state = 'active') as usable from structural_units group by 1
), docs as (
  select 'register_documents' as record_table, id as record_key, parent_document_id as ref_key, registered_at as ref_ts, 'none' as claimed,
         lower(trim(parent_document_id, {_TRIM})) as k from register_documents
), doc_parents as (
  select lower(trim(id, {_TRIM})) as k, min(registered_at) filter (where corpus_status <> 'removed') as usable from register_documents group by 1
), judged as (
  select r.*, case when p.k is null then 'missing' when usable is null then 'withdrawn' when ref_ts is null or usable > ref_ts then 'later' end as reason
  from refs r left join parents p on r.k = p.k where r.k <> ''
  union all
  select r.*, case when p.k is null then 'missing' when usable is null then 'withdrawn' when ref_ts is null or usable > ref_ts then 'later' end
  from docs r left join doc_parents p on r.k = p.k where r.k <> ''
), orphans as (select * from judged where reason is not null)
"""

_TREES = """
with recursive latest as (
  select 'structural_units' as record_table, unit_id as node_id, max(struct_pack(s := loaded_at, p := nullif(trim(parent_unit_id), ''))).p as parent_id from structural_units group by unit_id
  union all
  select 'chunks', chunk_id, max(struct_pack(s := loaded_at, p := nullif(trim(parent_chunk_id), ''))).p from chunks group by chunk_id
), tree as (
  select l.record_table, l.node_id, l.parent_id, l.node_id as root_id, 0 as depth, [l.node_id] as path
  from latest l left join latest p on p.record_table = l.record_table and p.node_id = l.parent_id where p.node_id is null
  union all
  select l.record_table, l.node_id, l.parent_id, t.root_id, t.depth + 1, list_append(t.path, l.node_id)
  from latest l join tree t on t.record_table = l.record_table and t.node_id = l.parent_id
)
"""

_STRAY = (
    _TREES.rstrip()
    + """, stray as (
  select l.* from latest l left join tree t on t.record_table = l.record_table and t.node_id = l.node_id where t.node_id is null
), walk as (
  select record_table, node_id as start, parent_id as here, [parent_id] as seen, false as closed from stray
  union all
  select w.record_table, w.start, s.parent_id, list_append(w.seen, s.parent_id), list_contains(w.seen, s.parent_id)
  from walk w join stray s on s.record_table = w.record_table and s.node_id = w.here where not w.closed
), closed as (select *, list_slice(seen, list_position(seen, here), len(seen)) as ring from walk where closed)
"""
)

SQL = {
    "p3_found": _ORPHANS + "select distinct record_table, record_key from orphans",
    "p3_orphans": _ORPHANS + "select distinct record_table, record_key, ref_key, reason, claimed from orphans",
    "p3_by_month": _ORPHANS + "select record_table, strftime(ref_ts, '%Y-%m') as month, reason, count(distinct record_key) as n_records from orphans group by 1, 2, 3",
    "p4_descendants": _TREES
    + "select record_table, path[i] as ancestor_id, node_id as descendant_id, depth + 1 - i as distance from (select *, unnest(range(1, depth + 1))::int as i from tree where depth > 0)",
    "p4_found": _STRAY + "select record_table, start as node_id, list_min(ring) as cycle_id from closed",
    "p4_hierarchy": _STRAY.rstrip()
    + """, anc as (select record_table, start, unnest(list_distinct(seen)) as up from closed), below as (
  select record_table, up as node_id, count(*) filter (where up <> start) as n from anc group by 1, 2
  union all select record_table, node_id, count(*) from (select record_table, unnest(path[1:depth]) as node_id from tree where depth > 0) group by 1, 2
)
select t.record_table, t.node_id, t.parent_id, t.root_id, t.depth, array_to_string(t.path, '/') as path, coalesce(b.n, 0) as n_descendants, null::varchar as cycle_id, false as on_cycle
from tree t left join below b on b.record_table = t.record_table and b.node_id = t.node_id
union all
select c.record_table, c.start, c.seen[1], null, null, '', coalesce(b.n, 0), list_min(c.ring), list_contains(c.ring, c.start) from closed c left join below b on b.record_table = c.record_table and b.node_id = c.start""",
}
