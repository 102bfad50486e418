"""Queries of the reference's operators over the corpus tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..durable import shared_folder
from ..functions import normalize as N
from ..operators import citations, evaluate, fulltext, graph, hierarchy, lookup, quality, segments, tables, vectors
from ..operators import index as ix
from ..session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ---- latest rows of records, shared by many queries ----


def units(spark: SparkSession, root: str) -> DataFrame:
    cols = ["unit_id", "document_id", "document_key", "global_key", "unit_type", "label", "number", "title", "legal_citation", "parent_unit_id", "sequence", "row_count", "rows_json", "is_repealed", "record_state", "loaded_at"]
    return lookup.latest(table(spark, root, "structural_units").select(*cols), ["unit_id"], "loaded_at")


def chunks(spark: SparkSession, root: str, *cols: str) -> DataFrame:
    chosen = ["chunk_id", "unit_id", "document_id", "chunk_type", "parent_chunk_id", "sequence", "page_start", "page_end", *cols, "loaded_at"]
    return lookup.latest(table(spark, root, "chunks").select(*chosen), ["chunk_id"], "loaded_at")


def references(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "refers_to_edges").dropDuplicates(["reference_id"])


U = """u as (select unit_id, m.* from (select unit_id, max(struct_pack(loaded_at := loaded_at, document_id := document_id, document_key := document_key, global_key := global_key, unit_type := unit_type, label := label, number := number, title := title, legal_citation := legal_citation, parent_unit_id := parent_unit_id, sequence := sequence, row_count := row_count, rows_json := rows_json, is_repealed := is_repealed, record_state := record_state)) as m from structural_units group by unit_id))"""
C = """c as (select chunk_id, m.* from (select chunk_id, max(struct_pack(loaded_at := loaded_at, unit_id := unit_id, document_id := document_id, chunk_type := chunk_type, parent_chunk_id := parent_chunk_id, sequence := sequence, page_start := page_start, page_end := page_end, text := text, label := label, legal_citation := legal_citation)) as m from chunks group by chunk_id))"""
R = "r as (select * from (select *, row_number() over (partition by reference_id) as rn from refers_to_edges) where rn = 1)"
_KEY = "regexp_replace(replace(lower({}), 'ß', 'ss'), '[^0-9a-z]', '', 'g')"

# ---- full-text search ----

_BM25 = """
with t as (select doc_id, source, regexp_extract_all(translate(lower(coalesce(text, '')), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '[0-9a-zß]+') as k from documents),
f as (select doc_id, source, len(k) as dl, {tf} from t),
g as (select count(*) as n, avg(dl) as av, {df} from f),
s as (select doc_id, -round({score}, 6) as score, {every} as has_all from f, g where ({some}) and ({scope})),
p as (select *, bool_or(has_all) over () as anything from s),
b as (select * from p where {keep} order by score, doc_id limit {limit})
select doc_id, score, row_number() over (order by score, doc_id)::int as rank, case when has_all then 'and' else 'or' end as relation from b
"""


def _bm25_sql(terms: list[str], scope: str = "true", keep: str = "has_all or not anything", limit: int = 10) -> str:
    n = range(len(terms))
    idf = "case when ln((n - df{i} + 0.5::double) / (df{i} + 0.5::double)) <= 0 then 1e-6::double else ln((n - df{i} + 0.5::double) / (df{i} + 0.5::double)) end"
    part = "case when tf{i} > 0 then (" + idf + ") * tf{i} * 2.2::double / (tf{i} + 1.2::double * (0.25::double + 0.75::double * dl / av)) else 0 end"
    return _BM25.format(
        tf=", ".join(f"len(list_filter(k, lambda x: x = '{t}')) as tf{i}" for i, t in enumerate(terms)), df=", ".join(f"count(*) filter (where tf{i} > 0) as df{i}" for i in n), score=" + ".join(part.format(i=i) for i in n),
        every=" and ".join(f"tf{i} > 0" for i in n), some=" or ".join(f"tf{i} > 0" for i in n), scope=scope, keep=keep, limit=limit,
    )


_indexes: dict[tuple[str, str], ix.Index] = {}


def _corpus(spark, root) -> ix.Index:
    """The stored index of all document texts, built once a session; a search then reads the postings of its terms only."""
    at = (spark.sparkContext.applicationId, root)
    if at not in _indexes:
        d = table(spark, root, "documents", True, ("doc_id", "source", "text")).select(F.format_string("%020d", "doc_id").alias("document_id"), F.lower(F.trim("source")).alias("source_kind"), "text")
        text = lambda *names: [F.lit(None).cast("string").alias(c) for c in names]
        none = d.limit(0)
        units = none.select("document_id", *text("unit_id", "label", "title", "legal_citation", "global_key", "unit_type", "number"))
        passages = d.select(F.col("document_id").alias("passage_id"), "document_id", "text", *text("title", "legal_citation"))
        _indexes[at] = ix.build(d.drop("text"), none.select("document_id", *text("alias")), units, passages, f"{shared_folder(spark)}/normwerk/index-{uuid.uuid4().hex}")
    return _indexes[at]


def _ranked(spark, root, asked: str, scope: dict[str, str | None] | None = None, mode: str = "auto"):
    hits = _corpus(spark, root).search("passages", asked, scope, 10, mode=mode)
    return hits.select(F.col("item_id").cast("bigint").alias("doc_id"), "score", "rank", "relation")


@query(_bm25_sql(["behorde", "antrag", "frist"]))
def bm25_search(spark, root):
    return _ranked(spark, root, "Behörde Antrag Frist")


@query(_bm25_sql(["erlaubnis", "quarry", "xylophon"]))
def bm25_or_fallback(spark, root):
    return _ranked(spark, root, "Erlaubnis quarry Xylophon")


@query(_bm25_sql(["anlage", "ergebnisse"], scope="lower(trim(source)) = 'gii'", keep="has_all"))
def bm25_and_scoped(spark, root):
    return _ranked(spark, root, "Anlage Ergebnisse", {"source_kind": ix.corpus_name("DE")}, "and")


@query("""with n as (select count(*) as n from documents), t as (select unnest(list_distinct(regexp_extract_all(translate(lower(text), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '[0-9a-zß]+'))) as term from documents)
select term, count(*) as df, round(ln((n + 1) / (count(*) + 1)) + 1, 6) as idf from t, n group by term, n""")
def term_idf(spark, root):
    return fulltext.idf(table(spark, root, "documents", heavy=True), "text")


@query("""with a as (select doc_id, text, lower(text) as l from documents where text is not null and text <> ''), b as (select *, greatest(1, coalesce(list_min(list_filter([instr(l, 'erlaubnis'), instr(l, 'permit')], lambda x: x > 0)), 1) - 66) as b from a),
c as (select *, substr(text, b, 200) as raw, b > 1 as cf, b + 200 <= length(text) as cb from b), d as (select *, case when cf and instr(raw, ' ') between 1 and 80 then '… ' || substr(raw, instr(raw, ' ') + 1, 200) when cf then '… ' || raw else raw end as f from c)
select doc_id, case when length(text) <= 200 then text when cb then regexp_replace(f, '\\s\\S{0,79}$', '') || ' …' else f end as snippet from d""")
def snippets(spark, root):
    return table(spark, root, "documents", heavy=True).where("text is not null and text <> ''").select("doc_id", N.snippet(F.col("text"), ["erlaubnis", "permit"]).alias("snippet"))


# ---- names and look-ups ----


@query(f"select {_KEY.format('alias')} as alias_key, count(distinct document_id) as n_targets, case when count(distinct document_id) = 1 then min(document_id) end as target from aliases where document_id is not null and {_KEY.format('alias')} <> '' group by 1")
def alias_unique_only(spark, root):
    return lookup.unique_aliases(table(spark, root, "aliases"), N.key(F.col("alias")), "document_id")


@query(f"select distinct a.alias_id, d.law_key from aliases a join (select law_key, unnest([title, short_title, abbreviation]) as name from core_laws) d on {_KEY.format('a.alias')} = {_KEY.format('d.name')} where {_KEY.format('a.alias')} <> ''")
def alias_exact(spark, root):
    a = table(spark, root, "aliases").select("alias_id", N.key(F.col("alias")).alias("k")).where("k <> ''")
    d = table(spark, root, "core_laws").select("law_key", F.explode(F.array("title", "short_title", "abbreviation")).alias("name")).select("law_key", N.key(F.col("name")).alias("k"))
    return a.join(d, "k").select("alias_id", "law_key").distinct()


@query("""with m as (select id, title, min(case when lower(id) = 'merkblatt' or lower(title) = 'merkblatt' then 0 when starts_with(lower(title), 'merkblatt') then 1 else 2 end)::int as match_rank, max(graph_mention_count) as mentions
from register_documents where contains(lower(title), 'merkblatt') or contains(lower(id), 'merkblatt') group by id, title) select * from m order by match_rank, mentions desc nulls last, title, id limit 20""")
def register_search(spark, root):
    return lookup.ranked_search(table(spark, root, "register_documents"), "id", "title", "graph_mention_count", "merkblatt", 20)


@query(f"""with {U}, k as (select unit_id, document_id, {_KEY.format('legal_citation')} as k from u where legal_citation is not null), q as (select distinct document_id, {_KEY.format('label')} as label_key from u where label is not null and {_KEY.format('label')} <> '')
select q.document_id, q.label_key, min(k.unit_id) as unit_id from q join k on k.document_id = q.document_id and ends_with(k.k, q.label_key) group by 1, 2 having count(distinct k.unit_id) = 1""")
def unit_by_unique_suffix(spark, root):
    u = units(spark, root)
    keyed = u.where("legal_citation is not null").select("unit_id", "document_id", N.key(F.col("legal_citation")).alias("k"))
    asked = u.where("label is not null").select("document_id", N.key(F.col("label")).alias("label_key")).where("label_key <> ''").distinct()
    return lookup.by_unique_suffix(asked, keyed, "label_key", "k", ["document_id"])


@query(f"""with {R}, k as (select distinct lower(trim(global_key)) as key from structural_units), a as (select distinct lower(trim(requested_target_global_key)) as asked from r where trim(requested_target_global_key) <> ''),
x as (select asked, unnest(range(0, 7)) as i from a), y as (select asked, i, case i when 0 then asked {" ".join(f"when {i} then " + "regexp_replace(" * i + "asked" + ", '_(buchst|nr|satz|abs|tabelle)_[^_]+$', '')" * i for i in range(1, 7))} end as key from x),
z as (select asked, key, min(i) as i from y group by asked, key), o as (select asked, key, row_number() over (partition by asked order by i) - 1 as steps from z),
h as (select o.asked, arg_min(o.key, steps) as resolved_key, min(steps)::int as steps from o join k on k.key = o.key group by o.asked)
select a.asked, h.resolved_key, h.steps, case when steps = 0 then 'exact' when steps > 0 then 'nearest_ancestor' else 'target_unit_missing' end as resolution from a left join h on h.asked = a.asked""")
def nearest_ancestor_key(spark, root):
    asked = table(spark, root, "refers_to_edges").select(F.lower(F.trim("requested_target_global_key")).alias("asked")).where("asked <> ''").distinct()
    keys = table(spark, root, "structural_units").select(F.lower(F.trim("global_key")).alias("key"))
    return lookup.nearest_ancestor(asked, "asked", keys)


@query("""with l as (select distinct law_key from core_laws), p as (select distinct a.law_key, b.law_key as p from l a join l b on starts_with(a.law_key, b.law_key) and length(a.law_key) > length(b.law_key))
select l.law_key, (select arg_max(p.p, length(p.p)) from p where p.law_key = l.law_key) as parent_key from l""")
def longest_prefix_parent(spark, root):
    laws = table(spark, root, "core_laws").select("law_key").distinct()
    return lookup.longest_prefix(laws, "law_key", laws.select(F.col("law_key").alias("p")), "p")


@query(f"""with {C} select unit_id, chunk_id, chunk_type from (select *, row_number() over (partition by unit_id order by case chunk_type when 'text' then 1 when 'text_part' then 2 when 'table_rows' then 3 else 4 end, sequence nulls first, chunk_id) as n from c where unit_id is not null) where n = 1""")
def preferred_chunk(spark, root):
    return lookup.preferred_first(chunks(spark, root).where("unit_id is not null"), ["unit_id"], "chunk_type", ["text", "text_part", "table_rows"], ["sequence", "chunk_id"]).select("unit_id", "chunk_id", "chunk_type")


@query("select law_key, case when act_number is null then null else array_to_string(list_sort(list_distinct(flatten([[y || '/' || n || '/' || b, s || '/' || n || '/' || b, k || ' (' || b || ') ' || y || '/' || n, k || ' (' || b || ') Nr. ' || n || '/' || y, k || ' (' || b || ') Nr. ' || n || '/' || s] for b in ['EU', 'EG', 'EWG', 'EAG']]))), ', ') end as aliases from (select law_key, act_number, split_part(act_number, '/', 1) as y, substr(act_number, 3, 2) as s, split_part(act_number, '/', 2) as n, split_part(title, ' ', 1) as k from core_laws)")
def eu_number_aliases(spark, root):
    laws = table(spark, root, "core_laws")
    y, n, k = F.split_part("act_number", F.lit("/"), F.lit(1)), F.split_part("act_number", F.lit("/"), F.lit(2)), F.split_part("title", F.lit(" "), F.lit(1))
    return laws.select("law_key", F.when(F.col("act_number").isNotNull(), F.array_join(N.eu_aliases(k, y, n), ", ")).alias("aliases"))


@query("""with k as (select distinct document_key from structural_units where document_key is not null union select distinct 'verordnung_eu_' || replace(act_number, '/', '_') from core_laws where act_number is not null union select distinct 'richtlinie_' || replace(act_number, '/', '_') || '_eg' from core_laws where act_number is not null
union select distinct 'entscheidung_eg_nr_' || split_part(act_number, '/', 2) || '_' || split_part(act_number, '/', 1) from core_laws where act_number is not null),
n as (select document_key, regexp_extract(document_key, '^celex_(3\\d{4}[rld]\\d{4})', 1) as c, regexp_extract(document_key, '_(\\d+)_(\\d+)(_eg)?$', 1) as a, regexp_extract(document_key, '_(\\d+)_(\\d+)(_eg)?$', 2) as b from k),
y as (select *, extract(year from current_date) + 2 as top from n),
f as (select *, case when document_key like 'entscheidung%' then false when document_key like 'richtlinie%' then true when length(a) = 4 and a::int between 1950 and top and (not (length(b) = 4 and b::int between 1950 and top) or a::int >= 2015) then true when length(b) = 4 and b::int between 1950 and top then false when length(a) = 4 then true when length(b) = 4 then false end as first from y where a <> '' and c = '')
select document_key, upper(c) as celex from n where c <> '' or a = '' and c <> '' union all select document_key, null from n where c = '' and a = '' union all
select document_key, case when document_key like 'richtlinie%' and a::int < 1950 and length(b) = 4 and b::int >= 1950 then '3' || b || 'L' || lpad((a::int % 100)::varchar, 4, '0') when first is not null then '3' || lpad((case when first then a::int when document_key like 'entscheidung%' and b::int between 1900 and 1949 then b::int + 100 else b::int end)::varchar, 4, '0') || case when document_key like 'verordnung%' then 'R' when document_key like 'richtlinie%' then 'L' else 'D' end || lpad((case when first then b::int else a::int end)::varchar, 4, '0') end from f""")
def celex_numbers(spark, root):
    laws = table(spark, root, "core_laws").where("act_number is not null").select(F.split_part("act_number", F.lit("/"), F.lit(1)).alias("y"), F.split_part("act_number", F.lit("/"), F.lit(2)).alias("n"))
    named = laws.select(F.explode(F.array(F.format_string("verordnung_eu_%s_%s", "y", "n"), F.format_string("richtlinie_%s_%s_eg", "y", "n"), F.format_string("entscheidung_eg_nr_%s_%s", "n", "y"))).alias("document_key"))
    keys = table(spark, root, "structural_units").select("document_key").where("document_key is not null").unionByName(named).distinct()
    return keys.select("document_key", N.celex_of_key(F.col("document_key")).alias("celex"))


# ---- context, outline and budget ----


@query(f"""with {C}, p as (select chunk_id, document_id, chunk_type, row_number() over (partition by document_id order by sequence nulls first, chunk_id) as place from c where document_id is not null)
select distinct p.document_id, p.place::int as place, p.chunk_id from p join p h on h.document_id = p.document_id and h.chunk_type = 'note' and p.place between h.place - 1 and h.place + 2""")
def context_neighbours(spark, root):
    placed = chunks(spark, root).where("document_id is not null").select("chunk_id", "document_id", "chunk_type", F.row_number().over(Window.partitionBy("document_id").orderBy("sequence", "chunk_id")).alias("place"))
    return segments.neighbours(placed.where("chunk_type = 'note'"), placed, "document_id", "place", 1, 2).select("document_id", "place", "chunk_id")


@query(f"""with {C}, b as (select document_id, chunk_id, sum(length(text)) over w as total, row_number() over w as n from c where document_id is not null and text is not null window w as (partition by document_id order by sequence nulls first, chunk_id rows unbounded preceding))
select document_id, chunk_id from b where total <= 2000 and n <= 10""")
def context_budget(spark, root):
    rows = chunks(spark, root, "text").where("document_id is not null and text is not null").withColumn("size", F.char_length("text"))
    return segments.within_budget(rows, ["document_id"], ["sequence", "chunk_id"], "size", 2000, 10).select("document_id", "chunk_id")


@query(f"""with recursive {U}, t as (select u.unit_id, u.document_id, 0 as depth from u left join u p on p.unit_id = u.parent_unit_id and p.document_id = u.document_id where p.unit_id is null
union all select u.unit_id, u.document_id, t.depth + 1 from u join t on t.unit_id = u.parent_unit_id and t.document_id = u.document_id where t.depth < 3) select document_id, unit_id, depth from t where depth <= 3""")
def outline_depth(spark, root):
    u = units(spark, root)
    inside = lambda c: F.concat_ws("\0", F.coalesce("document_id", F.lit("")), F.col(c))
    rows = u.select("document_id", "unit_id", inside("unit_id").alias("node"), F.when(F.col("parent_unit_id").isNotNull(), inside("parent_unit_id")).alias("parent"))
    return lookup.upper_levels(rows, "node", "parent", 3).select("document_id", "unit_id", "depth")


@query(f"""with recursive {U}, {C}, own as (select unit_id, min(page_start) as a, max(page_end) as b from c where page_start <= page_end group by unit_id),
up as (select unit_id, unit_id as anc from u union select up.unit_id, p.unit_id from up join u k on k.unit_id = up.anc join u p on p.unit_id = k.parent_unit_id)
select up.anc as unit_id, min(own.a) as page_start, max(own.b) as page_end from up join own on own.unit_id = up.unit_id where up.anc not in (
  select w.s from (with recursive w as (select unit_id as s, parent_unit_id as at, 1 as n from u union all select w.s, u.parent_unit_id, w.n + 1 from w join u on u.unit_id = w.at where w.n < 40) select s, max(n) as n from w group by s) w where n >= 40)
and up.unit_id not in (select w.s from (with recursive w as (select unit_id as s, parent_unit_id as at, 1 as n from u union all select w.s, u.parent_unit_id, w.n + 1 from w join u on u.unit_id = w.at where w.n < 40) select s, max(n) as n from w group by s) w where n >= 40)
group by 1""")
def page_range_rollup(spark, root):
    """Page range of each unit from its own chunks and those of everything below it; nodes that reach no root are left out."""
    own = chunks(spark, root).where("page_start <= page_end").groupBy("unit_id").agg(F.min("page_start").alias("a"), F.max("page_end").alias("b"))
    u = table(spark, root, "structural_units").select(F.lit("u").alias("record_table"), F.col("unit_id").alias("node_id"), F.col("parent_unit_id").alias("parent_id"), F.col("loaded_at").alias("stamp"), F.col("document_id").alias("place"))
    paths = hierarchy.hierarchy(u).where("path is not null").select(F.col("node_id").alias("unit_id"), F.explode("path").alias("above"))
    return own.join(paths, "unit_id").groupBy(F.col("above").alias("unit_id")).agg(F.min("a").alias("page_start"), F.max("b").alias("page_end"))


# ---- graph ----


@query(f"""with {U} select * from (select 'NEXT_UNIT' as type, unit_id as start_node_id, lead(unit_id) over w as end_node_id, (row_number() over w)::int as sequence from u
window w as (partition by document_id, coalesce(nullif(trim(parent_unit_id), ''), '-') order by sequence nulls first, unit_id)) where end_node_id is not null""")
def next_unit_edges(spark, root):
    rows = units(spark, root).withColumn("parent", F.coalesce(F.when(F.trim("parent_unit_id") != "", F.col("parent_unit_id")), F.lit("-")))
    return graph.next_edges(rows, "NEXT_UNIT", ["document_id", "parent"], "unit_id", ["sequence", "unit_id"])


_EDGES = f"""with {U}, {C}, e as (
select distinct 'CONTAINS_UNIT' as type, parent_unit_id as start_node_id, unit_id as end_node_id from u where trim(parent_unit_id) <> ''
union all select distinct 'CONTAINS_CHUNK', unit_id, chunk_id from c where trim(unit_id) <> ''
union all select distinct 'CONTAINS_CHUNK', parent_chunk_id, chunk_id from c where trim(parent_chunk_id) <> '')"""


def _edges(spark, root):
    u, c = units(spark, root), chunks(spark, root)
    return graph.edges(u, "CONTAINS_UNIT", "parent_unit_id", "unit_id").unionByName(graph.edges(c, "CONTAINS_CHUNK", "unit_id", "chunk_id")).unionByName(graph.edges(c, "CONTAINS_CHUNK", "parent_chunk_id", "chunk_id"))


@query(_EDGES + " select 'rel_' || substr(sha256(type || '|' || start_node_id || '|' || end_node_id || '|'), 1, 16) as edge_id, type, start_node_id, end_node_id from e")
def containment_edges(spark, root):
    return _edges(spark, root)


@query(_EDGES + " select type, count(*) as n_edges, count(distinct start_node_id) as n_starts from e group by type")
def edge_counts(spark, root):
    return _edges(spark, root).groupBy("type").agg(F.count(F.lit(1)).alias("n_edges"), F.countDistinct("start_node_id").alias("n_starts"))


@query(_EDGES + ", n as (select unit_id as node_id from u union select chunk_id from c) select type, start_node_id, end_node_id, case when a.node_id is null and b.node_id is null then 'both' when a.node_id is null then 'start' else 'end' end as missing from e left join n a on a.node_id = start_node_id left join n b on b.node_id = end_node_id where a.node_id is null or b.node_id is null")
def dangling_edges(spark, root):
    nodes = units(spark, root).select(F.col("unit_id").alias("node_id")).unionByName(chunks(spark, root).select(F.col("chunk_id").alias("node_id")))
    return graph.dangling(_edges(spark, root), nodes).select("type", "start_node_id", "end_node_id", "missing")


@query(f"with {U}, {C} select unit_id, unit_type from u where unit_id not in (select unit_id from c where unit_id is not null) and unit_id not in (select parent_unit_id from u where parent_unit_id is not null)")
def leaf_units(spark, root):
    u = units(spark, root)
    used = chunks(spark, root).select("unit_id").unionByName(u.select(F.col("parent_unit_id").alias("unit_id"))).where("unit_id is not null").distinct()
    return u.select("unit_id", "unit_type").join(used, "unit_id", "left_anti")


_DOC_EDGES = f"with recursive {R}, e as (select distinct source_document_id as a, target_document_key as b from r where source_document_id is not null and target_document_key is not null)"


@query(f"with {R}, {U} select source_document_id as document_id, source_unit_id as from_unit, u.unit_id as to_unit, u.unit_type, count(*) as n from r join u on u.global_key = lower(trim(r.target_global_key)) where source_unit_id is not null group by all")
def one_hop_references(spark, root):
    """Which units refer to which, with the true direction, counted over all mentions."""
    u = units(spark, root).select(F.col("global_key").alias("k"), F.col("unit_id").alias("to_unit"), "unit_type")
    r = references(spark, root).where("source_unit_id is not null").select(F.col("source_document_id").alias("document_id"), F.col("source_unit_id").alias("from_unit"), F.lower(F.trim("target_global_key")).alias("k"))
    return r.groupBy("document_id", "from_unit", "k").agg(F.count(F.lit(1)).alias("m")).join(u, "k").groupBy("document_id", "from_unit", "to_unit", "unit_type").agg(F.sum("m").alias("n"))


def _document_edges(spark, root):
    keys = units(spark, root).select(F.col("document_id").alias("source_document_id"), "document_key").distinct()
    pairs = table(spark, root, "refers_to_edges").where("target_document_key is not null").select("source_document_id", F.col("target_document_key").alias("end_node_id")).distinct()
    return pairs.join(keys, "source_document_id").select(F.col("document_key").alias("start_node_id"), "end_node_id").distinct()


@query(f"""with {U}, {R}, e as (select distinct s.document_key as a, r.target_document_key as b from r join (select distinct document_id, document_key from u) s on s.document_id = r.source_document_id where r.target_document_key is not null and s.document_key is not null),
h as (select distinct l.law_key as s, e.b as n from core_laws l join e on e.a = l.law_key), i as (select s, n, 1 as d from h union all select distinct h.s, e.b, 2 from h join e on e.a = h.n)
select s as start_id, n as node_id, min(d) as distance from i where s <> n group by 1, 2""")
def k_hop_documents(spark, root):
    """What every law reaches in two hops, hot laws too."""
    starts = table(spark, root, "core_laws").where("law_key is not null").select(F.col("law_key").alias("start_id")).distinct()
    return graph.hops(_document_edges(spark, root), starts, 2)


@query(f"with {U}, {R} select distinct * from (select 'chunk' as level, source_chunk_id as start_node_id, u.unit_id as end_node_id from r join u on u.global_key = lower(trim(r.target_global_key)) union all select 'unit', source_unit_id, u.unit_id from r join u on u.global_key = lower(trim(r.target_global_key)) union all select 'document', source_document_id, u.document_id from r join u on u.global_key = lower(trim(r.target_global_key))) where start_node_id <> end_node_id")
def reference_rollup(spark, root):
    target = units(spark, root).select(F.col("global_key").alias("key"), "unit_id", "document_id")
    refs = table(spark, root, "refers_to_edges").select("source_chunk_id", "source_unit_id", "source_document_id", F.lower(F.trim("target_global_key")).alias("key"))
    return graph.rollup(refs, "source_chunk_id", "source_unit_id", "source_document_id", target)


@query("select unit_id, count(*) as n_rows, count(distinct (coalesce(parent_unit_id, chr(0)), coalesce(record_state, chr(0)), coalesce(title, chr(0)))) as n_versions from structural_units group by unit_id having count(distinct (coalesce(parent_unit_id, chr(0)), coalesce(record_state, chr(0)), coalesce(title, chr(0)))) > 1")
def conflicting_records(spark, root):
    return graph.conflicts(table(spark, root, "structural_units").select("unit_id", "parent_unit_id", "record_state", "title"), "unit_id")


@query(f"""with {U}, {R}, p as (select distinct target_document_key as document_key from r where resolution_status = 'unresolved' and target_document_key is not null),
d as (select document_key, case when count(*) = 1 or regexp_matches(document_key, '^celex_3\\d{{4}}[rld]\\d{{4}}') then arg_max(document_id, (loaded_at, document_id)) end as document_id, count(*) as n_documents from (select document_key, document_id, max(loaded_at) as loaded_at from u where document_key is not null group by 1, 2) group by 1)
select p.document_key, d.document_id, d.n_documents from p left join d on d.document_key = p.document_key""")
def alias_closing(spark, root):
    docs = units(spark, root).where("document_key is not null").groupBy("document_key", "document_id").agg(F.max("loaded_at").alias("published")).withColumn("base_celex", N.celex_of_key(F.col("document_key")))
    placeholders = table(spark, root, "refers_to_edges").where("resolution_status = 'unresolved' and target_document_key is not null").select(F.col("target_document_key").alias("document_key"))
    return graph.close_aliases(placeholders, docs)


# ---- citations ----


@query()
def citation_mentions(spark, root):
    """Every citation of every chunk, one row a target; a parser's work, tested on inline rows."""
    return citations.extract(chunks(spark, root, "text"), "chunk_id", "text")


@query(f"""with {R}, k as (select lower(trim(target_global_key)) as key from r where trim(target_global_key) <> '')
select case when regexp_matches(key, '_buchst_[^_]+$') then 'letter' when regexp_matches(key, '_nr_[^_]+$') then 'number' when regexp_matches(key, '_satz_[^_]+$') then 'sentence' when regexp_matches(key, '_abs_[^_]+$') then 'subsection' when regexp_matches(key, '_tabelle_[^_]+$') then 'table'
when regexp_matches(key, '_para_[^_]+$') then 'paragraph' when regexp_matches(key, '_art_[^_]+$') then 'article' when regexp_matches(key, '_(anlage|anhang)_[^_]+$') then 'annex' when regexp_matches(key, '_gliederung_[^_]+$') then 'division' else 'document' end as level,
count(*) as n, count(distinct regexp_replace(key, '_(buchst|nr|satz)_.*$', '')) as n_modelled from k group by 1""")
def reference_levels(spark, root):
    keys = references(spark, root).select(F.lower(F.trim("target_global_key")).alias("key")).where("key <> ''")
    return keys.groupBy(citations.level_of(F.col("key")).alias("level")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(citations.modelled(F.col("key"))).alias("n_modelled"))


@query(f"""with {R}, m as (select target_document_key as t, source_chunk_id as s, source_document_id as d, mention_text as x from r where resolution_status = 'unresolved' and target_document_key is not null),
f as (select t, string_agg(x, ' ; ' order by x) as samples from (select t, x, row_number() over (partition by t order by x) as n from (select distinct t, x from m where x <> '')) where n <= 3 group by t)
select m.t as target, count(*) as n_mentions, count(distinct case when s <> '' then s end) as n_sources, count(distinct case when d <> '' then d end) as n_documents, any_value(f.samples) as samples from m left join f on f.t = m.t group by m.t""")
def mention_inventory(spark, root):
    return quality.mention_inventory(references(spark, root).where("resolution_status = 'unresolved'"), F.col("target_document_key"), "source_chunk_id", "source_document_id", "mention_text")


@query(f"with {R} select bucket, count(*) as n_targets, sum(n)::bigint as n_mentions from (select target_document_key, count(*) as n, case when count(*) >= 100 then 'A' when count(*) >= 10 then 'B' else 'C' end as bucket from r where target_document_key is not null group by 1) group by bucket")
def mention_buckets(spark, root):
    n = references(spark, root).where("target_document_key is not null").groupBy("target_document_key").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(quality.bucket(F.col("n")).alias("bucket")).agg(F.count(F.lit(1)).alias("n_targets"), F.sum("n").alias("n_mentions"))


@query(f"""with {R}, t as (select coalesce(resolution_status, 'none') as status, coalesce(target_level, 'none') as level, target_global_key as k from r)
select status, level, count(*) as n, count(distinct k) as n_keys from t group by status, level""")
def placeholder_audit(spark, root):
    r = references(spark, root)
    return r.groupBy(F.coalesce("resolution_status", F.lit("none")).alias("status"), F.coalesce("target_level", F.lit("none")).alias("level")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("target_global_key").alias("n_keys"))


# ---- quality ----


@query("select unit_id, count(*) as n from structural_units group by unit_id having count(*) > 1")
def duplicate_ids(spark, root):
    return quality.duplicates(table(spark, root, "structural_units"), ["unit_id"])


@query(f"with {U} select document_id, coalesce(parent_unit_id, '') as parent, sequence, count(*) as n from u group by 1, 2, 3 having count(*) > 1")
def duplicate_sequences(spark, root):
    return quality.duplicates(units(spark, root).withColumn("parent", F.coalesce("parent_unit_id", F.lit(""))), ["document_id", "parent", "sequence"])


@query("""with f as (select case when text is null then 'text_null' when trim(text) = '' then 'text_empty' when length(text) > 15000 then 'text_oversized' when page_start > page_end then 'page_range_invalid' when token_count is null then 'token_count_missing' end as code, chunk_id as example from chunks),
n as (select code, example, count(*) as n from f where code is not null group by 1, 2), k as (select *, row_number() over (partition by code order by example nulls last) as rk from n)
select code, sum(n)::bigint as occurrences, string_agg(case when rk <= 3 then example end, ', ' order by example) as examples from k group by code""")
def chunk_findings(spark, root):
    code = F.when(F.col("text").isNull(), "text_null").when(F.trim("text") == "", "text_empty").when(F.char_length("text") > 15000, "text_oversized").when(F.col("page_start") > F.col("page_end"), "page_range_invalid").when(F.col("token_count").isNull(), "token_count_missing")
    return quality.findings(table(spark, root, "chunks"), code, F.col("chunk_id"))


@query(f"""with {U} select unit_type, count(*) as total, count(*) filter (where not coalesce(is_repealed, false)) as covered, round(count(*) filter (where not coalesce(is_repealed, false)) / count(*), 6) as ratio,
case when round(count(*) filter (where not coalesce(is_repealed, false)) / count(*), 6) >= 0.9 then 'aligned' when round(count(*) filter (where not coalesce(is_repealed, false)) / count(*), 6) >= 0.4 then 'partial' else 'low' end as status from u group by unit_type""")
def coverage_by_type(spark, root):
    return quality.coverage(units(spark, root), ~F.coalesce("is_repealed", F.lit(False)), ["unit_type"])


@query("""select unit_id, declared, actual, n_shapes from (select unit_id, max(row_count) as declared, max(json_array_length(rows_json::json))::int as actual, max(len(list_distinct(list_transform(from_json(rows_json::json, '["json"]'), lambda r: array_to_string(list_sort(json_keys(r)), '|')))))::int as n_shapes
from structural_units where rows_json is not null group by unit_id, loaded_at, row_count, rows_json) where declared is null or declared <> actual or n_shapes > 1""")
def table_shapes(spark, root):
    rows = table(spark, root, "structural_units").where("rows_json is not null").select("unit_id", "loaded_at", "row_count", "rows_json").distinct()
    return tables.shape_findings(rows, "unit_id", "rows_json", "row_count")


@query(f"""with {U}, r as (select unit_id, unnest(from_json(rows_json::json, '["json"]')) as r, generate_subscripts(from_json(rows_json::json, '["json"]'), 1) - 1 as row_no from u where rows_json is not null)
select unit_id, row_no::int as row_no, k as column_name, r ->> k as cell from (select unit_id, row_no, r, unnest(json_keys(r)) as k from r)""")
def table_cells(spark, root):
    rows = units(spark, root).where("rows_json is not null").select("unit_id", F.posexplode(tables.parsed(F.col("rows_json"))).alias("row_no", "r"))
    return rows.select("unit_id", "row_no", F.explode("r").alias("column_name", "cell"))


@query()
def table_parts(spark, root):
    """Tables in parts of whole rows of at most 120 words; greedy packing, tested on inline rows."""
    return tables.parts(units(spark, root).where("rows_json is not null"), "unit_id", "rows_json", 120)


@query("""with l as (select distinct short_title as k, id from register_documents where short_title is not null), n as (select k, id, row_number() over (partition by k order by id) as n from l),
r as (select alias as k, count(*) as c from aliases where alias is not null group by alias)
select coalesce(n.k, r.k) as k, n.id as left_id, coalesce(r.c, 0) as n_right, case when n.id is null then 'right_only' when coalesce(r.c, 0) > 0 then 'both' when n.n > 1 then 'repeated' else 'left_only' end as status from n full join r on r.k = n.k and n.n = 1""")
def full_outer_reconcile(spark, root):
    left = table(spark, root, "register_documents").where("short_title is not null").select(F.col("short_title").alias("k"), F.col("id").alias("left_id")).distinct()
    return quality.reconcile(left, table(spark, root, "aliases").where("alias is not null").select(F.col("alias").alias("k")), "k", "left_id")


# ---- order, segments, sets ----


@query(f"with {U} select unit_id, legal_citation, case when n = 1 then legal_citation else legal_citation || '_part_' || n end as unique_name from (select unit_id, legal_citation, row_number() over (partition by legal_citation order by loaded_at, unit_id) as n from u where legal_citation is not null)")
def running_suffix(spark, root):
    """Every unit's citation made a name of its own: the second one of a citation gets a suffix, and so on."""
    rows = units(spark, root).where("legal_citation is not null").select("unit_id", "legal_citation", "loaded_at")
    return segments.running_suffix(rows, "legal_citation", ["loaded_at", "unit_id"]).select("unit_id", "legal_citation", "unique_name")


@query(f"with {U}, s as (select document_id, unit_id, sequence, sum(case when unit_type in ('division', 'annex') then 1 else 0 end) over (partition by document_id order by sequence nulls first, unit_id rows unbounded preceding) as segment from u) select document_id, segment::bigint as segment, count(*) as n_units, min(sequence) as first_sequence from s group by 1, 2")
def segment_by_heading(spark, root):
    s = segments.segment(units(spark, root), ["document_id"], ["sequence", "unit_id"], F.col("unit_type").isin("division", "annex"))
    return s.groupBy("document_id", "segment").agg(F.count(F.lit(1)).alias("n_units"), F.min("sequence").alias("first_sequence"))


@query(f"with {U} select unit_id, last_value(case when unit_type = 'division' then title end ignore nulls) over (partition by document_id order by sequence nulls first, unit_id rows unbounded preceding) as heading from u")
def forward_fill_heading(spark, root):
    rows = units(spark, root).withColumn("h", F.when(F.col("unit_type") == "division", F.col("title")))
    return segments.forward_fill(rows, ["document_id"], ["sequence", "unit_id"], "h", "heading").select("unit_id", "heading")


@query("""with w as (select doc_id, string_split_regex(trim(text), '\\s+') as w from documents where trim(text) <> '')
select doc_id, count(*) as n_windows, max(len(x))::int as longest from (select doc_id, list_slice(w, s + 1, s + 50) as x from (select doc_id, w, unnest(list_filter(range(0, greatest(len(w), 1), 40), lambda s: s = 0 or s + 10 < len(w))) as s from w)) group by doc_id""")
def overlap_windows(spark, root):
    words = F.split(F.trim("text"), r"\s+")
    rows = table(spark, root, "documents", heavy=True).where("trim(text) <> ''").select("doc_id", segments.overlap_windows(words, 50, 10).alias("w"))
    return rows.select("doc_id", F.size("w").cast("bigint").alias("n_windows"), F.array_max(F.transform("w", lambda x: F.size(x))).alias("longest"))


@query("select id, title, corpus_status, registered_at from (select *, row_number() over (partition by id order by registered_at desc nulls last, corpus_status desc nulls last, title desc nulls last) as n from (select distinct id, title, corpus_status, registered_at from register_documents)) where n = 1")
def latest_per_key(spark, root):
    rows = table(spark, root, "register_documents").select("id", "corpus_status", "title", "registered_at")
    return lookup.latest(rows, ["id"], "registered_at").select("id", "title", "corpus_status", "registered_at")


@query("""select user_id, event_id, ts, max(value) over w as peak, greatest(value - coalesce(lag(value) over (partition by user_id order by ts, event_id), 0), 0) as delta from events window w as (partition by user_id order by ts, event_id rows unbounded preceding)""")
def usage_delta(spark, root):
    by = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, root, "events")
    return e.select("user_id", "event_id", "ts", F.max("value").over(by.rowsBetween(Window.unboundedPreceding, 0)).alias("peak"), F.greatest(F.col("value") - F.coalesce(F.lag("value").over(by), F.lit(0.0)), F.lit(0.0)).alias("delta"))


@query("""select e.event_id, e.user_id, min_by(p.value, p.ts) as next_value, round(epoch(min(p.ts)) - epoch(any_value(e.ts)), 3) as gap from events e left join events p on p.user_id = e.user_id and p.event_type = 'purchase' and epoch(p.ts) >= epoch(e.ts) and epoch(p.ts) - epoch(e.ts) <= 7200 where e.event_type = 'click' group by e.event_id, e.user_id""")
def as_of_next(spark, root):
    e = table(spark, root, "events")
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000
    left = e.where("event_type = 'click'").select("event_id", "user_id", seconds.alias("at"))
    right = e.where("event_type = 'purchase'").select("user_id", seconds.alias("p_at"), "value")
    out = segments.as_of_next(left, right, ["user_id"], "at", "p_at", 7200, "value")
    return out.select("event_id", "user_id", "next_value", F.round("gap", 3).alias("gap"))


@query(f"with {U} select distinct global_key from u where record_state = 'active' except select distinct lower(trim(target_global_key)) from refers_to_edges where target_global_key is not null")
def unreferenced_keys(spark, root):
    keys = units(spark, root).where("record_state = 'active'").select("global_key").distinct()
    return keys.join(table(spark, root, "refers_to_edges").select(F.lower(F.trim("target_global_key")).alias("global_key")).distinct(), "global_key", "left_anti")


@query("select 'register_documents' as t, count(*) as n, count(distinct id) as n_keys from register_documents union all select 'aliases', count(*), count(distinct alias_id) from aliases union all select 'structural_units', count(*), count(distinct unit_id) from structural_units union all select 'chunks', count(*), count(distinct chunk_id) from chunks")
def status_union(spark, root):
    one = lambda t, k: table(spark, root, t).agg(F.lit(t).alias("t"), F.count(F.lit(1)).alias("n"), F.countDistinct(k).alias("n_keys"))
    return one("register_documents", "id").unionByName(one("aliases", "alias_id")).unionByName(one("structural_units", "unit_id")).unionByName(one("chunks", "chunk_id"))


# ---- vectors and evaluation ----


@query("""with q as (select embedding::double[] as q from embeddings where vec_id = 0) select vec_id, round(list_cosine_similarity(embedding::double[], q), 6) as score from embeddings, q where label <> 3 order by score desc, vec_id limit 15""")
def cosine_topk_filtered(spark, root):
    e = table(spark, root, "embeddings")
    q = e.where("vec_id = 0").select("embedding").first()[0]
    return vectors.search(e, "vec_id", "embedding", list(q), 64, 15, where=F.col("label") != 3)


@query("""select profile, count(*) as n, count(*) filter (where ok) as n_usable from (select profile, coalesce(vector is not null and len(vector) = 64 and len(list_filter(vector, lambda x: x is not null and isfinite(x))) = 64 and len(list_filter(vector, lambda x: x <> 0)) > 0, false) as ok from passage_vectors) group by profile""")
def vector_health(spark, root):
    from ..functions.normalize import valid_vector

    return table(spark, root, "passage_vectors").groupBy("profile").agg(F.count(F.lit(1)).alias("n"), F.count_if(valid_vector(F.col("vector"), 64)).alias("n_usable"))


@query("""with v as (select distinct vec_id, profile, input_hash, embedded_at, passage_id from passage_vectors), l as (select profile, passage_id, max(embedded_at) as embedded_at from v group by 1, 2)
select v.profile, count(*) as n, count(*) filter (where v.embedded_at < l.embedded_at) as n_stale from v join l on l.profile = v.profile and l.passage_id = v.passage_id group by v.profile""")
def stale_vectors(spark, root):
    v = table(spark, root, "passage_vectors").select("vec_id", "profile", "input_hash", "embedded_at", "passage_id").distinct()
    newest = v.groupBy("profile", "passage_id").agg(F.max("embedded_at").alias("newest"))
    return v.join(newest, ["profile", "passage_id"]).groupBy("profile").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("embedded_at") < F.col("newest")).alias("n_stale"))


_RANKED = """g as (select distinct source_chunk_id as case_id, lower(trim(target_global_key)) as item_id from refers_to_edges where resolution_status = 'resolved' and trim(target_global_key) <> ''),
p as (select source_chunk_id as case_id, lower(trim(requested_target_global_key)) as item_id, min(coalesce(char_start, 0)) as position from refers_to_edges where trim(requested_target_global_key) <> '' group by 1, 2),
k as (select *, row_number() over (partition by case_id order by position, item_id) as rank from p)"""


def _gold_and_ranked(spark, root):
    r = table(spark, root, "refers_to_edges")
    gold = r.where("resolution_status = 'resolved'").select(F.col("source_chunk_id").alias("case_id"), F.lower(F.trim("target_global_key")).alias("item_id")).where("item_id <> ''").distinct()
    found = r.select(F.col("source_chunk_id").alias("case_id"), F.lower(F.trim("requested_target_global_key")).alias("item_id"), F.coalesce("char_start", F.lit(0)).alias("position")).where("item_id <> ''")
    return gold, evaluate.ranks(found)


@query(f"""with {_RANKED}, c as (select g.case_id, count(*) as n, count(k.rank) as found, coalesce(1 / min(k.rank), 0) as rr from g left join k on k.case_id = g.case_id and k.item_id = g.item_id and k.rank <= 3 group by g.case_id)
select count(*) as n_cases, round(sum(found) / sum(n), 6) as recall, round(avg(rr), 6) as mrr, round(avg(case when n = found then 1.0::double else 0 end), 6) as all_evidence from c""")
def recall_and_mrr(spark, root):
    return evaluate.retrieval_metrics(*_gold_and_ranked(spark, root), 3)


@query(f"""with {_RANKED}, x as (select coalesce(g.case_id, k.case_id) as case_id, g.item_id as a, k.item_id as b from g full join (select * from k where rank <= 2) k on k.case_id = g.case_id and k.item_id = g.item_id)
select case_id, round(count(*) filter (where a is not null and b is not null) / nullif(count(b), 0), 6) as precision, round(count(*) filter (where a is not null and b is not null) / nullif(count(a), 0), 6) as recall, round(2 * count(*) filter (where a is not null and b is not null) / (count(a) + count(b)), 6) as f1 from x where case_id is not null group by case_id""")
def precision_recall(spark, root):
    gold, ranked = _gold_and_ranked(spark, root)
    return evaluate.set_measures(gold.where("case_id is not null"), ranked.where("rank <= 2 and case_id is not null").select("case_id", "item_id"))


@query("select event_type, date_trunc('day', ts) as day, count(value) as n, round(avg(value), 6) as mean, round(stddev_samp(value), 6) as stdev from events group by 1, 2")
def stability_by_day(spark, root):
    return evaluate.stability(table(spark, root, "events").withColumn("day", F.date_trunc("day", "ts")), ["event_type", "day"], "value")


@query("""with v as (select user_id, event_type, round(avg(value), 6) as value from events group by 1, 2), b as (select user_id, max(value) filter (where event_type = 'click') as l, max(value) filter (where event_type = 'view') as r from v group by 1)
select user_id, round(l - r, 6) as difference, case when round(l - r, 6) > 1 then 'left' when round(l - r, 6) < -1 then 'right' else 'tie' end as winner from b where l is not null and r is not null""")
def paired_difference(spark, root):
    v = table(spark, root, "events").groupBy("user_id", "event_type").agg(F.round(F.avg("value"), 6).alias("value"))
    return evaluate.paired(v, "user_id", "event_type", "value", "click", "view", 1.0)


@query("""with x as (select 'lexical' as source, l_partkey as item_id, row_number() over (order by sum(l_quantity) desc, l_partkey) as rank from lineitem group by l_partkey), y as (select 'semantic' as source, l_partkey as item_id, row_number() over (order by sum(l_extendedprice) desc, l_partkey) as rank from lineitem group by l_partkey),
z as (select * from x where rank <= 50 union all select * from y where rank <= 50) select item_id, round(sum(1 / (60 + rank)), 9) as score, min(case when source = 'semantic' then rank end)::int as semantic_rank from z group by item_id""")
def rank_fusion(spark, root):
    sums = table(spark, root, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("a"), F.sum("l_extendedprice").alias("b"))

    def best(source: str, by: str) -> DataFrame:
        top = sums.orderBy(F.col(by).desc(), "l_partkey").limit(50)
        return top.select(F.lit(source).alias("source"), F.col("l_partkey").alias("item_id"), F.row_number().over(Window.orderBy(F.col(by).desc(), "l_partkey")).alias("rank"))

    return evaluate.rank_fusion(best("lexical", "a").unionByName(best("semantic", "b")))
