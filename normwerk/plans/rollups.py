"""Queries of roll-ups, carry-overs, orders, set operations and joins over the corpus tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..operators import crossrefs, graph, lookup, segments, vectors
from ..session import table
from .reference import _KEY, C, R, U, chunks, references, units

QUERIES = {}
SQL = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ---- aggregates ----


@query(f"with {C}, d as (select distinct document_id from c where document_id is not null) select d.document_id, (coalesce(max(case when c.chunk_type = 'note' then c.sequence end), -1) + 1)::int as next_position from d left join c using (document_id) group by 1")
def next_positions(spark, root):
    """Where notes that are added to a document go on."""
    rows = chunks(spark, root).where("document_id is not null")
    return rows.groupBy("document_id").agg((F.coalesce(F.max(F.when(F.col("chunk_type") == "note", F.col("sequence"))), F.lit(-1)) + 1).alias("next_position"))


@query(f"with {U}, k as (select document_key, document_id, max(loaded_at) as t from u where document_key is not null and document_id is not null group by 1, 2), m as (select document_key, max(t) as latest from k group by 1) select k.document_key, m.latest, count(*) as n_latest, min(document_id) as document_id, case when count(*) > 1 then 'several_latest' end as fault from k join m on m.document_key = k.document_key and m.latest = k.t group by 1, 2")
def latest_versions(spark, root):
    """The document of each law that was loaded last; several of the same time are a fault."""
    k = units(spark, root).where("document_key is not null and document_id is not null").groupBy("document_key", "document_id").agg(F.max("loaded_at").alias("t"))
    last = k.groupBy("document_key", "t").agg(F.count(F.lit(1)).alias("n_latest"), F.min("document_id").alias("document_id"))
    best = lookup.latest(last.withColumnRenamed("t", "latest"), ["document_key"], "latest").join(last.select("document_key", F.col("t").alias("latest")), ["document_key", "latest"], "left_semi")
    return best.select("document_key", "latest", "n_latest", "document_id", F.when(F.col("n_latest") > 1, "several_latest").alias("fault"))


@query("""with p as (select coalesce(corpus_status, 'none') as status, coalesce(landing_url, '') as path, count(*) as n, max(graph_mention_count) as size from register_documents group by 1, 2)
select status, sum(n)::bigint as n_rows, count(*) as n_paths, sum(size)::bigint as total from p group by status""")
def manifest_rollup(spark, root):
    """Rows and sizes by status; what is listed several times under one path is counted once."""
    d = table(spark, root, "register_documents")
    p = d.groupBy(F.coalesce("corpus_status", F.lit("none")).alias("status"), F.coalesce("landing_url", F.lit("")).alias("path")).agg(F.count(F.lit(1)).alias("n"), F.max("graph_mention_count").alias("size"))
    return p.groupBy("status").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_paths"), F.sum("size").alias("total"))


_SCENARIOS = (("low", 0.075, 0.25), ("middle", 0.1, 0.4), ("high", 0.2, 1.25))


@query("""with s as (select event_type, count(*) as n, sum(value) as used from events group by 1), p(scenario, per_call, per_unit) as (values ('low', 0.075::double, 0.25::double), ('middle', 0.1::double, 0.4::double), ('high', 0.2::double, 1.25::double))
select event_type, scenario, n, round(n * per_call + used * per_unit, 4) as cost from s, p""")
def cost_scenarios(spark, root):
    """What the calls of each kind cost at three prices; the sums are made once."""
    s = table(spark, root, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("used"))
    each = s.withColumn("p", F.explode(F.array(*[F.struct(F.lit(a).alias("scenario"), F.lit(b).alias("per_call"), F.lit(c).alias("per_unit")) for a, b, c in _SCENARIOS])))
    return each.select("event_type", "p.scenario", "n", F.round(F.col("n") * F.col("p.per_call") + F.col("used") * F.col("p.per_unit"), 4).alias("cost"))


@query(f"with {U} select document_key, count(distinct document_id) as n_documents, bool_and(coalesce(record_state = 'active', false)) as all_active, arg_max(document_id, (loaded_at, document_id)) as newest from u where document_key is not null and document_id is not null group by 1")
def collected_documents(spark, root):
    """How many documents a law has, whether all that is of it is active, and the first of them in order, without collecting any."""
    u = units(spark, root).where("document_key is not null and document_id is not null")
    return u.groupBy("document_key").agg(F.countDistinct("document_id").alias("n_documents"), F.bool_and(F.coalesce(F.col("record_state") == "active", F.lit(False))).alias("all_active"), F.max_by("document_id", F.struct("loaded_at", "document_id")).alias("newest"))


@query(f"""with {R}, p as (select target_level as level, target_global_key as k, count(*) as n from r where resolution_status = 'unresolved' and target_global_key is not null group by 1, 2), t as (select *, (row_number() over (order by n desc, k, level))::int as place, sum(n) over ()::bigint as total, count(*) over () as n_keys from p)
select level, k, n, place, total, n_keys, round(total / n_keys, 6) as per_key from t where place <= 25""")
def placeholder_top(spark, root):
    """The 25 placeholders that are named most, and what is to be expected of one."""
    p = references(spark, root).where("resolution_status = 'unresolved' and target_global_key is not null").groupBy(F.col("target_level").alias("level"), F.col("target_global_key").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    total = p.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("n_keys"))
    top = lookup.numbered(p.orderBy(F.col("n").desc(), "k", "level").limit(25), [F.col("n").desc(), F.col("k"), F.col("level")], "place")
    return top.crossJoin(F.broadcast(total)).select("level", "k", "n", "place", "total", "n_keys", F.round(F.col("total") / F.col("n_keys"), 6).alias("per_key"))  # one row


@query(f"with {U}, r as (select unit_id, unnest(from_json(rows_json::json, '[\"json\"]'))::varchar as r from u where rows_json is not null) select unit_id, count(*) as n_rows, count(*) - count(distinct md5(r)) as n_repeated from r group by 1 having count(*) > count(distinct md5(r))")
def repeated_rows(spark, root):
    """Tables that hold equal rows, by the rows' fingerprints."""
    rows = units(spark, root).where("rows_json is not null").select("unit_id", F.explode(F.from_json("rows_json", "array<string>")).alias("r"))
    counted = rows.groupBy("unit_id").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(F.md5("r")).alias("n"))
    return counted.where("n_rows > n").select("unit_id", "n_rows", (F.col("n_rows") - F.col("n")).alias("n_repeated"))


# ---- windows ----


@query("select chunk_id, place::int as place, step from (select chunk_id, unnest(source_order) as step, generate_subscripts(source_order, 1) - 1 as place from (select distinct chunk_id, source_order from chunks))")
def reading_order(spark, root):
    """The place of each step in its list is its order, whatever its number says."""
    return table(spark, root, "chunks").select("chunk_id", "source_order").distinct().select("chunk_id", F.posexplode("source_order").alias("place", "step"))


@query(f"""with {U}, a as (select document_id, unit_id, sequence, try_cast(regexp_extract(label, '(\\d+)', 1) as int) as n from u where unit_type in ('annex', 'division') and document_id is not null)
select document_id, unit_id, n, coalesce(n > max(n) over (partition by document_id order by sequence nulls first, unit_id rows between unbounded preceding and 1 preceding), n is not null) as accepted from a""")
def accepted_starts(spark, root):
    """Headings whose number doesn't go back behind one that was there before; only those begin a segment."""
    a = units(spark, root).where("unit_type in ('annex', 'division') and document_id is not null").select("document_id", "unit_id", "sequence", F.regexp_extract("label", r"(\d+)", 1).try_cast("int").alias("n"))
    before = Window.partitionBy("document_id").orderBy("sequence", "unit_id").rowsBetween(Window.unboundedPreceding, -1)
    return a.select("document_id", "unit_id", "n", F.coalesce(F.col("n") > F.max("n").over(before), F.col("n").isNotNull()).alias("accepted"))


@query("""with e as (select *, row_number() over (partition by user_id order by ts, event_id) as seq from events), m as (select user_id, seq, coalesce(lag(seq) over (partition by user_id order by seq), 0) as prev from e where event_type = 'purchase')
select m.user_id, m.seq, count(*) as n_events, round(sum(e.value), 4) as total from m join e on e.user_id = m.user_id and e.seq > m.prev and e.seq <= m.seq group by 1, 2""")
def event_windows(spark, root):
    """What happened between one purchase of a user and the next: each event goes to the first mark at or after it."""
    by = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, root, "events").withColumn("seq", F.row_number().over(by))
    mark = F.first(F.when(F.col("event_type") == "purchase", F.col("seq")), ignorenulls=True).over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return e.withColumn("mark", mark).where("mark is not null").groupBy("user_id", F.col("mark").alias("seq")).agg(F.count(F.lit(1)).alias("n_events"), F.round(F.sum("value"), 4).alias("total"))


@query(f"""with {C}, o as (select chunk_id, document_id, chunk_type, row_number() over (partition by document_id order by sequence nulls first, chunk_id) as p from c where document_id is not null),
x as (select *, max(case when chunk_type in ('table', 'table_part') then p end) over (partition by document_id order by p rows between unbounded preceding and 1 preceding) as last_table, max(case when chunk_type = 'note' then p end) over (partition by document_id order by p rows between unbounded preceding and 1 preceding) as last_note from o)
select x.chunk_id, n.chunk_id as cue from x left join o n on n.document_id = x.document_id and n.p = x.last_note and x.last_note > coalesce(x.last_table, 0) where x.chunk_type in ('table', 'table_part')""")
def pending_cues(spark, root):
    """The note that stands before a table and after the table before it: each cue is used once."""
    by = Window.partitionBy("document_id").orderBy("sequence", "chunk_id")
    rows = chunks(spark, root).where("document_id is not null").withColumn("p", F.row_number().over(by))
    is_table = F.col("chunk_type").isin("table", "table_part")
    before = Window.partitionBy("document_id").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    cue = F.last(F.when(F.col("chunk_type") == "note", F.struct("p", "chunk_id")), ignorenulls=True).over(before)
    rows = rows.select("chunk_id", is_table.alias("t"), cue.alias("cue"), F.last(F.when(is_table, F.col("p")), ignorenulls=True).over(before).alias("last_table"))
    return rows.where("t").select("chunk_id", F.when(F.col("cue.p") > F.coalesce("last_table", F.lit(0)), F.col("cue.chunk_id")).alias("cue"))


@query(f"""with {C}, s as (select *, sum(case when chunk_type = 'text_part' then 0 else 1 end) over (partition by unit_id order by sequence nulls first, chunk_id rows unbounded preceding) as seg from c where unit_id is not null and text is not null)
select unit_id, seg::bigint as segment, count(*) as n_parts, min(struct_pack(q := sequence, c := chunk_id)).c as first_chunk, md5(string_agg(text, chr(10) order by sequence nulls first, chunk_id)) as text_md5 from s group by 1, 2""")
def merged_continuations(spark, root):
    """Parts of a text are joined to the chunk that they go on from."""
    rows = chunks(spark, root, "text").where("unit_id is not null and text is not null")
    cut = segments.segment(rows, ["unit_id"], ["sequence", "chunk_id"], F.col("chunk_type").isNull() | (F.col("chunk_type") != "text_part"))
    parts = F.array_sort(F.collect_list(F.struct("sequence", "chunk_id", "text")))  # the parts of one text
    merged = cut.groupBy("unit_id", "segment").agg(F.count(F.lit(1)).alias("n_parts"), F.min(F.struct("sequence", "chunk_id")).alias("f"), parts.alias("p"))
    return merged.select("unit_id", "segment", "n_parts", F.col("f.chunk_id").alias("first_chunk"), F.md5(F.array_join(F.transform("p", lambda x: x["text"]), "\n")).alias("text_md5"))


# ---- orders ----


@query("""with q as (select embedding::double[] as q from embeddings where vec_id = 7), t as (select vec_id, label, round(list_cosine_similarity(embedding::double[], q), 9) as score from embeddings, q order by score desc, vec_id limit 100)
select vec_id, score from t where label = 3 order by score desc, vec_id limit 5""")
def oversampled_topk(spark, root):
    """Filters after the candidates: min(1000, max(50, 20 k)) of them are looked at, so there may be fewer than k that pass."""
    k = 5
    e = table(spark, root, "embeddings")
    length = lambda v: F.sqrt(N.dot(v, v))
    asked = e.where("vec_id = 7").select(F.col("embedding").alias("q"))
    scored = e.crossJoin(F.broadcast(asked)).select("vec_id", "label", F.round(N.dot(F.col("embedding"), F.col("q")) / (length(F.col("embedding")) * length(F.col("q"))), 9).alias("score"))  # one row
    pool = scored.orderBy(F.col("score").desc(), "vec_id").limit(min(1000, max(50, 20 * k)))
    return pool.where("label = 3").orderBy(F.col("score").desc(), "vec_id").limit(k).select("vec_id", "score")


@query(f"""with {C}, s as (select chunk_id, unit_id, page_start, sequence, legal_citation from c where unit_id is not null) select chunk_id, unit_id, (row_number() over (partition by unit_id order by page_start is null, page_start, sequence is null, sequence, coalesce(legal_citation, ''), chunk_id))::int as place from s""")
def sibling_order(spark, root):
    """Siblings of any kind in one order: those with pages first, then by sequence, then by name."""
    rows = chunks(spark, root, "legal_citation").where("unit_id is not null")
    by = Window.partitionBy("unit_id").orderBy(F.col("page_start").asc_nulls_last(), F.col("sequence").asc_nulls_last(), F.coalesce("legal_citation", F.lit("")), "chunk_id")
    return rows.select("chunk_id", "unit_id", F.row_number().over(by).alias("place"))


@query(f"with {U} select unit_type, unit_id, (row_number() over (partition by unit_type order by coalesce(global_key, ''), unit_id))::int as place from u where unit_type is not null")
def canonical_nodes(spark, root):
    """Nodes of a label in their canonical order: by key, then by id."""
    by = Window.partitionBy("unit_type").orderBy(F.coalesce("global_key", F.lit("")), "unit_id")
    return units(spark, root).where("unit_type is not null").select("unit_type", "unit_id", F.row_number().over(by).alias("place"))


@query("select w as word, count(*) as n from (select unnest(string_split(lower(trim(title)), ' ')) as w from register_documents where title is not null) where w <> '' group by w order by n desc, w limit 30")
def most_common(spark, root):
    words = table(spark, root, "register_documents").where("title is not null").select(F.explode(F.split(F.lower(F.trim("title")), " ")).alias("word")).where("word <> ''")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "word").limit(30)


@query(f"with {U} select unit_id, document_key from u where record_state = 'withdrawn' and document_key is not null order by document_key, unit_id limit 40")
def next_batch(spark, root):
    """The first of the work that is left, in order."""
    return units(spark, root).where("record_state = 'withdrawn' and document_key is not null").select("unit_id", "document_key").orderBy("document_key", "unit_id").limit(40)


# ---- sets ----


@query(f"with {U}, {C} select distinct document_id from c where document_id is not null except select distinct document_id from u where record_state = 'active'")
def untracked_documents(spark, root):
    """Found, but not on the list of what is tracked."""
    listed = units(spark, root).where("record_state = 'active'").select("document_id").distinct()
    return chunks(spark, root).where("document_id is not null").select("document_id").distinct().join(listed, "document_id", "left_anti")


@query(f"""with {R}, {U}, a as (select distinct source_document_id as d, lower(trim(target_global_key)) as k from r where source_document_id is not null and trim(target_global_key) <> ''), b as (select distinct document_id as d, global_key as k from u where document_id is not null and global_key is not null), x as (select coalesce(a.d, b.d) as d, a.k as ak, b.k as bk from a full join b on a.d = b.d and a.k = b.k)
select d as document_id, count(*) filter (where bk is null) as only_referred, count(*) filter (where ak is null) as only_defined, count(*) filter (where ak = bk) as n_both from x group by d""")
def references_and_definitions(spark, root):
    """Of each document: keys it refers to and doesn't define, and the other way round."""
    a = references(spark, root).select(F.col("source_document_id").alias("d"), F.lower(F.trim("target_global_key")).alias("k")).where("d is not null and k <> ''").distinct().withColumn("_a", F.lit(1))
    b = units(spark, root).select(F.col("document_id").alias("d"), F.col("global_key").alias("k")).where("d is not null and k is not null").distinct().withColumn("_b", F.lit(1))
    x = a.join(b, ["d", "k"], "full")
    return x.groupBy(F.col("d").alias("document_id")).agg(F.count_if(F.col("_b").isNull()).alias("only_referred"), F.count_if(F.col("_a").isNull()).alias("only_defined"), F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("n_both"))


_CUT = "2024-09-01"


@query(f"""with a as (select unit_id, max(struct_pack(t := loaded_at, p := coalesce(parent_unit_id, ''), s := coalesce(record_state, ''))) as m from structural_units where loaded_at < timestamp '{_CUT}' group by 1), b as (select unit_id, max(struct_pack(t := loaded_at, p := coalesce(parent_unit_id, ''), s := coalesce(record_state, ''))) as m from structural_units group by 1)
select coalesce(a.unit_id, b.unit_id) as unit_id, case when a.unit_id is null then 'added' else 'changed' end as change from a full join b using (unit_id) where a.unit_id is null or a.m.p <> b.m.p or a.m.s <> b.m.s""")
def snapshot_changes(spark, root):
    """What a snapshot of all loads has that one of the earlier loads hadn't, or had otherwise."""
    rows = table(spark, root, "structural_units").select("unit_id", "loaded_at", F.coalesce("parent_unit_id", F.lit("")).alias("p"), F.coalesce("record_state", F.lit("")).alias("s"))
    state = F.struct("loaded_at", "p", "s")
    both = rows.groupBy("unit_id").agg(F.max(F.when(F.col("loaded_at") < F.lit(_CUT).cast("timestamp_ntz"), state)).alias("a"), F.max(state).alias("b"))
    change = F.when(F.col("a").isNull(), "added").when((F.col("a.p") != F.col("b.p")) | (F.col("a.s") != F.col("b.s")), "changed")
    return both.select("unit_id", change.alias("change")).where("change is not null")


# ---- joins ----


@query(f"with {C}, v as (select distinct vec_id, passage_id, profile from passage_vectors) select v.vec_id, v.profile, c.chunk_id, c.unit_id from v left join c on c.chunk_id = v.passage_id")
def vectors_of_chunks(spark, root):
    """Every vector with its chunk, if there is one."""
    v = table(spark, root, "passage_vectors").select("vec_id", "passage_id", "profile").distinct()
    return v.join(chunks(spark, root).select(F.col("chunk_id").alias("passage_id"), F.col("chunk_id"), "unit_id"), "passage_id", "left").select("vec_id", "profile", "chunk_id", "unit_id")


@query(f"""with {C}, k as (select unit_id, count(*) filter (where chunk_type = 'table') as n_tables, count(*) filter (where chunk_type in ('text', 'text_part')) as n_texts, min(case when chunk_type = 'table' then chunk_id end) as the_table from c where unit_id is not null group by 1)
select c.chunk_id, case when n_tables = 1 and n_texts = 0 then the_table end as table_chunk from c join k using (unit_id) where c.chunk_type = 'note'""")
def notes_of_tables(spark, root):
    """A note belongs to the table of its unit if that has one only and no text that could mean it."""
    c = chunks(spark, root).where("unit_id is not null")
    k = c.groupBy("unit_id").agg(F.count_if(F.col("chunk_type") == "table").alias("t"), F.count_if(F.col("chunk_type").isin("text", "text_part")).alias("x"), F.min(F.when(F.col("chunk_type") == "table", F.col("chunk_id"))).alias("the_table"))
    return c.where("chunk_type = 'note'").join(k, "unit_id").select("chunk_id", F.when((F.col("t") == 1) & (F.col("x") == 0), F.col("the_table")).alias("table_chunk"))


@query(f"""with a as (select distinct alias from aliases where alias is not null), l as (select law_key, {_KEY.format('title')} as t, {_KEY.format('short_title')} as s from core_laws), f as (select t, min(law_key) as k from l where t is not null group by t), g as (select s, min(law_key) as k from l where s is not null group by s having count(distinct law_key) = 1)
select alias, coalesce(f.k, g.k) as law_key, case when f.k is not null then 'full_name' when g.k is not null then 'unique_name' else 'none' end as step from (select alias, {_KEY.format('alias')} as q from a) a left join f on f.t = a.q left join g on g.s = a.q""")
def two_stage_names(spark, root):
    """By the full name, else by the short one if that is unique."""
    a = table(spark, root, "aliases").where("alias is not null").select("alias", N.key(F.col("alias")).alias("q")).distinct()
    laws = table(spark, root, "core_laws")
    full = laws.select(N.key(F.col("title")).alias("q"), "law_key").where("q is not null").groupBy("q").agg(F.min("law_key").alias("f"))
    short = lookup.unique_aliases(laws, N.key(F.col("short_title")), "law_key").where("target is not null").select(F.col("alias_key").alias("q"), F.col("target").alias("g"))
    both = a.join(full, "q", "left").join(short, "q", "left")
    return both.select("alias", F.coalesce("f", "g").alias("law_key"), F.when(F.col("f").isNotNull(), "full_name").when(F.col("g").isNotNull(), "unique_name").otherwise("none").alias("step"))


@query(f"""with {R}, {U}, i as (select target_document_key as key, count(*) as n from r where target_document_key is not null group by 1), k as (select distinct document_key from u), f as (select document_id, count(*) as n_names from aliases where document_id is not null group by 1),
reg as (select id, parent_document_id, max(graph_mention_count) as m from register_documents where id is not null group by 1, 2), n as (select title, min(id) as id from register_documents where title is not null group by 1)
select i.key, i.n, l.law_key is not null as listed, k.document_key is not null as loaded, n.id as register_id, case when k.document_key is not null then 'confirmed' when l.law_key is not null then 'candidate' when n.id is not null then 'registered' else 'unknown' end as status
from i left join core_laws l on l.law_key = i.key left join k on k.document_key = i.key left join n on n.title = l.title""")
def register_assembly(spark, root):
    """Targets of references against the list of laws, the loaded documents and the register."""
    i = references(spark, root).where("target_document_key is not null").groupBy(F.col("target_document_key").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    laws = table(spark, root, "core_laws").select(F.col("law_key").alias("key"), "title", F.lit(True).alias("l"))
    loaded = units(spark, root).select(F.col("document_key").alias("key")).where("key is not null").distinct().withColumn("k", F.lit(True))
    named = table(spark, root, "register_documents").where("title is not null").groupBy("title").agg(F.min("id").alias("register_id"))
    both = i.join(laws, "key", "left").join(loaded, "key", "left").join(named, "title", "left")
    listed, here = F.col("l").isNotNull(), F.col("k").isNotNull()
    status = F.when(here, "confirmed").when(listed, "candidate").when(F.col("register_id").isNotNull(), "registered").otherwise("unknown")
    return both.select("key", "n", listed.alias("listed"), here.alias("loaded"), "register_id", status.alias("status"))


@query("""select user_id, count(*) as n, arg_max(value, (ts, event_id)) filter (where value > 50) as last_large, arg_max(event_type, (ts, event_id)) as status, arg_min(ts, (ts, event_id)) as started from events group by 1""")
def merged_events(spark, root):
    """One row a run: each field has the last value that says something."""
    at = F.struct("ts", "event_id")
    large = F.max(F.when(F.col("value") > 50, F.struct(at.alias("at"), F.col("value"))))
    return table(spark, root, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), large["value"].alias("last_large"), F.max_by("event_type", at).alias("status"), F.min("ts").alias("started"))


@query("""with e as (select item_id, family, lang, len(string_split_regex(trim(text), '\\s+')) as n from eval_cases where text is not null) select a.item_id as left_id, b.item_id as right_id, (a.n - b.n)::int as difference from e a join e b on a.family = b.family and a.lang = b.lang and a.item_id < b.item_id""")
def compared_runs(spark, root):
    """Every pair of items of one family and language, a list of fixed size, with the difference of their lengths."""
    e = table(spark, root, "eval_cases").where("text is not null").select("item_id", "family", "lang", F.size(F.split(F.trim("text"), r"\s+")).alias("n"))
    b = e.select(F.col("item_id").alias("right_id"), "family", "lang", F.col("n").alias("m"))
    return e.join(b, ["family", "lang"]).where("item_id < right_id").select(F.col("item_id").alias("left_id"), "right_id", (F.col("n") - F.col("m")).alias("difference"))


@query(f"""with d as (select distinct id, title from register_documents where id is not null), a as (select distinct document_id from aliases where {_KEY.format('alias')} like '%wasser%')
select id, title, contains(lower(coalesce(title, '')), 'wasser') as by_title, a.document_id is not null as by_alias from d left join a on a.document_id = d.id where contains(lower(coalesce(title, '')), 'wasser') or a.document_id is not null""")
def title_or_alias(spark, root):
    """Register entries whose title has a word, or one of whose names has it."""
    d = table(spark, root, "register_documents").where("id is not null").select("id", "title").distinct()
    named = table(spark, root, "aliases").where(N.key(F.col("alias")).contains("wasser")).select(F.col("document_id").alias("id")).distinct().withColumn("_a", F.lit(True))
    both = d.join(named, "id", "left").select("id", "title", F.lower(F.coalesce("title", F.lit(""))).contains("wasser").alias("by_title"), F.col("_a").isNotNull().alias("by_alias"))
    return both.where("by_title or by_alias")


@query(f"with {U}, {R} select u.document_id, count(*) as n_units from u where u.record_state = 'active' and exists (select 1 from r where r.source_document_id = u.document_id and r.resolution_status = 'resolved') group by 1")
def citing_documents(spark, root):
    """Active units of documents from which a reference was resolved."""
    cited = references(spark, root).where("resolution_status = 'resolved'").select(F.col("source_document_id").alias("document_id")).distinct()
    return units(spark, root).where("record_state = 'active'").join(cited, "document_id", "left_semi").groupBy("document_id").agg(F.count(F.lit(1)).alias("n_units"))


@query("select distinct id, corpus_status, source_kind from register_documents where corpus_status in ('indexed', 'candidate') and source_kind = 'collection' and landing_url is not null")
def loadable_entries(spark, root):
    """The entries whose status and kind allow them to be loaded."""
    d = table(spark, root, "register_documents")
    return d.where(F.col("corpus_status").isin("indexed", "candidate") & (F.col("source_kind") == "collection") & F.col("landing_url").isNotNull()).select("id", "corpus_status", "source_kind").distinct()


# ---- runs ----


@query("""with r as (select user_id, count(*) as n, count(*) filter (where event_type = 'error') as n_errors, count(*) filter (where event_type = 'view') as n_views, count(*) filter (where event_type = 'purchase') as n_writes, max(value) as top from events group by 1)
select user_id, n, case when n_writes > 0 and n_views = 0 then 'write_without_search' when n_errors * 2 > n then 'mostly_errors' else 'compliant' end as policy, array_to_string(list_filter([case when n_errors > 0 then 'errors' end, case when n_views = 0 then 'no_search' end, case when top > 400 then 'large_value' end], lambda x: x is not null), ',') as warnings from r""")
def run_diagnosis(spark, root):
    """Whether each run kept to the policy, and what there is to warn of."""
    n = lambda kind: F.count_if(F.col("event_type") == kind)
    r = table(spark, root, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), n("error").alias("e"), n("view").alias("v"), n("purchase").alias("w"), F.max("value").alias("top"))
    policy = F.when((F.col("w") > 0) & (F.col("v") == 0), "write_without_search").when(F.col("e") * 2 > F.col("n"), "mostly_errors").otherwise("compliant")
    warnings = F.array_compact(F.array(F.when(F.col("e") > 0, "errors"), F.when(F.col("v") == 0, "no_search"), F.when(F.col("top") > 400, "large_value")))
    return r.select("user_id", "n", policy.alias("policy"), F.array_join(warnings, ",").alias("warnings"))


@query("""with f as (select item_id, unnest(list_filter([case when case_id is null or trim(case_id) = '' then 'case_id_missing' end, case when text is null or trim(text) = '' then 'text_missing' end, case when lang not in ('de', 'en', 'fr') or lang is null then 'language_unknown' end, case when count(*) over (partition by case_id) > 1 then 'case_id_repeated' end, case when length(text) < 300 then 'text_short' end, case when length(text) > 450 then 'text_long' end], lambda x: x is not null)) as code from eval_cases)
select code, count(*) as occurrences, min(item_id) as first_item from f group by code""")
def case_file_findings(spark, root):
    """What is wrong with a file of evaluation cases."""
    e = table(spark, root, "eval_cases")
    blank = lambda c: F.col(c).isNull() | (F.trim(c) == "")
    e = e.withColumn("_same", F.count(F.lit(1)).over(Window.partitionBy("case_id")))
    codes = F.array_compact(F.array(F.when(blank("case_id"), "case_id_missing"), F.when(blank("text"), "text_missing"), F.when(F.col("lang").isNull() | ~F.col("lang").isin("de", "en", "fr"), "language_unknown"), F.when(F.col("_same") > 1, "case_id_repeated"), F.when(F.char_length("text") < 300, "text_short"), F.when(F.char_length("text") > 450, "text_long")))
    return e.select("item_id", F.explode(codes).alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("occurrences"), F.min("item_id").alias("first_item"))


# ---- references ----


def _targets(spark, root):
    c = chunks(spark, root).where("unit_id is not null").groupBy("unit_id").agg(F.min("chunk_id").alias("chunk_id"))
    u = units(spark, root).where("global_key is not null").join(c, "unit_id", "left")
    return u.groupBy(F.col("global_key").alias("key")).agg(F.min("chunk_id").alias("chunk_id"), F.min("unit_id").alias("unit_id"), F.min("document_id").alias("document_id"), F.min("document_key").alias("document_key"))


@query(f"""with {R}, {U}, {C}, f as (select unit_id, min(chunk_id) as chunk_id from c where unit_id is not null group by 1), t as (select global_key as key, min(f.chunk_id) as tc, min(u.unit_id) as tu, min(u.document_id) as td, min(u.document_key) as dk from u left join f using (unit_id) where global_key is not null group by 1),
k as (select dk, min(td) as kd from t group by 1), x as (select r.source_chunk_id as sc, r.source_unit_id as su, r.source_document_id as sd, r.target_document_key as tk, lower(trim(r.requested_target_global_key)) as q, t.*, k.kd from r left join t on t.key = lower(trim(r.target_global_key)) left join k on k.dk = r.target_document_key)
select distinct * from (select 'chunk' as level, sc as start_node_id, coalesce(tc, 'target:' || q) as end_node_id, case when tc is not null then 'chunk' else 'placeholder' end as end_kind from x union all select 'unit', su, coalesce(tu, 'target:' || q), case when tu is not null then 'unit' else 'placeholder' end from x
union all select 'document', sd, coalesce(td, kd, 'target:' || tk), case when coalesce(td, kd) is not null then 'document' else 'placeholder' end from x) where start_node_id is not null and end_node_id is not null and start_node_id <> end_node_id""")
def reference_edges(spark, root):
    """Edges of chunks, units and documents of all references, placeholders where a target is not there."""
    r = references(spark, root)
    clean = lambda c: F.lower(F.trim(c))
    refs = r.select(F.col("reference_id").alias("source_id"), "target_document_key", clean("requested_target_global_key").alias("requested_key"), clean("target_global_key").alias("resolved_key"))
    # the source of an edge is the reference's chunk, so references of one chunk give one edge
    sources = r.select(F.col("reference_id").alias("source_id"), "source_chunk_id", F.col("source_unit_id").alias("unit_id"), F.col("source_document_id").alias("document_id"))
    every = crossrefs.edges(refs, sources, _targets(spark, root))
    chunk = sources.select(F.col("source_id").alias("start_node_id"), "source_chunk_id")
    of_chunks = every.where("level = 'chunk'").join(chunk, "start_node_id").select("level", F.col("source_chunk_id").alias("start_node_id"), "end_node_id", "end_kind").where("start_node_id is not null and start_node_id <> end_node_id").distinct()
    return every.where("level <> 'chunk'").unionByName(of_chunks)


@query()
def cited_targets(spark, root):
    """What every citation of every chunk means: a parser's work and joins, tested on inline rows."""
    u = units(spark, root).where("global_key is not null").select("unit_id", F.col("global_key").alias("unit_key"), "document_key")
    texts = chunks(spark, root, "text").where("text is not null").join(u, "unit_id").select(F.col("chunk_id").alias("source_id"), "document_key", "unit_key", F.lit(None).cast("string").alias("context_key"), "text")
    laws = table(spark, root, "core_laws").select(F.col("law_key").alias("document_key"), "title", "short_title", "abbreviation")
    return crossrefs.references(texts, crossrefs.alias_index(laws, ["title", "short_title", "abbreviation"]), u.select(F.col("unit_key").alias("key")))


@query(f"""with {U}, {C}, d as (select distinct document_id from u where document_id is not null), e as (
select 'HAS_UNIT' as type, document_id as a, unit_id as b from u where document_id is not null and (parent_unit_id is null or trim(parent_unit_id) = '' or parent_unit_id not in (select unit_id from u)) union all
select 'HAS_SUBUNIT', parent_unit_id, unit_id from u where parent_unit_id in (select unit_id from u) union all
select 'HAS_CHUNK', unit_id, chunk_id from c where unit_id in (select unit_id from u) and (parent_chunk_id is null or trim(parent_chunk_id) = '') union all
select 'HAS_PART', parent_chunk_id, chunk_id from c where parent_chunk_id in (select chunk_id from c))
select 'rel_' || substr(sha256(type || '|' || a || '|' || b || '|'), 1, 16) as edge_id, type, a as start_node_id, b as end_node_id from (select distinct * from e)""")
def content_graph(spark, root):
    """The content graph's edges: a document's upper units, their units, their chunks and the parts of those."""
    u, c = units(spark, root), chunks(spark, root)
    ids = u.select(F.col("unit_id").alias("parent_unit_id")).distinct()
    blank = lambda x: F.col(x).isNull() | (F.trim(x) == "")
    top = u.where("document_id is not null").join(ids, "parent_unit_id", "left_anti")
    below = u.join(ids, "parent_unit_id", "left_semi")
    held = c.join(ids.withColumnRenamed("parent_unit_id", "unit_id"), "unit_id", "left_semi").where(blank("parent_chunk_id"))
    parts = c.join(c.select(F.col("chunk_id").alias("parent_chunk_id")).distinct(), "parent_chunk_id", "left_semi")
    kinds = (("HAS_UNIT", top, "document_id", "unit_id"), ("HAS_SUBUNIT", below, "parent_unit_id", "unit_id"), ("HAS_CHUNK", held, "unit_id", "chunk_id"), ("HAS_PART", parts, "parent_chunk_id", "chunk_id"))
    out = [graph.edges(rows, kind, a, b) for kind, rows, a, b in kinds]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query(f"""with {C}, p as (select chunk_id as passage_id, sha256(text) as input_hash, strlen(text) as n from c where text is not null), v as (select distinct passage_id from passage_vectors where vector is not null)
select p.passage_id, p.input_hash, case when v.passage_id is not null then 0 else round((n + 64) * 3 * 0.04 / 1e6, 12) end as cost, case when v.passage_id is not null then 'unchanged' else 'planned' end as state from p left join v using (passage_id)""")
def vector_plan(spark, root):
    """What there is to embed: passages with a vector are taken as unchanged, the others are planned within the budget."""
    p = chunks(spark, root, "text").where("text is not null").select(F.col("chunk_id").alias("passage_id"), F.sha2("text", 256).alias("input_hash"), "text")
    v = table(spark, root, "passage_vectors").where("vector is not null").select("passage_id").distinct()
    plan = vectors.build_plan(p, p.join(v, "passage_id", "left_semi"), 0.04, 1000.0)
    return plan.select("passage_id", "input_hash", F.round("cost", 12).alias("cost"), "state")


@query("""with s as (select user_id, event_type, avg(value) as m from events group by 1, 2), p as (select user_id, max(m) filter (where event_type = 'view') as l, max(m) filter (where event_type = 'purchase') as r, count(*) as n_kinds, avg(m) as macro from s group by 1)
select n_kinds, count(*) as n, round(avg(macro), 6) as mean, count(*) filter (where l - r > 5) as wins, count(*) filter (where abs(l - r) <= 5) as ties, count(*) filter (where r - l > 5) as losses from p group by 1""")
def macro_means(spark, root):
    """Unweighted means of means, and wins, ties and losses with a threshold."""
    s = table(spark, root, "events").groupBy("user_id", "event_type").agg(F.avg("value").alias("m"))
    of = lambda kind: F.max(F.when(F.col("event_type") == kind, F.col("m")))
    p = s.groupBy("user_id").agg(of("view").alias("l"), of("purchase").alias("r"), F.count(F.lit(1)).alias("n_kinds"), F.avg("m").alias("macro"))
    d = F.col("l") - F.col("r")
    return p.groupBy("n_kinds").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("macro"), 6).alias("mean"), F.count_if(d > 5).alias("wins"), F.count_if(F.abs(d) <= 5).alias("ties"), F.count_if(d < -5).alias("losses"))


@query("select distinct id, short_title, document_type, priority, nullif(trim(coalesce(landing_url, '')), '') as landing_url, array_to_string(list_filter([case when trim(coalesce(short_title, '')) <> '' then 'short_title' end, case when trim(coalesce(document_type, '')) <> '' then 'document_type' end, case when trim(coalesce(landing_url, '')) <> '' then 'landing_url' end, case when trim(coalesce(publication_date, '')) <> '' then 'publication_date' end], lambda x: x is not null), ',') as fields from register_documents")
def full_projection(spark, root):
    """The fields of a full answer, and which of the optional ones an entry has."""
    d = table(spark, root, "register_documents")
    there = F.array_compact(F.array(*[F.when(F.trim(F.coalesce(c, F.lit(""))) != "", F.lit(c)) for c in ("short_title", "document_type", "landing_url", "publication_date")]))
    return d.select("id", "short_title", "document_type", "priority", F.when(F.trim(F.coalesce("landing_url", F.lit(""))) != "", F.trim("landing_url")).alias("landing_url"), F.array_join(there, ",").alias("fields")).distinct()


@query(f"""with k as (select law_key as id, title, case when jurisdiction = 'EU' then 'eurlex' else 'gii' end as kind from core_laws), r as (select id, max(struct_pack(t := registered_at, title := title, kind := source_kind, s := corpus_status, v := valid_from)) as m from register_documents where id is not null group by 1)
select id, r.m.title as title, r.m.kind as source_kind, case when r.m.kind = 'collection' then r.m.v end as valid_from, case when lower(trim(coalesce(r.m.s, ''))) = 'removed' then 'not_in_force' else 'unknown' end as legal_status from r""")
def result_rows(spark, root):
    """Rows of a result: internal fields dropped, some only for entries of a collection, the standing added."""
    r = table(spark, root, "register_documents").where("id is not null").groupBy("id").agg(F.max(F.struct(F.col("registered_at").alias("t"), "title", F.col("source_kind").alias("kind"), F.col("corpus_status").alias("s"), F.col("valid_from").alias("v"))).alias("m"))
    status = F.when(F.lower(F.trim(F.coalesce("m.s", F.lit("")))) == "removed", "not_in_force").otherwise("unknown")
    return r.select("id", "m.title", F.col("m.kind").alias("source_kind"), F.when(F.col("m.kind") == "collection", F.col("m.v")).alias("valid_from"), status.alias("legal_status"))
