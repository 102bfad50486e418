"""More queries of the reference's operators: projections, cascades, scopes, inventories, audits and alignment."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..operators import align, payloads, quality
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


@query("""select distinct id, case when lower(trim(coalesce(corpus_status, ''))) in ('repealed', 'aufgehoben', 'außer kraft', 'not_in_force', 'expired', 'withdrawn', 'removed') then 'not_in_force' else 'unknown' end as legal_status,
concat_ws(',', case when lower(trim(coalesce(corpus_status, ''))) in ('repealed', 'aufgehoben', 'außer kraft', 'not_in_force', 'expired', 'withdrawn', 'removed') then 'not_in_force' end, case when trim(coalesce(valid_from, '')) = '' then 'no_start_of_validity' end, case when trim(coalesce(publication_date, '')) = '' then 'no_date_of_publication' end, case when source_kind is null then 'source_unknown' end) as cautions from register_documents""")
def evidence_projection(spark, root):
    d = table(spark, root, "register_documents")
    e = payloads.evidence(F.col("corpus_status"), F.col("valid_from"), F.col("publication_date"), F.col("source_kind"))
    return d.select("id", e.alias("e")).select("id", "e.legal_status", "e.cautions").distinct()


@query(f"with {U}, x as (select unit_id, trim(legal_citation) as r, trim(title) as t, trim(regexp_replace(replace(lower(title), 'ß', 'ss'), '\\s+', ' ', 'g')) as tk, trim(regexp_replace(replace(lower(legal_citation), 'ß', 'ss'), '\\s+', ' ', 'g')) as rk from u) select unit_id, concat_ws(' – ', nullif(r, ''), case when t <> '' and tk <> rk then t end) as address from x")
def compact_address(spark, root):
    return units(spark, root).select("unit_id", payloads.address(F.col("legal_citation"), F.col("title")).alias("address"))


@query(f"""with {R}, k as (select distinct target_document_key as key from r where target_document_key is not null)
select case when regexp_matches(key, '^(bverfg|bgh|eugh|bverwg|c_\\d+_\\d+|ecli)') then 'case_law' when regexp_matches(key, '^celex_') then 'celex' when regexp_matches(key, '^(gesetz|verordnung|richtlinie|anlage|vertrag)$') then 'generic' when regexp_matches(key, '(vertrag|abkommen|uebereinkommen|konvention)') then 'treaty' when regexp_matches(key, '(g|gesetz|gb|ordnung|v|verordnung)$') then 'german_act' else 'unclassified' end as family, count(*) as n_keys from k group by 1""")
def target_families(spark, root):
    keys = table(spark, root, "refers_to_edges").select(F.col("target_document_key").alias("key")).where("key is not null").distinct()
    return keys.groupBy(payloads.family(F.col("key")).alias("family")).agg(F.count(F.lit(1)).alias("n_keys"))


@query(f"""with q as (select distinct alias, {_KEY.format('alias')} as k from aliases where {_KEY.format('alias')} <> ''), l as (select law_key, {_KEY.format('title')} as t, {_KEY.format('short_title')} as s, {_KEY.format('abbreviation')} as a from core_laws),
x as (select q.alias, q.k, l.law_key as target, 'abbreviation' as step, 0 as step_no from q join l on l.a = q.k union all select q.alias, q.k, l.law_key, 'short_title', 1 from q join l on l.s = q.k union all select q.alias, q.k, l.law_key, 'title', 2 from q join l on l.t = q.k)
select q.k, x.target, coalesce(x.step, 'none') as step, coalesce(x.step_no, 3) as step_no from (select distinct k from q) q left join (select distinct k, target, step, step_no, min(step_no) over (partition by k) as best from x) x on x.k = q.k and x.step_no = x.best""")
def find_documents_cascade(spark, root):
    asked = table(spark, root, "aliases").select(N.key(F.col("alias")).alias("k")).where("k <> ''")
    laws = table(spark, root, "core_laws")
    step = lambda c: (c, laws.select(N.key(F.col(c)).alias("k"), F.col("law_key").alias("target")))
    return payloads.cascade(asked, ["k"], step("abbreviation"), step("short_title"), step("title"))


_RANK = "case unit_type when 'document_body' then 0 when 'division' then 1 when 'annex' then 1 when 'article' then 2 when 'paragraph' then 3 else 4 end"


@query(f"""with {U}, p as (select unit_id, document_id, {_RANK} as rk, row_number() over (partition by document_id order by sequence nulls first, unit_id) as p from u)
select a.unit_id, b.unit_id as heading_id from p a left join p b on b.document_id = a.document_id and b.p = (select max(c.p) from p c where c.document_id = a.document_id and c.p < a.p and c.rk < a.rk)""")
def rank_stack(spark, root):
    u = units(spark, root).select("unit_id", "document_id", "sequence", F.expr(_RANK).alias("rk"))
    out = payloads.rank_stack(u, ["document_id"], ["sequence", "unit_id"], F.col("rk"), 4)
    return out.select("unit_id", F.col("parent.unit_id").alias("heading_id"))


@query("""with m as (select user_id, ts as a, lead(ts) over (partition by user_id order by ts, event_id) as b, event_id as scope from events where event_type = 'signup')
select e.event_id, arg_max(m.scope, (m.a, m.scope)) as scope from events e left join m on m.user_id = e.user_id and m.a <= e.ts where e.event_type = 'view' group by e.event_id""")
def interval_scope(spark, root):
    e = table(spark, root, "events").where("user_id is not null")
    rows = e.where("event_type = 'view'").select("event_id", "user_id", "ts")
    marks = e.where("event_type = 'signup'").select("user_id", F.col("ts").alias("m_ts"), F.col("event_id").alias("mark"))
    return payloads.in_scope(rows, marks, ["user_id"], "ts", "m_ts", "mark").select("event_id", "scope")


@query(f"""with {C}, p as (select document_id, chunk_id, length(text) as n, coalesce(sum(length(text)) over (partition by document_id order by sequence nulls first, chunk_id rows between unbounded preceding and 1 preceding), 0) as a from c where document_id is not null and text is not null),
t as (select document_id, sum(n) as n from p group by 1), o as (select document_id, unnest(range(0, n::bigint, 1000)) as o from t)
select o.document_id, o.o as place, arg_max(p.chunk_id, (p.a, p.chunk_id)) as chunk_id from o join p on p.document_id = o.document_id and p.a <= o.o and p.n > 0 group by 1, 2""")
def offset_to_chunk(spark, root):
    """Which chunk holds every thousandth character of a document: offsets matched as-of to the chunks' starts."""
    rows = chunks(spark, root, "text").where("document_id is not null and text is not null and text <> ''").select("document_id", "chunk_id", "sequence", F.char_length("text").alias("n"))
    by = Window.partitionBy("document_id").orderBy("sequence", "chunk_id")
    starts = rows.withColumn("a", F.coalesce(F.sum("n").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    total = starts.groupBy("document_id").agg(F.sum("n").alias("n"))
    places = total.select("document_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(1000).cast("bigint"))).alias("place"))
    return payloads.in_scope(places, starts.select("document_id", "a", "chunk_id"), ["document_id"], "place", "a", "chunk_id").select("document_id", "place", F.col("scope").alias("chunk_id"))


@query(f"""with {R} select regexp_extract(mention_text, '^(§|Art\\.|Artikel|Anlage|Anhang|Nr\\.|Abs\\.)', 1) as family, count(*) as n_mentions, count(distinct source_document_id) as n_documents from r where mention_text is not null group by 1""")
def mention_families(spark, root):
    kind = F.regexp_extract("mention_text", r"^(§|Art\.|Artikel|Anlage|Anhang|Nr\.|Abs\.)", 1)
    return references(spark, root).where("mention_text is not null").groupBy(kind.alias("family")).agg(F.count(F.lit(1)).alias("n_mentions"), F.countDistinct("source_document_id").alias("n_documents"))


@query("""select 'title' as column_name, count(*) - count(nullif(trim(title), '')) as n_empty, count(*) as n from structural_units union all select 'label', count(*) - count(nullif(trim(label), '')), count(*) from structural_units
union all select 'number', count(*) - count(nullif(trim(number), '')), count(*) from structural_units union all select 'legal_citation', count(*) - count(nullif(trim(legal_citation), '')), count(*) from structural_units""")
def empty_columns(spark, root):
    cols = ["title", "label", "number", "legal_citation"]
    one = table(spark, root, "structural_units").agg(F.count(F.lit(1)).alias("n"), *[(F.count(F.lit(1)) - F.count(F.when(F.trim(c) != "", F.lit(1)))).alias(c) for c in cols])
    return one.select("n", F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_empty")) for c in cols])).alias("x")).select("x.column_name", "x.n_empty", "n")


@query(f"""with {R}, g as (select distinct source_chunk_id as case_id, lower(trim(target_global_key)) as item_id from r where resolution_status = 'resolved' and trim(target_global_key) <> '' and source_chunk_id is not null),
m as (select resolution_method as mode, source_chunk_id as case_id, lower(trim(requested_target_global_key)) as item_id, min(char_start) as pos from r where trim(requested_target_global_key) <> '' and resolution_method is not null group by all),
k as (select *, row_number() over (partition by mode, case_id order by pos nulls first, item_id) as rank from m), f as (select k.mode, k.case_id, min(k.rank) as first_rank from k join g on g.case_id = k.case_id and g.item_id = k.item_id group by all)
select mode, count(*) as n_hits, count(*) filter (where first_rank <= 5) as n_hits_at_5, round(avg(first_rank), 6) as mean_first_rank from f group by mode""")
def hit_at_5_by_mode(spark, root):
    r = references(spark, root)
    gold = r.where("resolution_status = 'resolved' and source_chunk_id is not null").select(F.col("source_chunk_id").alias("case_id"), F.lower(F.trim("target_global_key")).alias("item_id")).where("item_id <> ''").distinct()
    m = r.where("resolution_method is not null").select(F.col("resolution_method").alias("mode"), F.col("source_chunk_id").alias("case_id"), F.lower(F.trim("requested_target_global_key")).alias("item_id"), "char_start").where("item_id <> ''")
    m = m.groupBy("mode", "case_id", "item_id").agg(F.min("char_start").alias("pos"))
    ranked = m.withColumn("rank", F.row_number().over(Window.partitionBy("mode", "case_id").orderBy("pos", "item_id")))
    first = ranked.join(gold, ["case_id", "item_id"]).groupBy("mode", "case_id").agg(F.min("rank").alias("first_rank"))
    return first.groupBy("mode").agg(F.count(F.lit(1)).alias("n_hits"), F.count_if(F.col("first_rank") <= 5).alias("n_hits_at_5"), F.round(F.avg("first_rank"), 6).alias("mean_first_rank"))


@query("select family, lang, count(*) as n, round(avg(length(text)), 6) as mean_length from eval_cases group by 1, 2")
def panel_means(spark, root):
    return table(spark, root, "eval_cases").groupBy("family", "lang").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.char_length("text")), 6).alias("mean_length"))


@query("with f as (select family, avg(length(text)) as m, count(*) filter (where reference_status = 'reviewed') as r from eval_cases group by 1) select count(*) as n_families, round(avg(m), 6) as macro_mean, sum(r)::bigint as n_reviewed from f")
def macro_mean(spark, root):
    f = table(spark, root, "eval_cases").groupBy("family").agg(F.avg(F.char_length("text")).alias("m"), F.count_if(F.col("reference_status") == "reviewed").alias("r"))
    return f.agg(F.count(F.lit(1)).alias("n_families"), F.round(F.avg("m"), 6).alias("macro_mean"), F.sum("r").alias("n_reviewed"))


@query(f"with {C} select document_id, count(*) as n_chunks, case when count(*) = count(page_end) then sum(page_end - page_start + 1)::bigint end as n_pages from c where document_id is not null group by 1")
def null_if_any_sum(spark, root):
    total = F.sum(F.col("page_end") - F.col("page_start") + 1)
    return chunks(spark, root).where("document_id is not null").groupBy("document_id").agg(F.count(F.lit(1)).alias("n_chunks"), quality.null_if_any(total, F.col("page_end")).alias("n_pages"))


@query("select document_key, arg_min(source_format, (case source_format when 'xml' then 0 when 'html' then 1 when 'pdf' then 2 else 3 end, doc_id)) as best_format, arg_min(doc_id, (case source_format when 'xml' then 0 when 'html' then 1 when 'pdf' then 2 else 3 end, doc_id)) as doc_id, count(distinct source_format) = 1 as single_format from documents where document_key is not null and source_format is not null group by 1")
def best_format(spark, root):
    rank = F.when(F.col("source_format") == "xml", 0).when(F.col("source_format") == "html", 1).when(F.col("source_format") == "pdf", 2).otherwise(3)
    best = F.min(F.struct(rank.alias("r"), "doc_id", "source_format"))
    d = table(spark, root, "documents").where("document_key is not null and source_format is not null")
    return d.groupBy("document_key").agg(best.alias("b"), (F.countDistinct("source_format") == 1).alias("single_format")).select("document_key", F.col("b.source_format").alias("best_format"), F.col("b.doc_id").alias("doc_id"), "single_format")


@query("select user_id, count(*) as n_calls, count(*) filter (where event_type = 'error') as n_errors, round(sum(value), 6) as total, round(count(*) filter (where event_type = 'error') / count(*), 6) as error_ratio, arg_max(event_type, (ts, event_id)) as last_type from events group by 1")
def run_metrics(spark, root):
    errors = F.count_if(F.col("event_type") == "error")
    return table(spark, root, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_calls"), errors.alias("n_errors"), F.round(F.sum("value"), 6).alias("total"), F.round(errors / F.count(F.lit(1)), 6).alias("error_ratio"), F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type")
    )


@query("""with w as (select *, lag(ts) over (partition by user_id order by ts, event_id) as before, lead(event_type) over (partition by user_id order by ts, event_id) as next_type from events)
select user_id, event_id, round(epoch(ts) - epoch(before), 3) as gap, next_type from w where event_type = 'purchase'""")
def neighbour_events(spark, root):
    by = Window.partitionBy("user_id").orderBy("ts", "event_id")
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000
    e = table(spark, root, "events").select("user_id", "event_id", "event_type", F.round(seconds - F.lag(seconds).over(by), 3).alias("gap"), F.lead("event_type").over(by).alias("next_type"))
    return e.where("event_type = 'purchase'").select("user_id", "event_id", "gap", "next_type")


@query(f"""with a as (select source_document_id as d, list_sort(list_distinct(list(target_document_key)))::varchar as s from refers_to_edges where resolution_status = 'resolved' and source_document_id is not null and target_document_key is not null group by 1),
b as (select source_document_id as d, list_sort(list_distinct(list(target_document_key)))::varchar as s from refers_to_edges where resolution_status = 'nearest' and source_document_id is not null and target_document_key is not null group by 1)
select coalesce(a.d, b.d) as document_id, case when a.d is null then 'added' when b.d is null then 'missing' else 'changed' end as change from a full join b on a.d = b.d where a.s is distinct from b.s""")
def changed_target_sets(spark, root):
    """Documents whose sets of targets differ between two states, by a fingerprint of the set, not the set itself."""
    r = table(spark, root, "refers_to_edges").where("source_document_id is not null and target_document_key is not null")

    def state(s: str, name: str):
        pairs = r.where(F.col("resolution_status") == s).select(F.col("source_document_id").alias("document_id"), "target_document_key").distinct()
        return pairs.groupBy("document_id").agg(F.count(F.lit(1)).alias(f"{name}n"), F.sum(F.xxhash64("target_document_key").cast("decimal(38,0)")).alias(f"{name}h"))

    both = state("resolved", "a").join(state("nearest", "b"), "document_id", "full")
    change = F.when(F.col("an").isNull(), "added").when(F.col("bn").isNull(), "missing").when((F.col("an") != F.col("bn")) | (F.col("ah") != F.col("bh")), "changed")
    return both.select("document_id", change.alias("change")).where("change is not null")


@query("select doc_id, substr(sha256(doc_id::varchar), 1, 16) as blind_key from documents order by sha256(doc_id::varchar)")
def blind_order(spark, root):
    """The place of every document in an order that tells nothing."""
    h = F.sha2(F.col("doc_id").cast("string"), 256)
    return table(spark, root, "documents").select("doc_id", h.alias("h")).orderBy("h").select("doc_id", F.substring("h", 1, 16).alias("blind_key"))


@query("""with x as (select distinct id, title from register_documents where title is not null) select id, title from x order by lower(title), id limit 100""")
def title_order(spark, root):
    return table(spark, root, "register_documents").where("title is not null").select("id", "title").distinct().orderBy(F.lower("title"), "id").limit(100)


@query(f"with {U}, {C} select unit_type, count(*) as n_units, count(c.unit_id) as n_with_chunks, round(avg(coalesce(c.n, 0)), 6) as chunks_per_unit from u left join (select unit_id, count(*) as n from c where unit_id is not null group by 1) c on c.unit_id = u.unit_id group by 1")
def density_by_type(spark, root):
    n = chunks(spark, root).where("unit_id is not null").groupBy("unit_id").agg(F.count(F.lit(1)).alias("n"))
    return units(spark, root).select("unit_id", "unit_type").join(n, "unit_id", "left").groupBy("unit_type").agg(F.count(F.lit(1)).alias("n_units"), F.count("n").alias("n_with_chunks"), F.round(F.avg(F.coalesce("n", F.lit(0))), 6).alias("chunks_per_unit"))


@query("""select source_format, lang, count(*) as n, grouping(source_format)::int as all_formats, grouping(lang)::int as all_langs from documents where source_format is not null and lang is not null group by grouping sets ((source_format, lang), (source_format), ())""")
def corpus_totals(spark, root):
    d = table(spark, root, "documents").where("source_format is not null and lang is not null")
    return d.rollup("source_format", "lang").agg(F.count(F.lit(1)).alias("n"), F.grouping("source_format").cast("int").alias("all_formats"), F.grouping("lang").cast("int").alias("all_langs"))


@query()
def unit_page_alignment(spark, root):
    """Units, known by the beginning of their first text, aligned with their document's pages in order; tested on inline rows."""
    first = chunks(spark, root, "text").where("text is not null and unit_id is not null").groupBy("unit_id").agg(F.min(F.struct("sequence", "chunk_id", "text"))["text"].alias("body"))
    u = units(spark, root).join(first, "unit_id").select("document_id", F.col("unit_id").alias("item_id"), F.struct("sequence", "unit_id").alias("place"), F.col("body").alias("text"), "label", "title")
    c = chunks(spark, root, "text").where("text is not null and document_id is not null and page_start is not null")
    pages = c.groupBy("document_id", F.col("page_start").alias("page")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sequence", "chunk_id", "text"))), lambda x: x["text"]), "\n").alias("text"))
    return align.align(u, pages)


@query("select round(percentile_cont, 3) as median_length, n from (select median(length(text)) as percentile_cont, count(text) as n from documents)")
def length_median(spark, root):
    return table(spark, root, "documents").agg(F.round(F.median(F.char_length("text")), 3).alias("median_length"), F.count("text").alias("n"))


