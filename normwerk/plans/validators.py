"""Queries of the validators: each kind of record in one pass over its rows, each code a condition."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality
from ..session import table
from .reference import C, R, U, chunks, references, units

QUERIES = {}
SQL = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _found(rules: dict[str, str], rows: str, key: str) -> str:
    """SQL of ``quality.audit``: rules are conditions over ``rows``."""
    codes = ", ".join(f"case when {c} then '{k}' end" for k, c in rules.items())
    return f"""x as (select {key} as example, unnest(list_filter([{codes}], lambda x: x is not null)) as code from {rows}), n as (select code, example, count(*) as n from x group by 1, 2), k as (select *, row_number() over (partition by code order by example nulls last) as rk from n)
select code, sum(n)::bigint as occurrences, coalesce(string_agg(case when rk <= 3 then example end, ', ' order by example), '') as examples from k group by code"""


_BLANK = "({0} is null or trim({0}) = '')"
_UNIT_RULES = {
    "unit_document_missing": _BLANK.format("document_id"), "unit_document_key_missing": _BLANK.format("document_key"), "unit_global_key_missing": _BLANK.format("global_key"), "unit_type_missing": _BLANK.format("unit_type"),
    "unit_label_missing": "(label is null or trim(label) = '') and unit_type <> 'document_body'", "unit_title_missing": "(title is null or trim(title) = '') and unit_type in ('division', 'table')", "unit_citation_missing": _BLANK.format("legal_citation"),
    "unit_sequence_missing": "sequence is null", "unit_own_parent": "parent_unit_id = unit_id", "unit_parent_missing": "trim(parent_unit_id) <> '' and p_id is null", "unit_parent_elsewhere": "p_doc <> document_id", "unit_key_not_below_document": "not starts_with(global_key, document_key)",
    "unit_key_not_normal": "global_key <> lower(trim(global_key))", "unit_key_repeated": "n_key > 1", "unit_sequence_repeated": "n_seq > 1 and sequence is not null", "unit_repealed_with_rows": "is_repealed and rows_json is not null", "unit_state_unknown": "record_state is null or record_state not in ('active', 'withdrawn')",
    "table_rows_missing": "unit_type = 'table' and rows_json is null", "table_row_count_wrong": "unit_type = 'table' and rows_json is not null and (row_count is null or row_count <> n_rows)", "table_rows_elsewhere": "unit_type <> 'table' and rows_json is not null",
    "unit_breadcrumbs_empty": "n_crumbs is null or n_crumbs = 0", "unit_confidence_low": "confidence < 0.4", "unit_confidence_missing": "confidence is null", "unit_number_not_in_label": "number is not null and not contains(label, number)",
}
_UL = "ul as (select unit_id, m.* from (select unit_id, max(struct_pack(loaded_at := loaded_at, n_crumbs := len(breadcrumbs), confidence := confidence)) as m from structural_units group by unit_id))"
_UNIT_ROWS = f"""with {U}, {_UL}, y as (select u.*, ul.n_crumbs, ul.confidence, p.unit_id as p_id, p.document_id as p_doc, json_array_length(u.rows_json::json) as n_rows, case when u.global_key is not null then count(*) over (partition by u.global_key) end as n_key,
count(*) over (partition by u.document_id, coalesce(u.parent_unit_id, ''), u.sequence) as n_seq from u left join u p on p.unit_id = u.parent_unit_id left join ul on ul.unit_id = u.unit_id)"""


def _blank(c: str):
    return F.col(c).isNull() | (F.trim(c) == "")


def _unit_findings(spark, root):
    u = units(spark, root)
    extra = table(spark, root, "structural_units").groupBy("unit_id").agg(F.max(F.struct("loaded_at", F.size("breadcrumbs").alias("n_crumbs"), "confidence")).alias("x")).select("unit_id", "x.n_crumbs", "x.confidence")
    above = u.select(F.col("unit_id").alias("parent_unit_id"), F.col("document_id").alias("p_doc"), F.lit(True).alias("p_id"))
    # counts by key and by place, joined back only where they are more than one
    keys = quality.duplicates(u.where("global_key is not null"), ["global_key"]).withColumnRenamed("n", "n_key")
    place = quality.duplicates(u.where("sequence is not null and document_id is not null").withColumn("parent", F.coalesce("parent_unit_id", F.lit(""))), ["document_id", "parent", "sequence"]).withColumnRenamed("n", "n_seq")
    y = u.join(extra, "unit_id", "left").join(above, "parent_unit_id", "left").join(keys, "global_key", "left").withColumn("parent", F.coalesce("parent_unit_id", F.lit(""))).join(place, ["document_id", "parent", "sequence"], "left")
    c = F.col
    is_table, rows = c("unit_type") == "table", F.json_array_length("rows_json")
    rules = {
        "unit_document_missing": _blank("document_id"), "unit_document_key_missing": _blank("document_key"), "unit_global_key_missing": _blank("global_key"), "unit_type_missing": _blank("unit_type"),
        "unit_label_missing": _blank("label") & (c("unit_type") != "document_body"), "unit_title_missing": _blank("title") & c("unit_type").isin("division", "table"), "unit_citation_missing": _blank("legal_citation"),
        "unit_sequence_missing": c("sequence").isNull(), "unit_own_parent": c("parent_unit_id") == c("unit_id"), "unit_parent_missing": (F.trim("parent_unit_id") != "") & c("p_id").isNull(), "unit_parent_elsewhere": c("p_doc") != c("document_id"),
        "unit_key_not_below_document": ~c("global_key").startswith(c("document_key")), "unit_key_not_normal": c("global_key") != F.lower(F.trim("global_key")), "unit_key_repeated": c("n_key") > 1, "unit_sequence_repeated": c("n_seq") > 1,
        "unit_repealed_with_rows": c("is_repealed") & c("rows_json").isNotNull(), "unit_state_unknown": c("record_state").isNull() | ~c("record_state").isin("active", "withdrawn"),
        "table_rows_missing": is_table & c("rows_json").isNull(), "table_row_count_wrong": is_table & c("rows_json").isNotNull() & (c("row_count").isNull() | (c("row_count") != rows)), "table_rows_elsewhere": ~is_table & c("rows_json").isNotNull(),
        "unit_breadcrumbs_empty": c("n_crumbs").isNull() | (c("n_crumbs") <= 0), "unit_confidence_low": c("confidence") < 0.4, "unit_confidence_missing": c("confidence").isNull(), "unit_number_not_in_label": c("number").isNotNull() & ~c("label").contains(c("number")),
    }
    return quality.audit(y, rules, c("unit_id"))


@query(_UNIT_ROWS + ", " + _found(_UNIT_RULES, "y", "unit_id"))
def unit_audit(spark, root):
    return _unit_findings(spark, root)


@query(f"{_UNIT_ROWS}, " + _found(_UNIT_RULES, "y", "unit_id").replace("select code, sum(n)", ", f as (select code, sum(n)", 1).replace("), k as", "), k as", 1) + ") select count(*) as n_findings, sum(occurrences)::bigint as n_occurrences, bool_or(code in ('unit_document_missing', 'unit_own_parent', 'unit_key_repeated')) as failed from f")
def unit_audit_verdict(spark, root):
    """Whether the audit fails: it does on errors; what isn't named here as an error is a warning."""
    severities = {k: "error" if k in ("unit_document_missing", "unit_own_parent", "unit_key_repeated") else "warning" for k in _UNIT_RULES}
    return quality.verdict(_unit_findings(spark, root), severities)


_CHUNK_RULES = {
    "chunk_unit_missing": _BLANK.format("unit_id"), "chunk_unit_unknown": "trim(unit_id) <> '' and u_id is null", "chunk_document_missing": _BLANK.format("document_id"), "chunk_document_differs": "u_doc <> document_id", "chunk_type_missing": _BLANK.format("chunk_type"),
    "chunk_text_missing": "text is null", "chunk_text_blank": "trim(text) = ''", "chunk_text_oversized": "length(text) > 15000", "chunk_tokens_oversized": "token_count > 1800", "chunk_tokens_missing": "token_count is null", "chunk_tokens_implausible": "token_count > 0 and length(text) > 0 and (length(text) / token_count > 40 or length(text) < token_count)",
    "chunk_page_range_partial": "(page_start is null) <> (page_end is null)", "chunk_page_range_reversed": "page_start > page_end", "chunk_page_not_positive": "page_start < 1", "chunk_own_parent": "parent_chunk_id = chunk_id", "chunk_parent_missing": "trim(parent_chunk_id) <> '' and q_id is null", "chunk_parent_elsewhere": "q_doc <> document_id",
    "chunk_note_without_parent": "chunk_type = 'note' and (parent_chunk_id is null or trim(parent_chunk_id) = '')", "chunk_sequence_missing": "sequence is null", "chunk_source_order_empty": "n_order is null or n_order = 0", "chunk_source_order_differs": "n_order > 0 and first_order <> sequence", "chunk_citation_missing": _BLANK.format("legal_citation"),
    "chunk_table_heading_in_text": "chunk_type = 'text' and regexp_matches(text, '^\\s*Tabelle\\s+\\d')", "chunk_replacement_character": "contains(text, chr(65533))", "chunk_footnote_mark_left": "regexp_matches(text, '\\[\\d+\\]\\s*$')",
}
_CL = "cl as (select chunk_id, m.* from (select chunk_id, max(struct_pack(loaded_at := loaded_at, n_order := len(source_order), first_order := source_order[1], token_count := token_count)) as m from chunks group by chunk_id))"


@query(f"with {U}, {C}, {_CL}, y as (select c.*, cl.n_order, cl.first_order, cl.token_count, u.unit_id as u_id, u.document_id as u_doc, q.chunk_id as q_id, q.document_id as q_doc from c left join cl on cl.chunk_id = c.chunk_id left join u on u.unit_id = c.unit_id left join c q on q.chunk_id = c.parent_chunk_id), " + _found(_CHUNK_RULES, "y", "chunk_id"))
def chunk_audit(spark, root):
    rows = chunks(spark, root, "text", "legal_citation")
    extra = table(spark, root, "chunks").groupBy("chunk_id").agg(F.max(F.struct("loaded_at", F.size("source_order").alias("n_order"), F.get("source_order", F.lit(0)).alias("first_order"), "token_count")).alias("x")).select("chunk_id", "x.n_order", "x.first_order", "x.token_count")
    of = units(spark, root).select("unit_id", F.col("document_id").alias("u_doc"), F.lit(True).alias("u_id"))
    above = rows.select(F.col("chunk_id").alias("parent_chunk_id"), F.col("document_id").alias("q_doc"), F.lit(True).alias("q_id"))
    y = rows.join(extra, "chunk_id", "left").join(of, "unit_id", "left").join(above, "parent_chunk_id", "left")
    c, n = F.col, F.char_length("text")
    rules = {
        "chunk_unit_missing": _blank("unit_id"), "chunk_unit_unknown": (F.trim("unit_id") != "") & c("u_id").isNull(), "chunk_document_missing": _blank("document_id"), "chunk_document_differs": c("u_doc") != c("document_id"), "chunk_type_missing": _blank("chunk_type"),
        "chunk_text_missing": c("text").isNull(), "chunk_text_blank": F.trim("text") == "", "chunk_text_oversized": n > 15000, "chunk_tokens_oversized": c("token_count") > 1800, "chunk_tokens_missing": c("token_count").isNull(), "chunk_tokens_implausible": (c("token_count") > 0) & (n > 0) & ((n > 40 * c("token_count")) | (n < c("token_count"))),
        "chunk_page_range_partial": c("page_start").isNull() != c("page_end").isNull(), "chunk_page_range_reversed": c("page_start") > c("page_end"), "chunk_page_not_positive": c("page_start") < 1, "chunk_own_parent": c("parent_chunk_id") == c("chunk_id"), "chunk_parent_missing": (F.trim("parent_chunk_id") != "") & c("q_id").isNull(), "chunk_parent_elsewhere": c("q_doc") != c("document_id"),
        "chunk_note_without_parent": (c("chunk_type") == "note") & _blank("parent_chunk_id"), "chunk_sequence_missing": c("sequence").isNull(), "chunk_source_order_empty": c("n_order").isNull() | (c("n_order") <= 0), "chunk_source_order_differs": (c("n_order") > 0) & (c("first_order") != c("sequence")), "chunk_citation_missing": _blank("legal_citation"),
        "chunk_table_heading_in_text": (c("chunk_type") == "text") & c("text").rlike(r"^\s*Tabelle\s+\d"), "chunk_replacement_character": c("text").contains("�"), "chunk_footnote_mark_left": c("text").rlike(r"\[\d+\]\s*\z"),
    }
    return quality.audit(y, rules, c("chunk_id"))


_REF_RULES = {
    "reference_source_missing": _BLANK.format("source_chunk_id"), "reference_target_missing": _BLANK.format("target_global_key"), "reference_mention_missing": _BLANK.format("mention_text"), "reference_span_missing": "char_start is null or char_end is null", "reference_span_reversed": "char_start >= char_end", "reference_span_differs": "char_end - char_start <> length(mention_text)",
    "reference_status_missing": "resolution_status is null", "reference_status_unknown": "resolution_status not in ('resolved', 'nearest', 'unresolved')", "reference_method_without_status": "resolution_method is not null and resolution_status = 'unresolved'", "reference_key_not_normal": "target_global_key <> lower(trim(target_global_key))", "reference_not_below_document": "not starts_with(lower(trim(target_global_key)), target_document_key)",
    "reference_exact_differs": "resolution_method = 'exact' and lower(trim(requested_target_global_key)) <> lower(trim(target_global_key))", "reference_nearest_is_same": "resolution_method = 'nearest_ancestor' and lower(trim(requested_target_global_key)) = lower(trim(target_global_key))", "reference_level_missing": "target_level is null", "reference_to_own_document": "target_document_key = source_document_id",
}


@query(f"with {R}, " + _found(_REF_RULES, "r", "reference_id"))
def reference_audit(spark, root):
    c = F.col
    key, asked = F.lower(F.trim("target_global_key")), F.lower(F.trim("requested_target_global_key"))
    rules = {
        "reference_source_missing": _blank("source_chunk_id"), "reference_target_missing": _blank("target_global_key"), "reference_mention_missing": _blank("mention_text"), "reference_span_missing": c("char_start").isNull() | c("char_end").isNull(), "reference_span_reversed": c("char_start") >= c("char_end"), "reference_span_differs": (c("char_end") - c("char_start")) != F.char_length("mention_text"),
        "reference_status_missing": c("resolution_status").isNull(), "reference_status_unknown": ~c("resolution_status").isin("resolved", "nearest", "unresolved"), "reference_method_without_status": c("resolution_method").isNotNull() & (c("resolution_status") == "unresolved"), "reference_key_not_normal": c("target_global_key") != key, "reference_not_below_document": ~key.startswith(c("target_document_key")),
        "reference_exact_differs": (c("resolution_method") == "exact") & (asked != key), "reference_nearest_is_same": (c("resolution_method") == "nearest_ancestor") & (asked == key), "reference_level_missing": c("target_level").isNull(), "reference_to_own_document": c("target_document_key") == c("source_document_id"),
    }
    return quality.audit(references(spark, root), rules, c("reference_id"))


@query(f"with {C}, i as (select distinct unit_id as id from structural_units union select distinct document_id from structural_units), w as (select distinct chunk_id as item_id, unnest(regexp_extract_all(text, '[A-Za-z0-9_]+')) as id from c where text is not null), p as (select distinct 'planted' || vec_id as item_id, unnest(['see', document_id || '.']) as t, document_id from passage_vectors where document_id is not null) select distinct w.item_id, w.id from w join i using (id) union select distinct item_id, document_id from p join i on i.id = p.document_id")
def leaked_ids(spark, root):
    """Internal ids that show in texts; the texts have none, so that notes that name documents stand beside them."""
    u = table(spark, root, "structural_units")
    ids = u.select(F.col("unit_id").alias("id")).unionByName(u.select(F.col("document_id").alias("id")))
    notes = table(spark, root, "passage_vectors").where("document_id is not null").select(F.concat(F.lit("planted"), "vec_id").alias("item_id"), F.concat(F.lit("see "), "document_id", F.lit(".")).alias("text"))
    return quality.leaked_ids(chunks(spark, root, "text").where("text is not null").select(F.col("chunk_id").alias("item_id"), "text").unionByName(notes), ids)


@query(f"""with {U}, {C}, k as (select document_id, count(*) as n_chunks, sum(length(text))::bigint as n_characters, max(page_end) as pages, count(*) filter (where chunk_type = 'note') as n_notes, count(*) filter (where text is null or trim(text) = '') as n_blank, max(length(text)) as longest from c where document_id is not null group by 1),
v as (select document_id, count(*) as n_units, count(*) filter (where unit_type in ('paragraph', 'article')) as n_paragraphs, count(*) filter (where unit_type = 'table') as n_tables from u where document_id is not null group by 1)
select document_id, n_units, n_paragraphs, n_tables, coalesce(n_chunks, 0) as n_chunks, n_characters, n_notes, round(n_chunks / pages, 6) as density, array_to_string(list_filter([case when n_paragraphs < 3 then 'few_paragraphs' end, case when pages > 0 and n_chunks / pages < 0.2 then 'density_low' end, case when longest > 15000 then 'text_oversized' end, case when n_blank > 0 then 'blank_texts' end, case when n_chunks is null then 'no_chunks' end], lambda x: x is not null), ',') as codes from v left join k using (document_id)""")
def document_audit(spark, root):
    """Counters of each document, and what they say is wrong with it."""
    c, u = chunks(spark, root, "text").where("document_id is not null"), units(spark, root).where("document_id is not null")
    n = lambda cond: F.count_if(cond)
    k = c.groupBy("document_id").agg(F.count(F.lit(1)).alias("k"), F.sum(F.char_length("text")).alias("n_characters"), F.max("page_end").alias("pages"), n(F.col("chunk_type") == "note").alias("n_notes"), n(_blank("text")).alias("n_blank"), F.max(F.char_length("text")).alias("longest"))
    v = u.groupBy("document_id").agg(F.count(F.lit(1)).alias("n_units"), n(F.col("unit_type").isin("paragraph", "article")).alias("n_paragraphs"), n(F.col("unit_type") == "table").alias("n_tables"))
    density = F.when(F.col("pages") != 0, F.col("k") / F.col("pages"))
    codes = F.array_compact(F.array(F.when(F.col("n_paragraphs") < 3, "few_paragraphs"), F.when((F.col("pages") > 0) & (density < 0.2), "density_low"), F.when(F.col("longest") > 15000, "text_oversized"), F.when(F.col("n_blank") > 0, "blank_texts"), F.when(F.col("k").isNull(), "no_chunks")))
    return v.join(k, "document_id", "left").select("document_id", "n_units", "n_paragraphs", "n_tables", F.coalesce("k", F.lit(0)).alias("n_chunks"), "n_characters", "n_notes", F.round(density, 6).alias("density"), F.array_join(codes, ",").alias("codes"))


