"""Queries of the rules on single values, projections and node builders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import forms
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


_SLUG = "trim(regexp_replace(replace(replace(replace(replace(replace(lower({0}), '§', 'para'), 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'ß', 'ss'), '[^a-z0-9]+', '_', 'g'), '_')"
_TITLES = "(select distinct title as t from register_documents where title is not null and regexp_matches(title, '^[ -~äöüÄÖÜß§„“–]*$'))"


def _titles(spark, root):
    return table(spark, root, "register_documents").select(F.col("title").alias("t")).where("t is not null").where(F.col("t").rlike("^[ -~äöüÄÖÜß§„“–]*$")).distinct()


_ASCII = "translate(regexp_replace({0}, '[„“–§]', '', 'g'), 'äöüÄÖÜ', 'aouAOU')"


@query(f"""select t, {_SLUG.format('t')} as alias_key, regexp_replace(t, '[^A-Za-z0-9_]', '_', 'g') as graph_name,
coalesce(nullif(lower(trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(replace(t, 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'Ä', 'Ae'), 'Ö', 'Oe'), 'Ü', 'Ue'), 'ß', 'ss'), '[„“–§]', '', 'g'), '[^A-Za-z0-9]+', '_', 'g'), '_')), ''), 'document') as file_slug,
trim(regexp_replace({_ASCII.format("replace(lower(t), 'ß', 'ss')")}, '[^a-z0-9]+', ' ', 'g')) as register_key from {_TITLES}""")
def name_slugs(spark, root):
    t = F.col("t")
    return _titles(spark, root).select("t", forms.alias_key(t).alias("alias_key"), forms.graph_name(t).alias("graph_name"), forms.file_slug(t).alias("file_slug"), forms.register_key(t).alias("register_key"))


@query(f"""with s as (select t, {_SLUG.format('t')} as s from (select distinct concat_ws(' ', a.adj, l.short_title) as t from core_laws l, (values ('Deutsches'), ('Deutschen'), ('Neue'), ('Alter'), ('')) a(adj) where l.short_title is not null)),
p as (select *, split_part(s, '_', 1) as f, regexp_extract(s, '^[^_]*(_.*)$', 1) as r, case when s like '%gesetz' or s like '%gesetzbuch' then 'es' when s like '%ordnung' then 'e' when s like '%vertrag' then 'er' end as e from s)
select t, array_to_string(list_sort(list_distinct(list_filter([s, case when r <> '' and e is not null then case when f like '%en' then substr(f, 1, length(f) - 2) || e || r when ends_with(f, e) then substr(f, 1, length(f) - length(e)) || 'en' || r end end], lambda x: x is not null))), ',') as keys from p""")
def inflected_law_names(spark, root):
    names = table(spark, root, "core_laws").where("short_title is not null").select(F.explode(F.array(*[F.concat(F.lit(a), F.col("short_title")) for a in ("Deutsches ", "Deutschen ", "Neue ", "Alter ", " ")])).alias("t")).distinct()
    return names.select("t", F.array_join(forms.inflected_keys(F.col("t")), ",").alias("keys"))


@query("""with c as (select distinct trim(trim(trim(regexp_replace(x, '\\s+', ' ', 'g')), '"')) as c from (select title || tail as x from core_laws, (values (''), (' vom 12. März 2031'), (', die zuletzt durch Artikel 2 geändert worden ist'), (' in der Fassung  der Bekanntmachung'), (' [1] [2]')) v(tail) where title is not null)),
a as (select c, greatest(0, coalesce(length(nullif(regexp_extract(c, '^(.*?)\\s+in\\s+der\\s+Fassung\\b', 1), '')), 0)) as i1, coalesce(length(nullif(regexp_extract(c, '^(.*?),\\s+d(as|ie|er)\\s+zuletzt\\b', 1), '')), 0) as i2, coalesce(length(nullif(regexp_extract(c, '^(.*?)\\s+vom\\s+\\d{1,2}\\.\\s+[A-ZÄÖÜa-zäöüß]+\\s+\\d{4}\\b', 1), '')), 0) as i3 from c)
select c as citation, trim(case when i1 > 5 then substr(c, 1, i1) when i2 > 5 then substr(c, 1, i2) when i3 > 5 then substr(c, 1, i3) else c end) as title, trim(regexp_replace(c, '(\\s*\\[[^\\[\\]]+\\])+\\s*$', '')) as bare from a""")
def citation_titles(spark, root):
    tails = ("", " vom 12. März 2031", ", die zuletzt durch Artikel 2 geändert worden ist", " in der Fassung  der Bekanntmachung", " [1] [2]")
    cited = table(spark, root, "core_laws").where("title is not null").select(F.explode(F.array(*[F.concat("title", F.lit(t)) for t in tails])).alias("x")).select(forms.clean_citation(F.col("x")).alias("citation")).distinct()
    return cited.select("citation", forms.title_of_citation(F.col("citation")).alias("title"), forms.without_footnote_marks(F.col("citation")).alias("bare"))


@query("""select distinct t, t <> '' and len(string_split(t, ' ')) <= 18 and not regexp_matches(lower(t), '^artikels?\\b|\\binnerhalb\\s+eines?\\b|\\bnach\\s+dem\\s+inkrafttreten\\b|\\bzur\\s+mitwirkung\\s+bei\\s+dem\\b|\\b(ist|sind|wird|werden|wurde|wurden|gilt|gelten)\\s+(anzuwenden|angeordnet|beruecksichtigt|berücksichtigt)\\b') as plausible
from (select trim(regexp_replace(split_part(text, '.', 1), '\\s+', ' ', 'g')) as t from documents where text is not null)""")
def plausible_names(spark, root):
    """Which first sentences of documents could be the name of a law."""
    first = table(spark, root, "documents").where("text is not null").select(F.btrim(F.regexp_replace(F.split_part("text", F.lit("."), F.lit(1)), r"\s+", " ")).alias("t")).distinct()
    return first.select("t", forms.plausible_law_name(F.col("t")).alias("plausible"))


_STOP = ", ".join(f"'{w}'" for w in forms.STOP_WORDS)


@query(f"""with {C}, a as (select chunk_id, trim(regexp_replace(translate(lower(regexp_replace(replace(replace(text, chr(173), ''), chr(0), ''), '(\\pL)[-‐]\\s*\\n\\s*(\\p{{Ll}})', '\\1\\2', 'g')), '‐‑‒–—−' || chr(160), '------ '), '\\s+', ' ', 'g')) as t from c where text is not null and not regexp_matches(text, '[^' || chr(1) || '-ÿ„“–…₂]'))
select chunk_id, length(t) as n_letters, len(list_filter(regexp_extract_all(t, '[\\pL\\pN§]+'), lambda w: length(w) >= 2 and w not in ({_STOP})))::int as n_tokens from a""")
def alignment_words(spark, root):
    """Sizes of the texts as the alignment compares them, of chunks in Latin letters."""
    rows = chunks(spark, root, "text").where("text is not null").where(~F.col("text").rlike("[^\u0001-ÿ„“–…₂]"))
    return rows.select("chunk_id", F.char_length(forms.alignment_text(F.col("text"))).alias("n_letters"), F.size(forms.alignment_tokens(F.col("text"))).alias("n_tokens"))


@query("""with a as (select item_id, text as t, replace(lower(text), 'ß', 'ss') as l, trim(regexp_replace(lower(text), '[^0-9a-zäöüß§]+', ' ', 'g')) as n from eval_cases where text is not null)
select item_id, (contains(l, 'frist')::int + contains(l, 'the')::int + contains(l, 'kammer')::int) / 3.0::double as has_all, (contains(l, 'behörde') or contains(l, 'demande'))::int::double as has_any, ((contains(l, 'der') or contains(l, 'the'))::int + (contains(l, 'zwei') or contains(l, 'two'))::int) / 2.0::double as has_groups,
contains(n, 'der antrag')::int::double as has_words, (len(regexp_extract_all(t, '[0-9A-Za-zÄÖÜäöüß]+([-''][0-9A-Za-zÄÖÜäöüß]+)*')) between 40 and 80)::int::double as fits from a where not regexp_matches(t, '[^' || chr(1) || '-~ÄÖÜäöüß§„“–]|_')""")
def answer_checks(spark, root):
    """The checks of answers on texts of plain German and English."""
    a = table(spark, root, "eval_cases").where("text is not null").where(~F.col("text").rlike("[^\u0001-~ÄÖÜäöüß§„“–]|_"))
    t = F.col("text")
    return a.select("item_id", forms.contains_all(t, ["Frist", "the", "Kammer"]).alias("has_all"), forms.contains_any(t, ["Behörde", "demande"]).alias("has_any"), forms.contains_groups(t, [["der", "the"], ["zwei", "two"]]).alias("has_groups"), forms.contains_normalized(t, "Der  Antrag!").alias("has_words"), forms.words_between(t, 40, 80).alias("fits"))


@query(f"""with {C}, x as (select chunk_id, page_start as a, page_end as b, lead(page_start) over w as c, lead(page_end) over w as d from c where document_id is not null window w as (partition by document_id order by sequence nulls first, chunk_id))
select chunk_id, case when a is null then null when a = b then 'S. ' || a when b is null then null else 'S. ' || a || '–' || b end as label, coalesce(a <= d and c <= b, false) as overlaps, case when a is null and b is null then null when a is null or b is null then 'not_integers' when a < 1 or b < a then 'not_ordered' when b > 120 then 'beyond_pages' end as fault from x""")
def page_ranges(spark, root):
    from pyspark.sql import Window

    by = Window.partitionBy("document_id").orderBy("sequence", "chunk_id")
    a, b = F.col("page_start"), F.col("page_end")
    rows = chunks(spark, root).where("document_id is not null").select("chunk_id", "page_start", "page_end", F.lead("page_start").over(by).alias("c"), F.lead("page_end").over(by).alias("d"))
    return rows.select("chunk_id", forms.page_label(a, b).alias("label"), forms.ranges_overlap(a, b, F.col("c"), F.col("d")).alias("overlaps"), forms.page_range_fault(a, b, F.lit(120)).alias("fault"))


@query("select source, count(*) as n, round(sum(strlen(coalesce(text, '')) + 64) * 3 * 0.04 / 1e6, 9) as cost from documents where source is not null group by source")
def embedding_cost(spark, root):
    texts = table(spark, root, "documents").where("source is not null").withColumn("text", F.coalesce("text", F.lit("")))
    return texts.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.round(forms.cost_bound(F.col("text"), 0.04), 9).alias("cost"))


@query("""select distinct title, '''' || replace(replace(replace(replace(title, '\\', '\\\\'), '''', '\\'''), chr(10), '\\n'), chr(13), '\\r') || '''' as cypher, replace(replace(replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') as html from register_documents where title is not null""")
def escaped_titles(spark, root):
    t = F.col("title")
    return table(spark, root, "register_documents").where("title is not null").select("title", forms.cypher_text(t).alias("cypher"), forms.html_text(t).alias("html")).distinct()


@query("""with u as (select distinct id, landing_url, 'HTTP://Register.Example//' || id || '/index.html#top' as detail from register_documents where id is not null)
select id, case when landing_url like 'https://register.example/%' then regexp_replace(landing_url, '([^:])/+', '\\1/', 'g') end as url, 'https://register.example/' || id || '/' as law_key, 'https://register.example/' || id || '/xml.zip' as package from u""")
def canonical_urls(spark, root):
    hosts = ["register.example"]
    u = table(spark, root, "register_documents").where("id is not null").select("id", "landing_url", F.concat(F.lit("HTTP://Register.Example//"), F.col("id"), F.lit("/index.html#top")).alias("detail")).distinct()
    return u.select("id", forms.canonical_url(F.col("landing_url"), hosts).alias("url"), forms.law_key_of_url(F.col("detail"), hosts).alias("law_key"), forms.package_url(F.col("detail"), hosts).alias("package"))


@query(f"""with {U}, {C} select c.chunk_id, coalesce(regexp_matches(c.text, '(?i)\\b(weggefallen|aufgehoben|außer\\s+kraft)\\b'), false) as repealed, coalesce(regexp_matches(c.text, '(?i)\\bnicht\\s+darstellbar'), false) as unavailable, coalesce(nullif(c.legal_citation, ''), nullif(u.title, ''), nullif(u.global_key, ''), nullif(c.chunk_id, ''), '<unknown>') as citation from c left join u on u.unit_id = c.unit_id""")
def chunk_flags(spark, root):
    u = units(spark, root).select("unit_id", "title", "global_key")
    rows = chunks(spark, root, "text", "legal_citation").join(u, "unit_id", "left")
    return rows.select("chunk_id", forms.is_repealed(F.col("text")).alias("repealed"), forms.is_unavailable_table(F.col("text")).alias("unavailable"), forms.best_citation(F.col("legal_citation"), F.col("title"), F.col("global_key"), F.col("chunk_id")).alias("citation"))


@query(f"""with {U}, r as (select unit_id, unnest(from_json(rows_json::json, '["json"]')) as r, generate_subscripts(from_json(rows_json::json, '["json"]'), 1) - 1 as row_no from u where rows_json is not null)
select unit_id, row_no::int as row_no, trim(coalesce(r ->> 'Nummer', r ->> 'Parameter', r ->> (json_keys(r)[1]), '')) as marker from r where json_type(r) = 'OBJECT'""")
def table_row_markers(spark, root):
    rows = units(spark, root).where("rows_json is not null").select("unit_id", F.posexplode(F.from_json("rows_json", "array<string>")).alias("row_no", "r"))
    return rows.where(F.col("r").startswith("{")).select("unit_id", "row_no", forms.row_marker(F.col("r")).alias("marker"))


@query("select law_key, '{' || concat_ws(',', case when abbreviation is not null then '\"abbreviation\":\"' || abbreviation || '\"' end, case when act_number is not null then '\"act_number\":\"' || act_number || '\"' end, '\"law_key\":\"' || law_key || '\"', case when short_title is not null then '\"short_title\":\"' || replace(short_title, '\"', '\\\"') || '\"' end) || '}' as properties from core_laws where law_key is not null")
def law_properties(spark, root):
    """Properties of law nodes as JSON with ordered keys, without nulls; only those on the list of their label."""
    laws = table(spark, root, "core_laws").where("law_key is not null")
    allowed = ("short_title", "law_key", "abbreviation", "act_number")
    return laws.select("law_key", forms.sorted_json({c: F.col(c) for c in laws.columns if c in allowed}).alias("properties"))


_LINE = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"


@query(f"""with {C} select chunk_id as node_id, 'Chunk' as label, chunk_type, page_start, page_end, case when length({_LINE}) > 500 then rtrim(substr({_LINE}, 1, 499), ' ') || '…' else {_LINE} end as preview, length(text) as n_characters from c where text is not null""")
def chunk_nodes(spark, root):
    """Chunk nodes: pages as two numbers, a preview of the text and its size instead of the text."""
    rows = chunks(spark, root, "text").where("text is not null")
    return rows.select(F.col("chunk_id").alias("node_id"), F.lit("Chunk").alias("label"), "chunk_type", "page_start", "page_end", forms.preview(F.col("text")).alias("preview"), F.char_length("text").alias("n_characters"))


@query("select chunk_id, source_order, page_start, page_end from (select distinct chunk_id, source_order, page_start, page_end, loaded_at from chunks)")
def provenance_columns(spark, root):
    """Columns that say where a record comes from are passed through, whichever of them a table has."""
    rows = table(spark, root, "chunks")
    kept = [c for c in rows.columns if c.startswith(("source_", "page_"))]
    return rows.select("chunk_id", *kept, "loaded_at").distinct().drop("loaded_at")


@query(f"""with {U} select unit_id, len(from_json(rows_json::json, '["json"]'))::int as n_rows, array_to_string(list_sort(json_keys(from_json(rows_json::json, '["json"]')[1])), '|') as columns from u where rows_json is not null and json_type(from_json(rows_json::json, '["json"]')[1]) = 'OBJECT'""")
def compact_tables(spark, root):
    """Tables without their rows: how many there are and the columns of the first."""
    rows = units(spark, root).where("rows_json is not null").select("unit_id", F.from_json("rows_json", "array<string>").alias("r")).where(F.get("r", 0).startswith("{"))
    return rows.select("unit_id", F.size("r").alias("n_rows"), F.array_join(F.array_sort(F.json_object_keys(F.get("r", 0))), "|").alias("columns"))


@query(f"with {R} select reference_id, to_json({{'kind': reference_kind, 'level': target_level}})::varchar as fields from (select * from r where reference_kind is not null and target_level is not null)")
def scalar_json(spark, root):
    rows = references(spark, root).where("reference_kind is not null and target_level is not null")
    return rows.select("reference_id", forms.sorted_json({"level": F.col("target_level"), "kind": F.col("reference_kind")}).alias("fields"))


@query("select distinct id, graph_mention_count as n, try_cast(trim(publication_date) as int) as year_only, try_cast(trim(split_part(title, ' ', 2)) as int) as second from register_documents")
def safe_numbers(spark, root):
    d = table(spark, root, "register_documents")
    return d.select("id", F.col("graph_mention_count").alias("n"), forms.safe_int(F.col("publication_date")).alias("year_only"), forms.safe_int(F.split_part("title", F.lit(" "), F.lit(2))).alias("second")).distinct()


@query("""select x as line, case when regexp_matches(x, '(?is)^\\s*(Fortsetzung\\s+)?Tabelle\\s+\\d') then 'Tabelle ' || regexp_extract(x, '(?i)Tabelle\\s+(\\d+[a-z]?)', 1) end as label, case when regexp_matches(x, '(?is)^\\s*(Fortsetzung\\s+)?Tabelle\\s+\\d') then regexp_matches(x, '(?i)^\\s*Fortsetzung') end as continuation
from (select distinct 'Tabelle ' || number || ': ' || coalesce(title, '') as x from structural_units where unit_type = 'table' and number is not null union select distinct 'Fortsetzung  Tabelle ' || number from structural_units where unit_type = 'table' and number is not null union select distinct label from structural_units where label is not null)""")
def table_cues(spark, root):
    u = table(spark, root, "structural_units")
    t = u.where("unit_type = 'table' and number is not null")
    lines = t.select(F.concat(F.lit("Tabelle "), "number", F.lit(": "), F.coalesce("title", F.lit(""))).alias("line")).union(t.select(F.concat(F.lit("Fortsetzung  Tabelle "), "number"))).union(u.where("label is not null").select("label")).distinct()
    cue = forms.table_cue(F.col("line"))
    return lines.select("line", cue["label"].alias("label"), cue["continuation"].alias("continuation"))


