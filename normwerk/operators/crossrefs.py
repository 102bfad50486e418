"""References of a corpus: which document and unit each citation in a text means, resolved and rolled up.

A parser gives every citation with what stands around it: the words after it that may be a law's name, whether only a bridge
("und", "i. V. m.") separates it from the one before, a European act that it belongs to, the heading it stands under. What
they mean is decided by joins and windows: names by an equi-join with the aliases that have one document only, chains and
references back by windows over the citations of a text, targets by exact key or nearest ancestor.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import forms
from ..functions import normalize as N
from ..skew import salted_left_join
from . import citations, lookup

#: Most words of a law's name, and letters between an article and the act it belongs to.
MOST_WORDS, MOST_GAP = 18, 400
_BRIDGE = re.compile(r"\s*(?:,|;|und|oder|sowie|bis|auch|in Verbindung mit|i\. ?V\. ?m\.|jeweils|and|or)?\s*(?:mit|den|der|nach)?\s*", re.I)
_LEAD = re.compile(r"\s+(?:(?:des|der|dem|vom|zum|zur|im|of the|of)\s+)?")
_WORD = re.compile(r"[^\s,;:()\[\]„“\"]+")
_BACK = re.compile(r"\s+(?:des(?:selben|jenigen|\s+genannten)\s+\w+|der(?:selben|jenigen|\s+genannten)\s+\w+|of the same \w+)", re.I)
# Kinds of European acts as they are written, by their generic type (delegated and implementing acts are of it).
ACT_KINDS = {"verordnung": "verordnung", "regulation": "verordnung", "richtlinie": "richtlinie", "directive": "richtlinie", "beschluss": "beschluss", "decision": "beschluss", "entscheidung": "entscheidung", "rahmenbeschluss": "beschluss"}
_ACT = re.compile(r"(?:(?:Delegierte[nr]?|Durchführungs|Delegated|Implementing)[\s-]?)?(Verordnung|Regulation|Richtlinie|Directive|Rahmenbeschluss(?:es)?|Beschluss(?:es)?|Decision|Entscheidung)\s*(?:\((EU|EG|EWG|EAG)\)\s*)?(Nr\.\s*)?(\d{1,4})/(\d{1,4})(?:/(EU|EG|EWG|EAG))?", re.I)
_HEADING = re.compile(r"(?m)^.*?(?:Das|Die|Der)\s+([^\n:]{3,400}?)\s+(?:wird|werden)\s+wie folgt geändert:|^(?:Aus|Nach|From|Under)\s+(?:der|dem|des|the)\s+([^\n:]{3,400}?):\s*$")
_BARE = re.compile(r"(?<![\w(])(?:Absatz|Absätze|Abs\.)\s*(\d+[a-z]?)")
_SENTENCE = re.compile(r"[.;!?]\s+(?=[A-ZÄÖÜ§(])")

MENTIONS = (
    "source_id string, n int, char_start int, char_end int, mention_text string, base string, keys array<string>, bridged boolean, back boolean,"
    " names array<struct<alias:string,char_end:int>>, scope_names array<string>, act_key string, act_start int, bare boolean"
)


def act_key(m: re.Match) -> str:
    kind = ACT_KINDS[re.sub("es$", "", m[1].lower())] if re.sub("es$", "", m[1].lower()) in ACT_KINDS else ACT_KINDS[m[1].lower()]
    body = (m[2] or "").lower()
    if body:
        return f"{kind}_{body}{'_nr' if m[3] else ''}_{m[4]}_{m[5]}"
    return f"{kind}_{m[4]}_{m[5]}_{(m[6] or 'eu').lower()}"


def _names(text: str, at: int) -> list[tuple[str, int]]:
    """Beginnings of what stands at a place, word by word, each with its end; a sentence's end or a bracket ends it."""
    out, end = [], at
    for _ in range(MOST_WORDS):
        m = _WORD.match(text, end)
        if not m or m.group() in ("und", "oder", "sowie"):
            break
        word = m.group().rstrip(".")
        out.append((text[at : m.start() + len(word)], m.start() + len(word)))
        if word != m.group() and len(word) > 3:
            break
        end = m.end()
        gap = re.compile(r"\s+").match(text, end)
        if not gap:
            break
        end = gap.end()
    return out


def parse(text: str) -> list[tuple]:
    """Rows of MENTIONS without the source, from left to right. The first line is skipped by no rule: spans count from the text's start."""
    acts = [(m.start(), m.end(), act_key(m)) for m in _ACT.finditer(text)]
    headings = [(m.end(), m[1] or m[2]) for m in _HEADING.finditer(text)]
    found = [(a, b, mention, keys, False) for a, b, mention, keys in citations.mentions_in(text)]
    taken = [(a, b) for a, b, *_ in found]
    for m in _BARE.finditer(text):
        if not any(a <= m.start() < b for a, b in taken):
            found.append((m.start(), m.end(), m.group(), [f"abs_{m[1]}"], True))
    found.sort()
    out, last = [], None
    for n, (a, b, mention, keys, bare) in enumerate(found):
        bridged = last is not None and _BRIDGE.fullmatch(text, last, a) is not None
        lead = _LEAD.match(text, b)
        names = _names(text, lead.end()) if lead else []
        close = _SENTENCE.search(text, b)
        act = next((x for x in acts if b <= x[0] <= b + MOST_GAP and (not close or x[0] < close.end())), None)
        heading = next((h for e, h in reversed(headings) if e <= a), None)
        scope = []
        if heading:
            words = heading.split()
            parts = [words[i:j] for i in range(min(3, len(words))) for j in range(len(words), i, -1)]
            scope = [" ".join([first, *rest]) for first, *rest in parts for first in (first, first + "s")]  # after an article, an adjective has no "s"
        out.append((n, a, b, mention, keys[0].split("_")[0] if keys else "", keys, bridged, _BACK.match(text, b) is not None, [{"alias": x, "char_end": e} for x, e in names], scope, act[2] if act else None, act[0] if act else None, bare))
        last = b
    # acts that no citation belongs to are mentioned as documents
    used = {r[11] for r in out}
    for a, b, key in acts:
        if a not in used:
            out.append((len(out), a, b, text[a:b], "", [], False, False, [], [], key, a, False))
    return out


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    s, i, b = pa.string(), pa.int32(), pa.bool_()
    types = [s, i, i, i, s, s, pa.list_(s), b, b, pa.list_(pa.struct([("alias", s), ("char_end", i)])), pa.list_(s), s, i, b]
    names = "source_id n char_start char_end mention_text base keys bridged back names scope_names act_key act_start bare".split()
    for batch in batches:
        out = [(key, *row) for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if text for row in parse(text)]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [()] * len(names), types)], names)


def alias_index(documents: DataFrame, columns: list[str]) -> DataFrame:
    """(alias_key, document_key) of the aliases that name one document only: each name, without its footnote marks, up to where
    a citation goes on, without an article before it, and in the other case of its adjective."""
    names = documents.select("document_key", F.explode(F.array(*[F.col(c) for c in columns])).alias("x")).where("x is not null")
    plain = forms.without_footnote_marks(F.col("x"))
    spelled = F.array(plain, forms.title_of_citation(plain), F.regexp_replace(plain, "^(?i)(?:das|die|der|des)\\s+", ""))
    each = names.select("document_key", F.explode(spelled).alias("x")).where("x <> ''").select("document_key", F.explode(F.array_union(forms.inflected_keys(F.col("x")), F.array(N.law_name(F.col("x"))))).alias("alias_key"))
    return lookup.unique_aliases(each, F.col("alias_key"), "document_key").where("target is not null").select("alias_key", F.col("target").alias("document_key"))


def references(chunks: DataFrame, aliases: DataFrame, targets: DataFrame) -> DataFrame:
    """chunks(source_id, document_key, unit_key, context_key, text), aliases(alias_key, document_key), targets(key) -> one row a target.

    (source_id, char_start, char_end, mention_text, reference_kind, target_document_key, requested_key, resolved_key,
    resolution). ``unit_key`` is the key of the enclosing unit, ``context_key`` another document that a table's header names.
    Kinds: external_name, external_chain, external_back, external_act, scope, internal, bare. Internal articles and what a
    text says of its own unit are only given if there is such a target; internal annexes and paragraphs that are missing here and
    exactly there go to the document of the context. Levels below subsections and tables are no targets.
    """
    mentions = chunks.where("text is not null").select(F.col("source_id").cast("string").alias("source_id"), "text").mapInArrow(_parse, MENTIONS)
    by = Window.partitionBy("source_id").orderBy("n")
    key = ["source_id", "n"]
    asked = mentions.select(*key, F.explode("names").alias("x")).select(*key, N.law_name(F.col("x.alias")).alias("alias_key"), F.col("x.char_end").alias("name_end")).where("alias_key <> ''")
    plausible = asked.join(aliases, "alias_key")
    named = plausible.groupBy(*key).agg(F.max(F.struct("name_end", F.col("document_key").alias("own"))).alias("x")).select(*key, "x.own", "x.name_end")
    under = mentions.select(*key, F.posexplode("scope_names").alias("place", "x")).select(*key, "place", N.law_name(F.col("x")).alias("alias_key")).join(aliases, "alias_key")
    scoped = under.groupBy(*key).agg(F.min_by("document_key", "place").alias("scope"))
    whole = mentions.drop("names", "scope_names").join(named, key, "left").join(scoped, key, "left")
    chain = F.sum(F.when(F.col("bridged"), 0).otherwise(1)).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = whole.withColumn("chain", chain)
    on = Window.partitionBy("source_id", "chain").orderBy("n").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.withColumns({"after": F.first("own", ignorenulls=True).over(on), "act_after": F.first("act_key", ignorenulls=True).over(on), "earlier": F.last("own", ignorenulls=True).over(before)})
    own = chunks.select(F.col("source_id").cast("string").alias("source_id"), F.col("document_key").alias("_doc"), F.col("unit_key").alias("_unit"), F.col("context_key").alias("_context"))
    whole = whole.join(own, "source_id")
    kind = (
        F.when(F.col("own").isNotNull(), "external_name").when(F.col("after").isNotNull(), "external_chain").when(F.col("back") & F.col("earlier").isNotNull(), "external_back")
        .when(F.col("act_after").isNotNull() & ~F.col("bare"), "external_act").when(F.col("scope").isNotNull(), "scope").when(F.col("bare"), "bare").otherwise("internal")
    )
    document = F.when(kind == "external_name", F.col("own")).when(kind == "external_chain", F.col("after")).when(kind == "external_back", F.col("earlier")).when(kind == "external_act", F.col("act_after")).when(kind == "scope", F.col("scope")).otherwise(F.col("_doc"))
    rows = whole.withColumns({"reference_kind": kind, "target_document_key": document})
    # a reference by its own document's name is an internal one
    rows = rows.withColumn("reference_kind", F.when((F.col("target_document_key") == F.col("_doc")) & (F.col("reference_kind") != "bare"), "internal").otherwise(F.col("reference_kind")))
    each = rows.withColumn("rel", F.explode(F.when(F.size("keys") > 0, F.col("keys")).otherwise(F.array(F.lit("")))))
    enclosing = F.regexp_replace("_unit", r"_(?:abs|satz|nr|buchst)_.*$", "")
    requested = F.when(F.col("reference_kind") == "bare", F.concat_ws("_", enclosing, "rel")).when(F.col("rel") == "", F.col("target_document_key")).otherwise(F.concat_ws("_", "target_document_key", "rel"))
    each = each.withColumn("requested_key", citations.modelled(requested)).where("not (bare and _unit is null)")
    if_context = F.when((F.col("reference_kind") == "internal") & F.col("_context").isNotNull(), citations.modelled(F.concat_ws("_", "_context", "rel")))
    each = each.withColumn("other_key", if_context)
    known = targets.select("key").distinct()
    found = lookup.nearest_ancestor(each, "requested_key", known)
    there = known.select(F.col("key").alias("other_key"), F.lit(True).alias("_there"))
    found = found.join(there, "other_key", "left")
    moved = F.col("_there").isNotNull() & (F.coalesce("steps", F.lit(9)) > 0)
    found = found.withColumns(
        {
            "target_document_key": F.when(moved, F.col("_context")).otherwise(F.col("target_document_key")), "requested_key": F.when(moved, F.col("other_key")).otherwise(F.col("requested_key")),
            "resolved_key": F.when(moved, F.col("other_key")).otherwise(F.col("resolved_key")), "resolution": F.when(moved, "exact").otherwise(F.col("resolution")), "reference_kind": F.when(moved, "context").otherwise(F.col("reference_kind")),
        }
    )
    exact_only = F.col("reference_kind").isin("bare") | ((F.col("reference_kind") == "internal") & (F.col("base") == "art"))
    kept = found.where(~exact_only | (F.col("resolution") == "exact")).where(F.coalesce(F.col("resolved_key") != F.col("_unit"), F.lit(True)))
    columns = ["source_id", "char_start", "char_end", "mention_text", "reference_kind", "target_document_key", "requested_key", "resolved_key", "resolution"]
    return kept.select(*columns).distinct()


def edges(refs: DataFrame, sources: DataFrame, targets: DataFrame) -> DataFrame:
    """Three levels of edges (level, start_node_id, end_node_id, end_kind) of references.

    refs(source_id, target_document_key, requested_key, resolved_key), sources(source_id, unit_id, document_id), targets(key,
    chunk_id, unit_id, document_id). A chunk points to a representative chunk, a unit to the unit, a document to the document;
    where there is none, chunk and unit point to a placeholder of the requested key and the document to one of the document's
    key, unless another unit shows which document that is. No edge within one node or one document.
    """
    t = targets.select(F.col("key").alias("resolved_key"), F.col("chunk_id").alias("tc"), F.col("unit_id").alias("tu"), F.col("document_id").alias("td"))
    known = targets.groupBy(F.col("document_key").alias("target_document_key")).agg(F.min("document_id").alias("kd")) if "document_key" in targets.columns else None
    # a few targets are named by a large part of all references; one that is not resolved has the key of none
    rows = refs.join(sources, "source_id").withColumn("resolved_key", F.coalesce("resolved_key", F.lit("")))
    rows = salted_left_join(rows, t.where("resolved_key <> ''"), ["resolved_key"], [F.col("source_id")])
    rows = rows.join(known, "target_document_key", "left") if known is not None else rows.withColumn("kd", F.lit(None).cast("string"))
    place = lambda c: F.concat(F.lit("target:"), c)
    end = lambda level, start, node, name: rows.select(
        F.lit(level).alias("level"), F.col(start).alias("start_node_id"), F.coalesce(node, place(F.col(name))).alias("end_node_id"), F.when(node.isNotNull(), F.lit(level)).otherwise("placeholder").alias("end_kind")
    )
    every = end("chunk", "source_id", F.col("tc"), "requested_key").unionByName(end("unit", "unit_id", F.col("tu"), "requested_key")).unionByName(end("document", "document_id", F.coalesce("td", "kd"), "target_document_key"))
    return every.where("start_node_id is not null and end_node_id is not null and start_node_id <> end_node_id").distinct()


def assert_levels(graph_edges: DataFrame, kinds: DataFrame) -> DataFrame:
    """The edges; reading them raises if one leaves its level. kinds(node_id, kind): chunk, unit, document or placeholder."""
    k = kinds.select("node_id", "kind")
    both = graph_edges.join(k.toDF("start_node_id", "_a"), "start_node_id", "left").join(k.toDF("end_node_id", "_b"), "end_node_id", "left")
    fine: Column = (F.col("_a") == F.col("level")) & (F.coalesce("_b", F.lit("placeholder")).isin("placeholder") | (F.col("_b") == F.col("level")))
    return both.where(F.assert_true(F.coalesce(fine, F.lit(False)), "a reference leaves its level").isNull()).drop("_a", "_b")
