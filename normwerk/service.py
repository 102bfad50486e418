"""The tools of the retrieval service over a stored index: bounded arguments, named outcomes, results as DataFrames.

A tool answers one request. What decides its course (which document, which unit) is fetched row by row; its result stays a
DataFrame of as many rows as its limits allow.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .functions import normalize as N
from .operators import graph, lookup, payloads, segments
from .operators.index import Index, corpus_name, key

MODES = ("auto", "lexical", "semantic", "hybrid")
COMPONENTS = ("all", "retrieval", "external_register", "neo4j", "vectors")
#: Constant of the reciprocal rank fusion.
FUSION = 60


class Outcome(ValueError):
    """Why a tool has no result: document_not_found, unit_not_found, no_text (with the ``rows`` that have none) or a bad argument."""

    def __init__(self, status: str, rows: DataFrame | None = None):
        super().__init__(status)
        self.rows = rows


def clamp(value: int, low: int, high: int) -> int:
    return max(low, min(int(value), high))


def _reference_key(text: str) -> str:
    out = key(text)
    for long, short in N.REFERENCE_WORDS:
        out = out.replace(long, short)
    return out


class Tools:
    def __init__(self, index: Index, register: DataFrame | None = None, edges: DataFrame | None = None, vectors: DataFrame | None = None, embed: Callable[[str], list[float]] | None = None):
        """register(id, title, short_title, graph_mention_count, ...), edges(start_node_id, end_node_id, ...), vectors(passage_id,
        vector) of unit length, ``embed`` makes a query's vector."""
        self.index, self.register, self.edges, self.vectors, self.embed = index, register, edges, vectors, embed

    # -- status --

    def status(self, component: str = "all") -> DataFrame:
        """(component, name, total) of the parts that are there."""
        component = component.strip().casefold()
        if component not in COMPONENTS:
            raise Outcome(f"component must be one of {', '.join(COMPONENTS)}")
        parts = []
        if component in ("all", "retrieval"):
            parts += [("retrieval", n, self.index.table(n)) for n in ("documents", "units", "passages")]
        for name, df in (("external_register", self.register), ("neo4j", self.edges), ("vectors", self.vectors)):
            if df is not None and component in ("all", name):
                parts.append((name, "rows", df))
        if not parts:
            raise Outcome(f"{component} is not available")
        rows = [df.agg(F.count(F.lit(1)).alias("total")).select(F.lit(c).alias("component"), F.lit(n).alias("name"), "total") for c, n, df in parts]
        out = rows[0]
        for r in rows[1:]:
            out = out.unionByName(r)
        return out

    # -- documents --

    def find_documents(self, query: str, corpus: str | None = None, limit: int = 5) -> DataFrame:
        """(document_id, document_key, title, score, matched_alias, rank): those with exactly that alias, by title; only if there is none, the best by BM25."""
        limit, kind = clamp(limit, 1, 8), corpus_name(corpus)
        documents = self.index.table("documents")
        inside = documents if kind is None else documents.where(F.col("source_kind") == kind)
        exact = self.index.table("document_aliases").where(F.col("normalized_alias") == key(query)).groupBy("document_id").agg(F.min("alias").alias("matched_alias")).join(inside, "document_id")
        exact = exact.withColumn("score", F.lit(1.0)).orderBy(F.lower("title"), "document_id").limit(limit)
        columns = ["document_id", "document_key", "title", "score", "matched_alias"]
        if key(query) and not exact.isEmpty():
            return lookup.numbered(exact.select(*columns), [F.lower("title"), F.col("document_id")])
        hits = self.index.search("documents", query, {"source_kind": kind}, limit, per="document_id")
        return hits.join(documents, "document_id").select(*columns[:-1], F.split_part("item_id", F.lit("\0"), F.lit(2)).alias("matched_alias"), "rank")

    def resolve_document(self, reference: str, corpus: str | None = None) -> Row:
        """The document of that id in any corpus, else the first that is found in it."""
        row = self.index.table("documents").where(F.col("document_id") == reference).first() or self.find_documents(reference, corpus, 1).first()
        if row is None:
            raise Outcome("document_not_found")
        return row

    def outline(self, document_ref: str, max_depth: int = 1, limit: int = 30) -> DataFrame:
        """(unit_id, unit_type, legal_citation, title, depth, sequence, truncated) of the upper levels of a document, in its order."""
        max_depth, limit = clamp(max_depth, 0, 3), clamp(limit, 1, 80)
        units = self.index.table("units").where(F.col("document_id") == self.resolve_document(document_ref).document_id)
        levels = lookup.upper_levels(units, "unit_id", "parent_unit_id", max_depth)
        n = levels.agg(F.count(F.lit(1)).alias("_n"))
        chosen = levels.orderBy(F.col("sequence").asc_nulls_first(), "unit_id").limit(limit).crossJoin(F.broadcast(n))  # one row
        return chosen.select("unit_id", "unit_type", "legal_citation", "title", "depth", "sequence", (F.col("_n") > limit).alias("truncated"))

    # -- units --

    def _units(self, document_id: str) -> DataFrame:
        return self.index.table("units").where(F.col("document_id") == document_id)

    def _exact_units(self, document_id: str, reference: str) -> DataFrame:
        units = self._units(document_id)
        direct = units.where((F.col("unit_id") == reference) | (F.col("global_key") == reference))
        named = self.index.table("unit_aliases").where((F.col("document_id") == document_id) & (F.col("normalized_alias") == key(reference))).select("unit_id").distinct()
        steps = direct.withColumn("_step", F.lit(0)).unionByName(units.join(named, "unit_id").select(units.columns).withColumn("_step", F.lit(1)))
        return lookup.first_step(steps, "_step")

    def find_units(self, document_id: str, reference: str, limit: int = 10) -> DataFrame:
        """(unit_id, legal_citation, sequence, score): of that id or key, else of that alias, else the best by BM25 in the document."""
        limit = clamp(limit, 1, 50)
        columns = ["unit_id", "legal_citation", "sequence"]
        exact = self._exact_units(document_id, reference).orderBy(F.col("sequence").asc_nulls_first(), "unit_id").limit(limit)
        if not reference.strip() or not exact.isEmpty():
            return exact.select(*columns, F.lit(1.0).alias("score"))
        hits = self.index.search("units", reference, {"document_id": document_id}, limit)
        return hits.join(self._units(document_id).withColumnRenamed("unit_id", "item_id").drop("document_id"), "item_id").select(F.col("item_id").alias("unit_id"), *columns[1:], "score")

    def _only_suffix(self, units: DataFrame, reference: str) -> Row | None:
        wanted = _reference_key(reference)
        found = units.where(N.reference_key(F.col("legal_citation")).endswith(wanted)).select("unit_id").limit(2).collect() if wanted else []
        return found[0] if len(found) == 1 else None

    def resolve_unit(self, document_id: str, reference: str) -> str:
        """The unit that a reference names; with a level below the unit, never one that is only alike.

        Such a reference is tried as it is, then as the only citation that ends so, then as the only one below its unit,
        then its unit itself.
        """
        reference = reference.strip()
        above = self.index.spark.range(1).select(N.unit_part(F.lit(reference))).first()[0]
        first = lambda df: df.orderBy(F.col("sequence").asc_nulls_first(), "unit_id").select("unit_id").first()
        units = self._units(document_id)
        if above == reference:
            row = first(self.find_units(document_id, reference, 1))
        else:
            row = first(self._exact_units(document_id, reference)) or self._only_suffix(units, reference)
            parent = None if row else first(self._exact_units(document_id, above)) or self._only_suffix(units, above)
            if parent:
                row = self._only_suffix(self._below(document_id, parent.unit_id).join(units, "unit_id"), reference) or parent
        if row is None:
            raise Outcome("unit_not_found")
        return row.unit_id

    def _below(self, document_id: str, unit_id: str) -> DataFrame:
        """(unit_id) of all units below one, level by level; a document has few levels."""
        links = self._units(document_id).select("unit_id", "parent_unit_id")
        start = self.index.spark.createDataFrame([(unit_id,)], "start_id string")
        reached = graph.closure(links.select(F.col("parent_unit_id").alias("start_node_id"), F.col("unit_id").alias("end_node_id")), start)
        return reached.select(F.col("node_id").alias("unit_id"))

    def unit_content(self, unit_id: str) -> DataFrame:
        return self.index.table("passages").where(F.col("unit_id") == unit_id).orderBy(F.col("sort_order").asc_nulls_first(), "passage_id")

    def structural_unit(self, document_ref: str, unit_ref: str, include_descendants: bool = True, max_passages: int = 10, max_chars: int = 6000) -> DataFrame:
        """(passage_id, unit_id, legal_citation, text, place, matching, truncated): the passages of a unit up to a budget.

        ``matching``: the passage's citation has the level below the unit that was asked for. The first passage that exceeds
        the budget ends the list; if that is the very first, the outcome is no_text.
        """
        max_passages, max_chars = clamp(max_passages, 1, 20), clamp(max_chars, 500, 12_000)
        document = self.resolve_document(document_ref)
        unit = self.resolve_unit(document.document_id, unit_ref)
        spark = self.index.spark
        above = spark.range(1).select(N.unit_part(F.lit(unit_ref.strip()))).first()[0]
        part = key(unit_ref.strip()[len(above) :])
        chosen = spark.createDataFrame([(unit,)], "unit_id string")
        if include_descendants:
            chosen = chosen.unionByName(self._below(document.document_id, unit)).distinct()
        rows = self.index.table("passages").join(chosen, "unit_id", "left_semi")
        out = self._within(rows, [F.col("sort_order").asc_nulls_first(), F.col("passage_id")], max_chars, max_passages)
        out = out.withColumn("matching", F.lit(bool(part)) & F.coalesce(N.key(F.col("legal_citation")).contains(part), F.lit(False)))
        out = out.select("passage_id", "unit_id", "legal_citation", "text", "place", "matching", "truncated")
        if out.where("trim(text) <> ''").isEmpty():
            raise Outcome("no_text", out)
        return out

    def _within(self, rows: DataFrame, order: list[Column], max_chars: int, max_rows: int | None = None) -> DataFrame:
        sized = lookup.numbered(rows.withColumn("_size", F.char_length("text")), order, "place").withColumn("_all", F.lit(0))
        kept = segments.within_budget(sized, ["_all"], ["place"], "_size", max_chars, max_rows or 2**31 - 1)
        counts = sized.agg(F.count(F.lit(1)).alias("_n")).crossJoin(kept.agg(F.count(F.lit(1)).alias("_k")))
        return kept.crossJoin(F.broadcast(counts)).withColumn("truncated", F.col("_k") < F.col("_n")).drop("_n", "_k", "_size", "_all")  # one row

    # -- passages --

    def search_corpus(self, query: str, corpus: str | None = None, document_ref: str | None = None, limit: int = 5, snippet_chars: int = 900, mode: str = "auto") -> tuple[DataFrame, list[str]]:
        """(passage_id, document_id, legal_citation, snippet, score, rank) and warnings.

        Semantic and hybrid search look at min(50, 3 limit) candidates of each kind; hybrid falls back to lexical search, with a
        warning, where there are no vectors. An unknown document gives nothing.
        """
        if mode not in MODES:
            raise Outcome(f"mode must be one of {', '.join(MODES)}")
        limit, snippet_chars, warnings = clamp(limit, 1, 8), clamp(snippet_chars, 200, 1000), []
        scope = {"source_kind": corpus_name(corpus), "document_id": None}
        if document_ref:
            try:
                scope["document_id"] = self.resolve_document(document_ref, corpus).document_id
            except Outcome:
                return self.index.spark.createDataFrame([], "passage_id string, document_id string, legal_citation string, snippet string, score double, rank int"), ["document_not_found"]
        usable = self.vectors is not None and self.embed is not None
        if mode == "semantic" and not usable:
            raise Outcome("vectors are not available")
        if mode == "hybrid" and not usable:
            mode, warnings = "lexical", ["lexical_fallback"]
        depth = limit if mode in ("auto", "lexical") else min(50, 3 * limit)
        ranked = []
        if mode != "semantic":
            ranked.append(self.index.search("passages", query, scope, depth).select("item_id", "score", "rank"))
        if mode in ("semantic", "hybrid"):
            ranked.append(self._nearest(self.embed(query), scope, depth))
        if mode == "hybrid":
            both = ranked[0].unionByName(ranked[1])
            fused = both.groupBy("item_id").agg(F.round(F.sum(1.0 / (FUSION + F.col("rank"))), 9).alias("score")).orderBy(F.col("score").desc(), "item_id").limit(limit)
            best = lookup.numbered(fused, [F.col("score").desc(), F.col("item_id")])
        else:
            best = ranked[0].where(F.col("rank") <= limit)
        hits = best.withColumnRenamed("item_id", "passage_id").join(self.index.table("passages"), "passage_id")
        terms = sorted({t.lower() for t in query.split()})
        return hits.select("passage_id", "document_id", "legal_citation", N.snippet(F.col("text"), terms, snippet_chars).alias("snippet"), "score", "rank").orderBy("rank"), warnings

    def _nearest(self, vector: list[float], scope: dict[str, str | None], depth: int) -> DataFrame:
        passages = self.index.table("passages").select("passage_id", "document_id")
        if scope.get("document_id"):
            passages = passages.where(F.col("document_id") == scope["document_id"])
        if scope.get("source_kind"):
            passages = passages.join(self.index.table("documents").where(F.col("source_kind") == scope["source_kind"]).select("document_id"), "document_id", "left_semi")
        given = F.array(*[F.lit(float(x)) for x in vector])
        scored = self.vectors.join(passages, "passage_id", "left_semi").select(F.col("passage_id").alias("item_id"), F.round(N.dot(F.col("vector"), given), 9).alias("score"))
        return lookup.numbered(scored.orderBy(F.col("score").desc(), "item_id").limit(depth), [F.col("score").desc(), F.col("item_id")])

    def context(self, passage_ids: list[str], before: int = 1, after: int = 1, max_chars: int = 12_000) -> DataFrame:
        """(passage_id, document_id, sort_order, text, place, truncated): what stands around up to five passages, each once, up to a budget."""
        if not passage_ids:
            raise Outcome("passage_ids must not be empty")
        before, after, max_chars = clamp(before, 0, 2), clamp(after, 0, 2), clamp(max_chars, 500, 20_000)
        passages = self.index.table("passages")
        hits = passages.where(F.col("passage_id").isin(list(passage_ids)[:5])).select("document_id", "sort_order")
        around = segments.neighbours(hits, passages, "document_id", "sort_order", before, after)
        rows = self._within(around, [F.col("document_id"), F.col("sort_order"), F.col("passage_id")], max_chars)
        return rows.select("passage_id", "document_id", "sort_order", "text", "place", "truncated")

    # -- register and references --

    def search_register(self, query: str, category: str | None = None, limit: int = 5) -> DataFrame:
        """(id, title, match_rank, mentions, indexed_for_fulltext): the register's entries, and whether the index has their text."""
        if self.register is None:
            raise Outcome("external_register is not available")
        rows = self.register if category is None else self.register.where(F.col("category") == category)
        found = lookup.ranked_search(rows, "id", "title", "graph_mention_count", query, clamp(limit, 1, 8))
        known = self.index.table("documents").select(F.explode(F.array("document_id", "document_key")).alias("id")).distinct().withColumn("_i", F.lit(True))
        return found.join(known, "id", "left").withColumn("indexed_for_fulltext", F.col("_i").isNotNull()).drop("_i")

    def references(self, node_id: str, direction: str = "outgoing", limit: int = 30) -> DataFrame:
        """(source_node_id, target_node_id, neighbor_node_id, n): the edges at a node with their true direction, in order of neighbour."""
        if self.edges is None:
            raise Outcome("neo4j is not available")
        if direction not in ("outgoing", "incoming", "both"):
            raise Outcome("direction must be outgoing, incoming or both")
        out = self.edges.where(F.col("start_node_id") == node_id).withColumn("neighbor_node_id", F.col("end_node_id"))
        back = self.edges.where(F.col("end_node_id") == node_id).withColumn("neighbor_node_id", F.col("start_node_id"))
        rows = {"outgoing": out, "incoming": back, "both": out.unionByName(back)}[direction]
        counted = rows.groupBy(F.col("start_node_id").alias("source_node_id"), F.col("end_node_id").alias("target_node_id"), "neighbor_node_id").agg(F.count(F.lit(1)).alias("n"))
        return counted.orderBy("neighbor_node_id", "source_node_id", "target_node_id").limit(clamp(limit, 1, 50))


def payload(rows: DataFrame, detail: str = "compact") -> list[dict]:
    """A tool's rows, which its limits bound, as they are sent: compact ones without nulls, blanks, scores and internal ids."""
    internal = {"score", "place", "sort_order", "sequence", "rank", "item_id"}
    out = [r.asDict(recursive=True) for r in rows.collect()]
    if detail == "full":
        return out
    return [payloads.without_blanks({k: v for k, v in r.items() if k not in internal}) for r in out]


def answer(tool: Callable[[], DataFrame]) -> dict:
    """{ok, count, results} of a tool, or {ok: false, status} with the outcome that it ended in."""
    try:
        results = payload(tool())
    except Outcome as e:
        return {"ok": False, "status": str(e)}
    return {"ok": True, "count": len(results), "results": results}
