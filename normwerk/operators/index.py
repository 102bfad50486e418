"""A stored retrieval index: documents, units and passages with their aliases, and one table of postings.

Postings lie in folders by a hash of their term, so that a search opens the folders of its own terms only, whatever the size
of the corpus. Lengths stand with the postings, document frequencies and totals in small tables of their own.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..sources import sinks
from .fulltext import K1, B

#: Folders of postings.
BUCKETS = 64
# Names by which a corpus may be asked for.
CORPORA = {"de": "gii", "german": "gii", "eu": "eurlex", "external": "external_pdf"}
_TERM = re.compile("[0-9A-Za-zÄÖÜäöüß]+")


def key(text: str) -> str:
    """``normalize.key`` of a text on the driver."""
    return re.sub("[^0-9a-z]", "", text.casefold())


def terms_of(query: str) -> dict[str, int]:
    """Terms as the index has them, and how often each counts: spellings that differ in letter case only count each."""
    out: dict[str, int] = {}
    fold = str.maketrans(N.ACCENTED, N.UNACCENTED)
    for t in dict.fromkeys(_TERM.findall(query)):
        plain = t.lower().translate(fold)
        out[plain] = out.get(plain, 0) + 1
    return out


def corpus_name(corpus: str | None) -> str | None:
    """The source kind that a corpus' name stands for; other names stand for themselves."""
    return None if corpus is None else CORPORA.get(corpus.strip().casefold(), corpus.strip())


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def postings(items: DataFrame) -> DataFrame:
    """items(space, item_id, document_id, text) -> (space, bucket, term, item_id, document_id, tf, dl)."""
    bag = items.withColumn("t", F.coalesce(N.tokens(F.col("text")), F.array().cast("array<string>"))).select("space", "item_id", "document_id", F.size("t").alias("dl"), F.explode("t").alias("term"))
    counted = bag.groupBy("space", "item_id", "document_id", "dl", "term").agg(F.count(F.lit(1)).cast("int").alias("tf"))
    return counted.select("space", _bucket(F.col("term")).alias("bucket"), "term", "item_id", "document_id", "tf", "dl")


def unit_alias_rows(units: DataFrame) -> DataFrame:
    """(unit_id, document_id, normalized_alias) of every spelling by which a unit is asked for."""
    spelled = F.concat(F.array("label", "legal_citation", "global_key"), N.unit_aliases(F.col("unit_type"), F.col("number")))
    each = units.select("unit_id", "document_id", F.explode(spelled).alias("alias")).select("unit_id", "document_id", N.key(F.col("alias")).alias("normalized_alias"))
    return each.where("normalized_alias <> ''").distinct()


def build(documents: DataFrame, aliases: DataFrame, units: DataFrame, passages: DataFrame, path: str) -> "Index":
    """Write an index and point to it.

    documents(document_id, document_key, title, source_kind, ...), aliases(document_id, alias), units(unit_id, document_id,
    parent_unit_id, global_key, unit_type, label, number, title, legal_citation, sequence), passages(passage_id, document_id,
    unit_id, title, legal_citation, text, sort_order). The first document of an id counts.
    """
    named = aliases.select("document_id", "alias", N.key(F.col("alias")).alias("normalized_alias")).where("normalized_alias <> ''").distinct()
    items = (
        named.select(F.lit("documents").alias("space"), F.concat_ws("\0", "document_id", "alias").alias("item_id"), "document_id", F.col("alias").alias("text"))
        .unionByName(units.select(F.lit("units").alias("space"), F.col("unit_id").alias("item_id"), "document_id", F.concat_ws(" ", "label", "title", "legal_citation").alias("text")))
        .unionByName(passages.select(F.lit("passages").alias("space"), F.col("passage_id").alias("item_id"), "document_id", F.concat_ws(" ", "text", "title", "legal_citation").alias("text")))
    )
    posted = postings(items)
    totals = items.select("space", F.size(F.coalesce(N.tokens(F.col("text")), F.array().cast("array<string>"))).alias("dl")).groupBy("space").agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avg_dl"))
    tables = {
        "documents": documents, "document_aliases": named, "units": units, "unit_aliases": unit_alias_rows(units), "passages": passages,
        "postings": posted, "terms": posted.groupBy("space", "bucket", "term").agg(F.count(F.lit(1)).alias("df")), "totals": totals,
    }
    sinks.publish(tables, path, {"postings": ["space", "bucket"], "terms": ["space", "bucket"]})
    return Index(documents.sparkSession, path)


class Index:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def table(self, name: str) -> DataFrame:
        return sinks.current(self.spark, self.path, name)

    def search(self, space: str, query: str, scope: dict[str, str | None] | None = None, limit: int = 10, per: str = "item_id", mode: str = "auto") -> DataFrame:
        """(item_id, document_id, score, rank, relation): the best items by BM25, lower is better, ties by id.

        All terms must be there, or, in mode ``auto`` and only if nothing inside the scope has all, any. ``scope`` may name a
        document_id and a source_kind. ``per`` document_id keeps the best item of each document.
        """
        terms = terms_of(query)
        empty = "item_id string, document_id string, score double, rank int, relation string"
        if not terms:
            return self.spark.createDataFrame([], empty)
        folders = [r.b for r in self.spark.range(1).select(F.explode(F.array(*[_bucket(F.lit(t)) for t in terms])).alias("b")).distinct().collect()]
        here = (F.col("space") == space) & F.col("bucket").isin(folders) & F.col("term").isin(list(terms))
        total = self.table("totals").where(F.col("space") == space).first()  # one row
        known = {r.term: r.df for r in self.table("terms").where(here).collect()}  # a row a term of the query
        if total is None or not known:
            return self.spark.createDataFrame([], empty)
        hits = self.table("postings").where(here)
        scope = {k: v for k, v in (scope or {}).items() if v is not None}
        if "document_id" in scope:
            hits = hits.where(F.col("document_id") == scope["document_id"])
        if "source_kind" in scope:
            hits = hits.join(self.table("documents").where(F.col("source_kind") == scope["source_kind"]).select("document_id"), "document_id", "left_semi")
        weight = F.lit(0.0)
        for t, times in terms.items():
            if t in known:
                idf = F.log((F.lit(total.n) - known[t] + 0.5) / F.lit(known[t] + 0.5))
                weight = F.when(F.col("term") == t, times * F.when(idf <= 0, F.lit(1e-6)).otherwise(idf)).otherwise(weight)
        tf = F.col("tf").cast("double")
        part = weight * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("dl") / total.avg_dl))
        scored = hits.groupBy("item_id", "document_id").agg((-F.round(F.sum(part), 6)).alias("score"), (F.count(F.lit(1)) == len(terms)).alias("all"))
        if mode == "and":
            scored = scored.where("all")
        elif mode == "auto":
            scored = scored.crossJoin(F.broadcast(scored.agg(F.max("all").alias("some")))).where("all or not some")  # one row
        if per == "document_id":
            scored = scored.groupBy("document_id").agg(F.min(F.struct("score", "item_id", "all")).alias("b")).select("b.item_id", "document_id", "b.score", "b.all")
        best = scored.orderBy("score", "item_id").limit(limit)
        return best.select("item_id", "document_id", "score", F.row_number().over(Window.orderBy("score", "item_id")).alias("rank"), F.when(F.col("all"), "and").otherwise("or").alias("relation"))
