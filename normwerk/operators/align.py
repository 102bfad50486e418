"""Aligning items of one source with pages of another: rare words and 3-grams propose pages, a score ranks them, an
order-keeping path picks, and the items' last words tell where they end."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..durable import materialize
from ..functions import forms

#: Words by which an item looks for pages, pages that are scored, pages that are kept.
RAREST, POOL, KEPT = 12, 48, 8
#: Tokens of an item's beginning and end, and of the phrase that it is known by.
ANCHOR, PHRASE = 56, 8
#: Score taken off for each page that the path jumps; least lead of the best page over any that is not next to it.
JUMP, GAP = 0.0008, 0.045
# Weights of the score's parts and what is taken off for a table of contents.
WEIGHTS = {"coverage": 0.52, "grams": 0.18, "strength": 0.12, "phrase": 0.15, "label": 0.025, "title": 0.015}
CONTENTS, LIKE_CONTENTS = 0.24, 0.14


def _grams(tokens: Column) -> Column:
    # the tokens beside themselves, moved by one and by two: none is worked out inside of a lambda
    three = F.arrays_zip(tokens.alias("a"), F.slice(tokens, F.lit(2), F.greatest(F.lit(1), F.size(tokens))).alias("b"), F.slice(tokens, F.lit(3), F.greatest(F.lit(1), F.size(tokens))).alias("c"))
    whole = F.filter(three, lambda x: x["c"].isNotNull())
    return F.array_distinct(F.transform(whole, lambda x: F.concat_ws(" ", x["a"], x["b"], x["c"])))


def item_features(items: DataFrame) -> DataFrame:
    """items(document_id, item_id, place, text, label, title) -> words, grams and phrase of the beginning, words of the end.

    An item without two different words means nothing that could be found.
    """
    tokens = forms.alignment_tokens(F.col("text"))
    t = items.select("*", F.explode(F.array(tokens)).alias("_t"))  # one row a row; behind a generator the tokens are worked out once
    head, tail = F.slice("_t", F.lit(1), F.lit(ANCHOR)), F.slice("_t", F.greatest(F.lit(1), F.size("_t") - ANCHOR + 1), F.lit(ANCHOR))
    out = t.select(
        "document_id", "item_id", "place", F.array_distinct(head).alias("words"), _grams(head).alias("grams"), F.array_join(F.slice("_t", F.lit(1), F.lit(PHRASE)), " ").alias("phrase"), F.array_distinct(tail).alias("tail"),
        F.array_join(forms.alignment_tokens(F.col("label")), " ").alias("label"), F.array_join(forms.alignment_tokens(F.col("title")), " ").alias("title"),
    )
    return out.where("size(words) > 1")


def page_features(pages: DataFrame) -> DataFrame:
    """pages(document_id, page, text) -> words, grams, running text, and what is taken off if the page is a table of contents."""
    tokens = forms.alignment_tokens(F.col("text"))
    leaders = F.regexp_count("text", F.lit(r"(?m)(?:\.{3,}|\u2026)\s*\d+\s*$"))
    penalty = F.when(leaders >= 5, CONTENTS).when(F.col("text").rlike("(?i)inhalts(?:übersicht|verzeichnis)|table of contents"), LIKE_CONTENTS).otherwise(0.0)
    t = pages.select("*", F.explode(F.array(tokens)).alias("_t")).where("size(_t) > 0")
    return t.select("document_id", "page", F.array_distinct("_t").alias("words"), _grams(F.col("_t")).alias("grams"), F.array_join("_t", " ").alias("running"), penalty.alias("penalty"))


def candidates(items: DataFrame, pages: DataFrame) -> DataFrame:
    """items(document_id, item_id, words, grams), pages(document_id, page, words, grams) -> (document_id, item_id, page, votes).

    Each item's rarest words (by the pages of its document that have them) and all its 3-grams vote for pages by their
    rarity; the POOL best are kept. Words that no page has, or only one of many pages lacks, weigh next to nothing.
    """
    n_pages = pages.groupBy("document_id").agg(F.countDistinct("page").alias("n"))

    def votes(column: str, most: int | None) -> DataFrame:
        postings = pages.select("document_id", "page", F.explode(column).alias("word"))
        df = postings.groupBy("document_id", "word").agg(F.count(F.lit(1)).alias("df")).join(n_pages, "document_id")
        weight = df.select("document_id", "word", (F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1).alias("w"))
        asked = items.select("document_id", "item_id", F.explode(column).alias("word")).join(weight, ["document_id", "word"])
        if most is not None:
            asked = asked.withColumn("_n", F.row_number().over(Window.partitionBy("document_id", "item_id").orderBy(F.col("w").desc(), "word"))).where(F.col("_n") <= most)
        return asked.join(postings, ["document_id", "word"]).select("document_id", "item_id", "page", "w")

    every = votes("words", RAREST).unionByName(votes("grams", None)).groupBy("document_id", "item_id", "page").agg(F.round(F.sum("w"), 6).alias("votes"))
    best = Window.partitionBy("document_id", "item_id").orderBy(F.col("votes").desc(), "page")
    return every.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= POOL).drop("_n")


def threshold(n_words: Column) -> Column:
    """Least score of an item by its number of distinct words: the fewer, the stricter, but for one or two words."""
    return F.when(n_words >= 20, 0.43).when(n_words >= 8, 0.49).when(n_words <= 2, 0.50).otherwise(0.56)


def score() -> Column:
    """The score of an item (words, grams, phrase, label, title) on a page (pw, pg, running, penalty), from 0 to 1."""
    share = lambda a, b: F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a)).otherwise(0.0)
    there = lambda c: F.when((F.col(c) != "") & F.col("running").contains(F.col(c)), 1.0).otherwise(0.0)
    parts = {"coverage": share("words", "pw"), "grams": share("grams", "pg"), "strength": F.least(F.lit(1.0), F.size("words") / 20.0), "phrase": there("phrase"), "label": there("label"), "title": there("title")}
    total = F.lit(0.0)
    for name, part in parts.items():
        total = total + WEIGHTS[name] * part
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total - F.col("penalty"))), 6)


def scored(pairs: DataFrame, items: DataFrame, pages: DataFrame) -> DataFrame:
    """(document_id, item_id, page, score, ambiguous): the KEPT best pages of each item that reach its threshold. An item is
    ambiguous if the best page leads by less than GAP over one that is not next to it."""
    p = pages.select("document_id", "page", F.col("words").alias("pw"), F.col("grams").alias("pg"), "running", "penalty")
    both = pairs.join(items.drop("place", "tail"), ["document_id", "item_id"]).join(p, ["document_id", "page"])
    good = both.select("document_id", "item_id", "page", score().alias("score"), F.size("words").alias("n_words")).where(F.col("score") >= threshold(F.col("n_words")))
    by = Window.partitionBy("document_id", "item_id")
    best = by.orderBy(F.col("score").desc(), "page")
    kept = good.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= KEPT)
    first = F.first(F.struct("score", "page")).over(best.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    kept = kept.withColumn("_f", first).withColumn("_r", (F.abs(F.col("page") - F.col("_f.page")) > 1) & (F.col("_f.score") - F.col("score") < GAP))
    return kept.withColumn("ambiguous", F.coalesce(F.bool_or("_r").over(by), F.lit(False))).select("document_id", "item_id", "page", "score", "ambiguous")


class _Best:
    """The greatest value at or below a place, as values are added: a tree of running maxima."""

    def __init__(self, n: int):
        self.tree: list[tuple[float, int] | None] = [None] * (n + 1)

    def add(self, place: int, value: tuple[float, int]) -> None:
        while place < len(self.tree):
            if self.tree[place] is None or value > self.tree[place]:
                self.tree[place] = value
            place += place & -place

    def upto(self, place: int) -> tuple[float, int] | None:
        best = None
        while place > 0:
            if self.tree[place] is not None and (best is None or self.tree[place] > best):
                best = self.tree[place]
            place -= place & -place
        return best


def monotone(items: list[list[tuple[int, float]]], jump: float = JUMP) -> list[tuple[int, float] | None]:
    """For items in order, each with (page, score) choices, the choices of the greatest total score whose pages never go back.

    A jump over pages costs ``jump`` a page; an item may stay without a page.
    """
    pages = sorted({p for choices in items for p, _ in choices})
    ends = _Best(len(pages))
    steps: list[tuple[int, int, float, int | None]] = []  # (item, page, score, step before)
    best: tuple[float, int, int] | None = None
    for n, choices in enumerate(items):
        new = []
        for page, value in choices:
            place = bisect_right(pages, page)
            before = ends.upto(place)  # totals are held with jump * page added, so a jump is a difference of two ends
            gain = before[0] - jump * page if before else 0.0
            total = value + max(gain, 0.0)
            steps.append((n, page, value, -before[1] if before and gain > 0 else None))
            new.append((place, (total + jump * page, -(len(steps) - 1))))
            if best is None or (total, -page) > best[:2]:
                best = (total, -page, len(steps) - 1)
        for place, value in new:
            ends.add(place, value)
    out: list[tuple[int, float] | None] = [None] * len(items)
    at = best[2] if best else None
    while at is not None:
        n, page, value, at = steps[at]
        out[n] = (page, value)
    return out


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for document, items in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            path = monotone([[(c["page"], c["score"]) for c in i["choices"]] for i in items])
            out += [(document, i["item_id"], p[0], p[1]) for i, p in zip(items, path) if p]
        columns = list(zip(*out)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.string(), pa.int32(), pa.float64()))], ["document_id", "item_id", "page", "score"])


def end_pages(starts: DataFrame, items: DataFrame, pages: DataFrame) -> DataFrame:
    """starts(document_id, item_id, page, score, next_page) with ``end_page`` and ``confidence``: the last page, no farther than
    the next item's first, that has most of the item's last words, if it has half of them; else the first page."""
    reach = starts.join(items.select("document_id", "item_id", "tail"), ["document_id", "item_id"])
    span = reach.withColumn("_p", F.explode(F.sequence(F.col("page"), F.greatest(F.col("page"), F.coalesce("next_page", F.col("page"))))))
    held = span.join(pages.select("document_id", F.col("page").alias("_p"), F.col("words").alias("pw")), ["document_id", "_p"])
    share = F.size(F.array_intersect("tail", "pw")) / F.size("tail")
    best = held.select("document_id", "item_id", "_p", F.round(share, 6).alias("_s")).where("_s >= 0.5").groupBy("document_id", "item_id").agg(F.max(F.struct("_s", "_p")).alias("b"))
    out = starts.join(best, ["document_id", "item_id"], "left")
    confidence = F.round(F.when(F.col("b").isNotNull(), 0.7 * F.col("score") + 0.3 * F.col("b._s")).otherwise(F.col("score")), 6)
    return out.select("document_id", "item_id", "page", F.coalesce("b._p", "page").alias("end_page"), "score", confidence.alias("confidence"))


def align(items: DataFrame, pages: DataFrame) -> DataFrame:
    """items(document_id, item_id, place, text, label, title), pages(document_id, page, text) -> (document_id, item_id, page,
    end_page, score, confidence, issue), one row an item that has words.

    Documents are independent; one document's items and their few choices are one row of the path search. An item without a
    page has an issue: ``no_page``, ``ambiguous`` (several pages are as good), or ``out_of_order`` (its pages lie behind others').
    """
    i, p = materialize(item_features(items), "items"), materialize(page_features(pages.withColumn("page", F.col("page").cast("int"))), "pages")
    kept = scored(candidates(i, p), i, p)
    clear = kept.where("not ambiguous").drop("ambiguous")
    choices = clear.groupBy("document_id", "item_id").agg(F.array_sort(F.collect_list(F.struct("page", "score"))).alias("choices"))
    ordered = choices.join(i.select("document_id", "item_id", "place"), ["document_id", "item_id"]).groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct("place", "item_id", "choices"))).alias("items"))
    paths = ordered.mapInArrow(_paths, "document_id string, item_id string, page int, score double")
    by = Window.partitionBy("document_id").orderBy("place")
    starts = paths.join(i.select("document_id", "item_id", "place"), ["document_id", "item_id"]).withColumn("next_page", F.lead("page").over(by)).drop("place")
    found = end_pages(starts, i, p)
    seen = kept.groupBy("document_id", "item_id").agg(F.bool_or("ambiguous").alias("_a"))
    every = i.select("document_id", "item_id").join(found, ["document_id", "item_id"], "left").join(seen, ["document_id", "item_id"], "left")
    issue = F.when(F.col("page").isNotNull(), F.lit(None).cast("string")).when(F.col("_a").isNull(), "no_page").when(F.col("_a"), "ambiguous").otherwise("out_of_order")
    return every.select("document_id", "item_id", "page", "end_page", "score", "confidence", issue.alias("issue"))
