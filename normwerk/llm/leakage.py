"""Held-out evaluation passages that stand in a corpus.

Winnowing: of every run of WINDOW consecutive k-grams the one with the smallest hash is kept, so any span of
K + WINDOW - 1 words that two texts share has a fingerprint in common. Fingerprints of corpus and items are joined, and each
hit is extended word by word in both directions; a pair counts if an extended hit reaches ``min_words``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..durable import materialize
from ..skew import SAMPLED, salted_left_join
from . import characters as ch

#: Most item fingerprints that are broadcast (24 bytes each); beyond, the fingerprints are joined by shuffle with salts.
MOST_BROADCAST = 2_000_000
#: Most documents with hits whose ids are broadcast to the corpus to fetch their texts.
MOST_IDS = 4_000_000

_WORD = re.compile(r"[^\W_]+")
#: A word broken at a line's end.
_BROKEN = re.compile(r"(?<=[^\W\d_])[-­‐‑]­?[^\S\n]*\r?\n\s*(?=[^\W\d_])")


def words(text: str) -> list[str]:
    """The text's runs of letters and digits, irrespective of letter case, line-end hyphens and character forms."""
    if "\n" in text:
        text = _BROKEN.sub("", text)
    return _WORD.findall(ch.fold_look_alikes(text).casefold())


def _hashes(tokens: list[str], cache: dict[str, int]) -> np.ndarray:
    out = np.empty(len(tokens), np.uint64)
    for i, w in enumerate(tokens):
        h = cache.get(w)
        if h is None:
            if len(cache) > 500_000:
                cache.clear()
            h = cache[w] = xxhash.xxh3_64_intdigest(w)
        out[i] = h
    return out


def fingerprints_of(hashes: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprints, positions): the rightmost smallest k-gram hash of each window; a short text is one window."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    grams = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            grams = (grams * np.uint64(0x9E3779B97F4A7C15)) ^ hashes[j : j + n]
            grams ^= grams >> np.uint64(29)
        grams *= np.uint64(0xBF58476D1CE4E5B9)
        grams ^= grams >> np.uint64(32)
    w = min(window, n)
    views = np.lib.stride_tricks.sliding_window_view(grams, w)
    best = np.arange(len(views)) + (w - 1 - np.argmin(views[:, ::-1], axis=1))
    at = np.unique(best)
    return grams[at].view(np.int64), at.astype(np.int32)


def _fingerprint(k: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, int] = {}
        for batch in batches:
            ids, prints, places, held = [], [], [], 0

            def out() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (ids, prints, places)], ["id", "fingerprint", "position"])

            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                f, at = fingerprints_of(_hashes(words(text), cache), k, window)
                if len(f):
                    ids.append(np.full(len(f), key, np.int64))
                    prints.append(f)
                    places.append(at)
                    held += len(f)
                    if held > 200_000:
                        yield out()
                        ids, prints, places, held = [], [], [], 0
            if held:
                yield out()

    return run


def fingerprint(texts: DataFrame, id_column: str, k: int, window: int) -> DataFrame:
    """(id, fingerprint, position) of each text; null ids and null texts have none."""
    chosen = texts.select(F.col(id_column).cast("bigint").alias("id"), F.col("text").cast("string").alias("text")).where("id is not null and text is not null and text <> ''")
    return chosen.mapInArrow(_fingerprint(k, window), "id bigint, fingerprint bigint, position int")


def gram_places(tokens: list[str], k: int) -> dict[tuple[str, ...], list[int]]:
    """Where each run of k words stands."""
    out: dict[tuple[str, ...], list[int]] = {}
    for i in range(len(tokens) - k + 1):
        out.setdefault(tuple(tokens[i : i + k]), []).append(i)
    return out


def extend(doc: list[str], item: list[str], hits: list[tuple[int, int]], k: int) -> tuple[int, int, int]:
    """(length, position in the document, position in the item) of the longest run of equal words around any hit."""
    best, reached = (0, 0, 0), {}
    for d, i in sorted(hits):
        # hits of one diagonal come in order, so the end of the last run on it says whether this one is inside
        if d < reached.get(d - i, -1) or doc[d : d + k] != item[i : i + k]:
            continue
        a, b = 0, k
        while d - a > 0 and i - a > 0 and doc[d - a - 1] == item[i - a - 1]:
            a += 1
        while d + b < len(doc) and i + b < len(item) and doc[d + b] == item[i + b]:
            b += 1
        reached[d - i] = d + b
        best = max(best, (a + b, d - a, i - a))
    return best


def _extend(k: int, min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: dict[str, tuple[list[str], dict]] = {}
        for batch in batches:
            out = []
            for doc_id, text, found in zip(*(batch.column(c).to_pylist() for c in range(3))):
                doc = words(text)
                for hit in found:
                    if hit["text"] not in items:
                        if len(items) > 2000:
                            items.clear()
                        tokens = words(hit["text"])
                        items[hit["text"]] = (tokens, gram_places(tokens, k))
                    item, places = items[hit["text"]]
                    n, d, i = extend(doc, item, [(p, q) for p in hit["positions"] for q in places.get(tuple(doc[p : p + k]), ())], k)
                    if n >= min_words:
                        out.append((doc_id, hit["item_id"], n, d, i, n / len(item)))
            columns = list(zip(*out)) or [()] * 6
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], ["doc_id", "item_id", "n_words", "doc_position", "item_position", "item_share"])

    return run


def leaks(documents: DataFrame, items: DataFrame, min_words: int = 10, k: int = 7) -> DataFrame:
    """documents(doc_id, text), items(item_id, text) -> (doc_id, item_id, n_words, doc_position, item_position, item_share).

    One row for each document and item that share ``min_words`` or more words in a row, with the longest such run. Texts
    of any length are taken whole; null and empty texts leak nothing; repeated rows of an id count once, so an id must
    stand for one text (of several, the greatest counts). Of equally long runs the last in the document is given.
    """
    if k > min_words:
        raise ValueError("k must not exceed min_words")
    window = min_words - k + 1
    distinct_items = materialize(items.where("item_id is not null and text is not null").groupBy("item_id").agg(F.max("text").alias("text")), "items")
    asked = materialize(fingerprint(distinct_items, "item_id", k, window).select(F.col("id").alias("item_id"), "fingerprint").distinct(), "item_prints")
    prints = lambda df: fingerprint(df, "doc_id", k, window).toDF("doc_id", "fingerprint", "doc_position")
    corpus = prints(documents)
    if asked.count() <= MOST_BROADCAST:
        hits = corpus.join(F.broadcast(asked), "fingerprint")
    else:
        hits = salted_left_join(corpus, asked, ["fingerprint"], [F.col("doc_id")], how="inner", counted=prints(documents.sample(SAMPLED, 7)).select("fingerprint"))
    pairs = hits.groupBy("doc_id", "item_id").agg(F.collect_set("doc_position").alias("positions"))  # at most a document's fingerprints
    items_of = F.collect_list(F.struct("item_id", "text", "positions"))  # at most a document's fingerprints, too
    by_document = materialize(pairs.join(distinct_items, "item_id").groupBy("doc_id").agg(items_of.alias("found")), "pairs")
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("text is not null")
    ids = by_document.select("doc_id")
    few = F.broadcast(ids) if ids.count() <= MOST_IDS else ids
    found = docs.join(few, "doc_id", "left_semi").groupBy("doc_id").agg(F.max("text").alias("text"))
    whole = found.join(by_document, "doc_id")
    return whole.select("doc_id", "text", "found").mapInArrow(_extend(k, min_words), "doc_id bigint, item_id bigint, n_words int, doc_position int, item_position int, item_share double")
