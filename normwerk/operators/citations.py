"""Citations in text: mentions with their spans, the keys they target, and what the keys resolve to."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Widest numeric range that is expanded; of a wider one only the ends are targets.
MOST_EXPANDED = 25

_KIND = {"§": "para", "§§": "para", "art": "art", "artikel": "art", "article": "art", "anlage": "anlage", "anhang": "anhang", "annex": "anhang"}
_NUM = r"\d+[a-z]?(?![\w/])"
_LEVEL = r"(?:Abs\.|Absatz|Satz|Nr\.|Nummer|Buchst\.|Buchstabe|lit\.)"
_SUB = rf"(?:\s+{_LEVEL}\s*(?:\d+[a-z]?|[a-z]\b))"
_AND = r"\s*(?:,|und|oder|sowie|bis|–|-)\s*"
_ITEM = rf"{_NUM}{_SUB}*(?:{_AND}(?:{_LEVEL}\s*)?(?:{_NUM}){_SUB}*)*"
MENTION = re.compile(rf"(?P<kind>§§?|\b(?:Artikel|Art\.|Article|Anlage|Anhang|Annex)(?!\w))\s*(?P<list>{_ITEM})")
_PART = re.compile(rf"(?P<join>,|und|oder|sowie|bis|–|-)|(?P<level>{_LEVEL})\s*(?P<at>\d+[a-z]?|[a-z]\b)|(?P<num>\d+[a-z]?)")
_SHORT = {"abs.": "abs", "absatz": "abs", "satz": "satz", "nr.": "nr", "nummer": "nr", "buchst.": "buchst", "buchstabe": "buchst", "lit.": "buchst"}


def _span(a: str, b: str) -> list[str]:
    if a.isdigit() and b.isdigit() and 0 < int(b) - int(a) <= MOST_EXPANDED:
        return [str(n) for n in range(int(a) + 1, int(b) + 1)]
    return [b]


def target_keys(kind: str, items: str) -> list[str]:
    """Keys of a mention's list. Articles and annexes carry no lower level, paragraphs a subsection only.

    A number after a subsection goes on with subsections, until a lower level ends the list; ``bis`` makes a range.
    """
    base = _KIND[kind.strip().rstrip(".").lower()]
    out: list[str] = []
    number = sub = None
    in_subs = closed = False
    joined = ""
    for m in _PART.finditer(items):
        if m["join"]:
            joined = m["join"]
        elif m["level"]:
            level = _SHORT[m["level"].lower()]
            if level == "abs" and number is not None:
                if joined in ("bis", "–", "-") and sub is not None:
                    out += [f"{base}_{number}_abs_{n}" for n in _span(sub, m["at"])]
                elif base == "para":
                    if f"{base}_{number}" in out:
                        out.remove(f"{base}_{number}")
                    out.append(f"{base}_{number}_abs_{m['at']}")
                sub, in_subs, closed = m["at"], True, False
            else:
                closed = True
            joined = ""
        else:
            n = m["num"]
            if in_subs and not closed and joined:
                if base == "para":
                    out += [f"{base}_{number}_abs_{x}" for x in (_span(sub, n) if joined in ("bis", "–", "-") else [n])]
                sub = n
            elif closed and in_subs and joined:
                pass  # a number after a lower level goes on with that level
            else:
                out += [f"{base}_{x}" for x in (_span(number, n) if joined in ("bis", "–", "-") and number is not None else [n])]
                number, sub, in_subs, closed = n, None, False, False
            joined = ""
    return list(dict.fromkeys(out))


def mentions_in(text: str) -> list[tuple[int, int, str, list[str]]]:
    """(start, end, mention, keys) of each citation, from left to right, none overlapping."""
    return [(m.start(), m.end(), m.group(), target_keys(m["kind"], m["list"])) for m in MENTION.finditer(text)]


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [(key, a, b, mention, k) for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if text for a, b, mention, keys in mentions_in(text) for k in keys]
        types = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [()] * 5, types)], ["source_id", "char_start", "char_end", "mention_text", "target_key"])


def extract(texts: DataFrame, id_column: str, text: str) -> DataFrame:
    """(source_id, char_start, char_end, mention_text, target_key), one row a target. Null texts have none."""
    return texts.select(F.col(id_column).cast("string").alias("source_id"), F.col(text).alias("text")).where("text is not null").mapInArrow(_extract, "source_id string, char_start int, char_end int, mention_text string, target_key string")


def level_of(key: Column) -> Column:
    """The level that a key names, by its last part."""
    return (
        F.when(key.rlike(r"_buchst_[^_]+$"), "letter").when(key.rlike(r"_nr_[^_]+$"), "number").when(key.rlike(r"_satz_[^_]+$"), "sentence").when(key.rlike(r"_abs_[^_]+$"), "subsection").when(key.rlike(r"_tabelle_[^_]+$"), "table")
        .when(key.rlike(r"_para_[^_]+$"), "paragraph").when(key.rlike(r"_art_[^_]+$"), "article").when(key.rlike(r"_(?:anlage|anhang)_[^_]+$"), "annex").when(key.rlike(r"_gliederung_[^_]+$"), "division").otherwise("document")
    )


def modelled(key: Column) -> Column:
    """A key cut at the levels that are not modelled as targets: letters, numbers and sentences."""
    return F.regexp_replace(key, r"_(?:buchst|nr|satz)_.*$", "")


def without_overlaps(spans: DataFrame, group: str, start: str, end: str, priority: str) -> DataFrame:
    """Spans that no span of a better priority (smaller; then earlier, then longer) of the same group overlaps.

    Spans are put into the blocks of text they touch, so that only spans near to each other are compared.
    """
    block = 512
    rows = spans.withColumn("_id", F.struct(F.col(priority), F.col(start), -F.col(end)))
    touched = rows.select(group, "_id", F.col(start).alias("_s"), F.col(end).alias("_e"), F.explode(F.sequence(F.floor(F.col(start) / block), F.floor((F.col(end) - 1) / block))).alias("_b"))
    other = touched.select(group, "_b", F.col("_id").alias("_o"), F.col("_s").alias("_os"), F.col("_e").alias("_oe"))
    beaten = touched.join(other, [group, "_b"]).where((F.col("_o") < F.col("_id")) & (F.col("_os") < F.col("_e")) & (F.col("_s") < F.col("_oe"))).select(group, "_id").distinct()
    return rows.join(beaten, [group, "_id"], "left_anti").drop("_id")
