"""One consistent form of text that looks the same but is made of other characters.

Characters that always stand for a plain one (invisible ones, spaces, hyphens, full-width forms, ligatures, split accents)
are replaced first. Look-alikes of other scripts are repaired by token: its dominant script is determined, and letters of
other scripts are substituted only if the token mixes scripts (or is made of Latin look-alikes alone inside Latin text) and
the result exists in the vocabulary of the corpus. Tokens whose repair is not in the vocabulary stay and are reported.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..durable import materialize
from . import characters as ch

_SCANNED = "record_table string, record_key string, text string, plain string, odd_characters boolean, mixed array<struct<token:string,forms:array<string>,certain:boolean>>"


_REPAIRED = "record_table string, record_key string, text string, repaired string, odd_characters boolean, look_alikes int, unrepaired int"
#: Most suspect tokens that are broadcast to the words of the corpus (about 100 MB); beyond, both sides are shuffled.
MOST_BROADCAST = 1_000_000


def confusables(spark: SparkSession) -> dict[str, str]:
    """Characters that look like one plain letter, digit or hyphen, by the public list that comes with Spark's ICU; bounded by
    the number of characters. Without ICU the list is empty, and the fixed values alone are known."""
    chars = [chr(c) for c in range(0x80, 0x20000) if unicodedata.category(chr(c))[0] in "LNPS" and not 0xD800 <= c < 0xE000]
    try:
        checker = getattr(spark._jvm.com.ibm.icu.text, "SpoofChecker$Builder")().build()
        looks = checker.getSkeleton("\n".join(chars)).split("\n")
    except (TypeError, AttributeError, Py4JError):
        return {}
    if len(looks) != len(chars):
        return {}
    return {c: p for c, p in zip(chars, looks) if p != c and len(p) == 1 and (p.isascii() and (p.isalnum() or p == "-"))}


def candidates(token: str, text_script: str) -> list[str] | None:
    """Repairs of a token in order of preference: in its dominant script, in that of the text, in Latin.

    None: nothing in the token stands for another letter. An empty list: something does, but no script takes all of it.
    """
    kinds = ch.scripts(token)
    if len(kinds) > 1:
        forms = [ch.to_script(token, s) for s in (ch.dominant_script(token), text_script, "Latin")]
        found = list(dict.fromkeys(f for f in forms if f is not None))
        return found if found or any(c in ch.SAME_GLYPH or c in ch.EXTRA for c in token) else None
    if kinds and kinds != {"Latin"} and text_script == "Latin" and all(c in ch.SAME_GLYPH or c in ch.EXTRA for c in token if c.isalpha()):
        return [ch.to_latin(token)]
    return None


def _scan(confusable: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ch.extend(confusable)
        item = pa.struct([("token", pa.string()), ("forms", pa.list_(pa.string())), ("certain", pa.bool_())])
        for batch in batches:
            plain, odd, mixed = [], [], []
            for text in batch.column(2).to_pylist():
                if text is None or ch.is_plain(text):
                    plain.append(text)
                    odd.append(False)
                    mixed.append([])
                    continue
                form = ch.recompose(text)
                plain.append(form)
                odd.append(form != text)
                found = []
                if not ch.is_plain(form):
                    script = ch.dominant_script(form)
                    for m in ch.TOKEN.finditer(form):
                        forms = candidates(m.group(), script)
                        if forms is not None:
                            # letters of other Latin alphabets are look-alikes only where the plain word is known
                            found.append({"token": m.group(), "forms": forms, "certain": any(ch._block_script(c) not in ("", "Latin") for c in m.group())})
                mixed.append(found)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(plain, pa.string()), pa.array(odd), pa.array(mixed, pa.list_(item))], ["record_table", "record_key", "text", "plain", "odd_characters", "mixed"]
            )

    return run


def _mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        repaired, alike, left = [], [], []
        for plain, repairs in zip(batch.column(3).to_pylist(), batch.column(5).to_pylist()):
            by_token = {r["token"]: r["repair"] for r in repairs or () if r["certain"] or r["repair"] is not None}
            repaired.append(ch.TOKEN.sub(lambda m: by_token.get(m.group()) or m.group(), plain))
            alike.append(len(by_token))
            left.append(sum(1 for r in by_token.values() if r is None))
        table, key, text, _, odd, _ = batch.columns
        yield pa.RecordBatch.from_arrays(
            [table, key, text, pa.array(repaired, pa.string()), odd, pa.array(alike, pa.int32()), pa.array(left, pa.int32())],
            ["record_table", "record_key", "text", "repaired", "odd_characters", "look_alikes", "unrepaired"],
        )


def _words(text: F.Column) -> F.Column:
    # the tokens of ``characters.TOKEN``, combining marks that have no letter of their own included
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:[\u0300-\u036f]+[\p{L}\p{N}]*)*"), 0)


def scan(texts: DataFrame) -> DataFrame:
    return texts.select("record_table", F.col("record_key").cast("string").alias("record_key"), F.col("text").cast("string").alias("text")).mapInArrow(_scan(confusables(texts.sparkSession)), _SCANNED)


def repair(texts: DataFrame) -> DataFrame:
    """texts(record_table, record_key, text) -> (..., text, repaired, odd_characters, look_alikes, unrepaired).

    odd_characters: a character was replaced that always stands for a plain one. look_alikes: number of tokens with letters
    of another script that stand for plain ones, or of another Latin alphabet if the word with the plain ones is known; unrepaired: those of them whose repair the vocabulary doesn't have, which
    stay as they are. The vocabulary is every word of every text that mixes no scripts, letter case aside. A null text stays
    null; repeated rows come out as often as they come in; text wholly in Greek or Cyrillic is untouched.
    """
    scanned = materialize(scan(texts), "scanned")
    suspects = scanned.where(F.size("mixed") > 0)
    tokens = materialize(suspects.select(F.explode("mixed").alias("m")).select("m.token", "m.forms", "m.certain").distinct(), "tokens")
    wanted = tokens.select(F.explode("forms").alias("word")).select(F.lower("word").alias("word")).distinct()
    words = scanned.where("plain is not null").select(F.explode(_words(F.col("plain"))).alias("word"))
    if tokens.count() <= MOST_BROADCAST:
        known = words.join(F.broadcast(wanted), "word", "left_semi").distinct()  # the corpus' words are not shuffled
    else:
        known = wanted.join(words.distinct(), "word", "left_semi")
    tried = tokens.select("token", "forms", F.posexplode("forms").alias("place", "form")).withColumn("word", F.lower("form")).join(known, "word")
    chosen = tried.groupBy("token", "forms").agg(F.min(F.struct("place", "form"))["form"].alias("repair"))
    asked = suspects.select("record_table", "record_key", "text", F.explode("mixed").alias("m")).select("record_table", "record_key", "text", "m.token", "m.forms", "m.certain").distinct()
    repairs = (
        asked.join(chosen, ["token", "forms"], "left")
        .groupBy("record_table", "record_key", "text")
        .agg(F.collect_list(F.struct("token", "repair", "certain")).alias("repairs"))
        .toDF("r_table", "r_key", "r_text", "repairs")
    )
    on = [F.col("record_table").eqNullSafe(F.col("r_table")), F.col("record_key").eqNullSafe(F.col("r_key")), F.col("text") == F.col("r_text")]
    joined = suspects.join(repairs, on, "left").select("record_table", "record_key", "text", "plain", "odd_characters", "repairs")
    rest = scanned.where(F.size("mixed") == 0).select("record_table", "record_key", "text", F.col("plain").alias("repaired"), "odd_characters", F.lit(0).alias("look_alikes"), F.lit(0).alias("unrepaired"))
    return rest.unionByName(joined.mapInArrow(_mend, _REPAIRED))
