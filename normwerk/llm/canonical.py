"""Mapping freely typed names to the entries of a canonical list.

Every name and every entry is a few sets of tokens: its number, its abbreviation, and the 3-grams of its core (the name
without articles, type words and template phrases). One prefix-filter set-similarity join finds the candidates: tokens are
ordered from the rarest to the commonest, only the rare prefix of each set is joined, and pairs pass a length and a positional
filter. The prefixes are long enough for two bounds at once: no pair of the Jaccard threshold is lost, nor any pair of cores
within EDITS edits (see ``needed``). Jaccard is then verified exactly and the best entry that is near enough is kept.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..durable import materialize
from ..session import spread
from ..skew import salted_left_join
from . import characters as ch

#: Least Jaccard similarity of two cores' 3-gram sets.
THRESHOLD = 0.4
#: Edits between a core and the entry that it means, at most, and the least letters of such an entry: an edit (a swap of
#: neighbours) changes 4 of its 3-grams at most, and it has one more than letters, so that one is left unchanged at least.
EDITS, GRAMS_PER_EDIT = 2, 4
LEAST_ENTRY = EDITS * GRAMS_PER_EDIT
#: Most different tokens whose counts, and most prefix rows of the entries, that are broadcast (some 30 MB each); beyond,
#: both sides are shuffled, with salts for hot tokens.
MOST_GRAMS = MOST_PREFIXES = 500_000

# Words that German names of laws share, and words that typists add.
TYPES = ("gesetz", "verordnung", "richtlinie")
PHRASES = ("neuordnung", "durchfuhrung", "angleichung", "durchfuhrungsbestimmungen", "fassung", "gesetzes", "verordnungen", "richtlinien")
ADDED = set("uber die der das des dem den zur zum eu eg ewg nr sog aus siehe vgl gem neue idgf geand auszug erlass ges vo rl durchf neuordn angl i d f v z u".split())
_NUMBER = re.compile(r"(?<!\d)(\d{4})\s*/\s*(\d{1,5})(?!\d)")
_SUFFIXES = ("gesetzes", "gesetz", "verordnung", "richtlinie", "richtlinien", "durchfuhrungsbestimmungen")
_IMPLEMENTING = "durchfuhrungsbestimmungen"


def distance(a: str, b: str, anywhere: bool = False) -> int:
    """Edits (insert, delete, substitute, swap neighbours) from a to b, or to the part of b nearest to a, by bit vectors."""
    m = len(a)
    if m == 0:
        return 0 if anywhere else len(b)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    mask, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, d0, before, score = mask, 0, 0, 0, m
    least = m
    for c in b:
        pm = where.get(c, 0)
        swap = (((~d0 & mask) & pm) << 1) & before
        d0 = ((((pm & pv) + pv) ^ pv) | pm | mv | swap) & mask
        hp = (mv | ~(d0 | pv)) & mask
        hn = d0 & pv
        if hp & high:
            score += 1
        elif hn & high:
            score -= 1
        hp = (hp << 1) & mask | (0 if anywhere else 1)
        hn = (hn << 1) & mask
        pv = (hn | ~(d0 | hp)) & mask
        mv = hp & d0
        before = pm
        least = min(least, score)
    return least if anywhere else score


class _Marks(dict):
    """For str.translate: combining characters are dropped."""

    def __missing__(self, code: int) -> int | None:
        self[code] = None if unicodedata.combining(chr(code)) else code
        return self[code]


_MARKS = _Marks()


@lru_cache(maxsize=1000)
def _latin(text: str) -> str:
    return ch.fold_look_alikes(text)


@lru_cache(maxsize=1000)
def folded(text: str) -> str:
    """Lower-case Latin letters and digits with single spaces; umlauts and their spellings with e are one."""
    text = unicodedata.normalize("NFKD", _latin(text).casefold()).translate(_MARKS)
    text = re.sub(r"[^a-z0-9Ͱ-ӿ]+", " ", text)
    return text.replace("ue", "u").replace("ae", "a").replace("oe", "o").strip()


def number_in(text: str) -> str | None:
    m = _NUMBER.search(_latin(text))
    return f"{m[1]}/{int(m[2])}" if m else None


def abbreviation_of(text: str) -> str | None:
    """The text as an abbreviation: without a section before it or a year after it."""
    t = re.sub(r"^(?:art(?:ikel)?|paragraph|abs)? ?\d{1,3} (?=[a-z])", "", folded(text))
    t = re.sub(r"(?<=[a-z]) (?:19|20)\d\d$", "", t).replace(" ", "")
    return t or None


@lru_cache(maxsize=100_000)
def _within(a: str, b: str, most: int) -> bool:
    """Whether b is ``most`` edits from a at most; each edit takes one kind of letter away at most, which is quick to see."""
    return abs(len(a) - len(b)) <= most and len(set(a) - set(b)) <= most and distance(a, b) <= most


@lru_cache(maxsize=100_000)
def _is_type_word(w: str) -> bool:
    return any(_within(x, w, 2) for x in (*TYPES, *PHRASES))


def is_implementing(text: str) -> bool:
    """Whether provisions implementing a law are named, not the law."""
    t = folded(text)
    if re.search(r"durchf\w* ?best|\bdb$", t):
        return True
    return len(set(_IMPLEMENTING) - set(t)) <= 4 and distance(_IMPLEMENTING, t.replace(" ", ""), anywhere=True) <= 4


_LETTERS = {s: [(c, s.count(c)) for c in sorted(set(s))] for s in _SUFFIXES}


def _missing(s: str, text: str) -> int:
    """Letters of a suffix that a text lacks: each edit makes up for one at most."""
    return sum(max(0, n - text.count(c)) for c, n in _LETTERS[s])


def _type_word_length(core: str) -> int:
    """Letters of the type word, possibly mistyped, that a core ends with; 0 if with none."""
    exact = max((len(s) for s in _SUFFIXES if core.endswith(s)), default=0)
    if exact and len(core) > exact + 5:
        return exact
    best = None
    for s in _SUFFIXES:
        for n in range(len(s) - 1, len(s) + 2):
            if len(core) > n + 5 and _missing(s, core[-n:]) <= 2:
                d = distance(core[-n:], s)
                if d <= 2 and (best is None or (d, -n) < best):
                    best = (d, -n)
    return -best[1] if best else 0


def core_of(text: str) -> str:
    """What is left of a name without type words, template phrases and additions, irrespective of the place of spaces.

    Words of up to three letters are additions too, unless the name has no other words.
    """
    plain = [w for w in folded(text).split() if w not in ADDED and not any(c.isdigit() for c in w) and not _is_type_word(w)]
    core = "".join([w for w in plain if len(w) > 3] or plain)
    for _ in range(2):
        n = _type_word_length(core)
        if not n:
            break
        core = core[:-n]
    core = re.sub(r"s?(?:vo|ges|rl|geses)$", "", core) or core
    return re.sub(r"s$", "", core) or core


#: Beginnings that a name's core may keep from mistyped additions.
_LEADS = ("der", "die", "des", "dem", "den", "ube", "zur", "sie", "aus", "sog")


def near_enough(core: str, squeezed: str, entry: str, jaccard: float) -> tuple[bool, int]:
    """Whether a name means an entry, and the edits between them (in the core or anywhere in the whole name).

    An entry that is found inside a longer core counts only if what is left over looks like an addition (a word of its own,
    or an article that was typed together with the name), not like the beginning of another compound.
    """
    whole = distance(core, entry)
    if whole == 0:
        return True, 0
    meant = whole <= EDITS and len(entry) >= LEAST_ENTRY
    over = len(core) - len(entry)
    added = over <= 1 or over >= 4 or core.startswith(_LEADS)
    if not meant and not added:
        return False, whole
    inside = distance(entry, squeezed, anywhere=True)
    fine = meant or (added and ((inside <= 1 and jaccard >= 0.5) or (inside == 2 and jaccard >= 0.55)))
    return fine, min(inside, whole)


# Kinds of sets, in the order in which they decide.
NUMBER, ABBREVIATION, CORE = "0", "1", "2"
METHODS = {NUMBER: "number", ABBREVIATION: "abbreviation", CORE: "similarity"}


def grams_of(core: str) -> list[str]:
    return sorted({f"  {core} "[i : i + 3] for i in range(len(core) + 1)}) if core else []


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """name -> one row a set: (name, key, grams, letters, implementing, squeezed); letters only of cores."""
    types = [pa.string(), pa.string(), pa.list_(pa.string()), pa.int32(), pa.bool_(), pa.string()]
    for batch in batches:
        out = []
        for name in batch.column(0).to_pylist():
            number, abbreviation, core = number_in(name), abbreviation_of(name), core_of(name)
            if number:
                out.append((name, NUMBER + number, ["#" + number], None, None, ""))
            if abbreviation:
                out.append((name, ABBREVIATION + abbreviation, ["@" + abbreviation], None, None, ""))
            if core:
                out.append((name, CORE + core, grams_of(core), len(core), is_implementing(name), folded(name).replace(" ", "")))
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [()] * 6, types)], ["name", "key", "grams", "letters", "implementing", "squeezed"])


_FEATURES = "name string, key string, grams array<string>, letters int, implementing boolean, squeezed string"


def needed(n: Column, letters: Column, least_letters: int, threshold: float) -> Column:
    """Tokens that a set of n must share with any other that it may be a pair with.

    Of sets with a Jaccard similarity of the threshold that is ceil(threshold n). Cores within EDITS edits differ in
    EDITS * GRAMS_PER_EDIT 3-grams of each at most, and share one at least if the entry has LEAST_ENTRY letters.
    """
    by_jaccard = F.ceil(n * threshold - 1e-9)
    by_edits = F.greatest(F.lit(1), n - EDITS * GRAMS_PER_EDIT)
    return F.when(letters >= least_letters, F.least(by_jaccard, by_edits)).otherwise(by_jaccard)


def candidates(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """left(l, grams, letters), right(r, grams, letters) -> (l, r): all pairs of ``threshold`` or within EDITS edits, and few more.

    l and r are unique, sets not empty. letters is the length of the core that the grams were made of, null for sets that are no
    cores; edits count for right sides of LEAST_ENTRY letters and more only.
    """
    counts = left.select(F.explode("grams").alias("gram")).unionAll(right.select(F.explode("grams").alias("gram"))).groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    counts = materialize(counts, "grams")
    order = F.broadcast(counts) if counts.count() <= MOST_GRAMS else counts

    def prefixes(side: DataFrame, key: str, least_letters: int) -> DataFrame:
        ranked = side.select(key, "letters", F.size("grams").alias("n"), F.explode("grams").alias("gram")).join(order, "gram")
        tokens = F.array_sort(F.collect_list(F.struct("df", "gram")))  # the tokens of one set
        sets = ranked.groupBy(key, "letters", "n").agg(tokens.alias("t"))
        rare = F.slice("t", F.lit(1), (F.col("n") - needed(F.col("n"), F.col("letters"), least_letters, threshold) + 1).cast("int"))
        return sets.select(key, "letters", "n", F.posexplode(rare).alias("place", "t")).select(key, "letters", "n", "place", "t.gram")

    a = prefixes(left, "l", LEAST_ENTRY - EDITS).withColumnsRenamed({"n": "ln", "place": "lp", "letters": "ll"})
    b = materialize(prefixes(right, "r", LEAST_ENTRY).withColumnsRenamed({"n": "rn", "place": "rp", "letters": "rl"}), "prefixes")
    joined = a.join(F.broadcast(b), "gram") if b.count() <= MOST_PREFIXES else salted_left_join(a, b, ["gram"], [F.col("l")], how="inner")
    ln, rn = F.col("ln"), F.col("rn")
    alike = (ln >= rn * threshold - 1e-9) & (rn >= ln * threshold - 1e-9)
    near = F.coalesce((F.abs(F.col("ll") - F.col("rl")) <= EDITS) & (F.col("rl") >= LEAST_ENTRY), F.lit(False))
    by_jaccard = F.when(alike, F.ceil(threshold / (1 + threshold) * (ln + rn) - 1e-9))
    by_edits = F.when(near, F.greatest(F.lit(1), ln - EDITS * GRAMS_PER_EDIT, rn - EDITS * GRAMS_PER_EDIT))
    least = F.least(by_jaccard, by_edits)  # the one that is there, if only one is
    # the first common token of a pair has no other common one before it on either side
    possible = F.least(ln - F.col("lp"), rn - F.col("rp"))
    return joined.where(alike | near).where(possible >= least).select("l", "r").distinct()


def similarity_join(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """left(l, grams), right(r, grams) -> (l, r, jaccard) of all pairs of at least ``threshold``; ids are unique, sets not empty.

    An exact join: prefix, length and positional filters only leave out pairs that cannot reach the threshold.
    """
    no_letters = F.lit(None).cast("int").alias("letters")
    pairs = candidates(left.select("l", "grams", no_letters), right.select("r", "grams", no_letters), threshold)
    both = pairs.join(left.select("l", F.col("grams").alias("lg")), "l").join(right.select("r", F.col("grams").alias("rg")), "r")
    common = F.size(F.array_intersect("lg", "rg"))
    return both.select("l", "r", (common / (F.size("lg") + F.size("rg") - common)).alias("jaccard")).where(F.col("jaccard") >= threshold - 1e-12)


@lru_cache(maxsize=100_000)
def _gram_set(core: str) -> frozenset[str]:
    return frozenset(grams_of(core))


def _exact(threshold: float):
    """Candidate pairs (l, r) of keys -> (l, r, jaccard) of those of the threshold and of cores within EDITS edits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for l, r in zip(*(batch.column(k).to_pylist() for k in range(2))):
                jaccard = 1.0
                if l[0] == CORE:
                    core, entry = l[1:], r[1:]
                    a, b = _gram_set(core), _gram_set(entry)
                    common = len(a & b)
                    jaccard = common / (len(a) + len(b) - common)
                    if jaccard < threshold - 1e-12 and not (len(entry) >= LEAST_ENTRY and _within(core, entry, EDITS)):
                        continue
                out.append((l, r, jaccard))
            types = [pa.string(), pa.string(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [()] * 3, types)], ["l", "r", "jaccard"])

    return run


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for name, squeezed, l, r, law_key, jaccard in zip(*(batch.column(k).to_pylist() for k in range(6))):
            fine, edits = near_enough(l[1:], squeezed, r[1:], jaccard) if l[0] == CORE else (True, 0)
            if fine:
                out.append((name, law_key, l[0], jaccard, edits))
        types = [pa.string(), pa.string(), pa.string(), pa.float64(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [()] * 5, types)], ["name", "law_key", "kind", "jaccard", "edits"])


def map_names(names: DataFrame, laws: DataFrame) -> DataFrame:
    """names(name_id, name), laws(law_key, title, short_title, abbreviation, act_number) -> (name_id, name, law_key, method, jaccard, edits).

    One row a name_id: law_key null and method ``none`` if the name is blank, null or near to no entry. Of the candidates a
    number of the list that is in the name comes first, then an abbreviation, then the core of the fewest edits, the greatest
    Jaccard, the smallest key. Repeated rows of a name_id are one name (the greatest counts). Every distinct spelling is
    worked out once, however often it was typed.
    """
    typed = names.where("name_id is not null").groupBy("name_id").agg(F.max("name").alias("name"))
    typed = materialize(typed, "typed")
    spellings = typed.where("name is not null and trim(name) <> ''").select("name").distinct()
    features = materialize(spread(spellings).mapInArrow(_features, _FEATURES), "features")

    listed = laws.where("law_key is not null").select("law_key", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("name")) for k, c in ((CORE, "title"), (CORE, "short_title"), (ABBREVIATION, "abbreviation"), (NUMBER, "act_number"))])).alias("e"))
    listed = listed.select("law_key", "e.kind", "e.name").where("trim(name) <> ''").distinct()
    parts = listed.select("name").distinct().mapInArrow(_features, _FEATURES)
    of_kind = listed.join(parts, "name").where(F.substring("key", 1, 1) == F.col("kind"))
    entries = materialize(of_kind.select("law_key", F.col("key").alias("r"), "grams", "letters", "implementing").distinct(), "entries")

    sides = [df.groupBy(k).agg(F.first("grams").alias("grams"), F.first("letters").alias("letters")) for df, k in ((features.withColumnRenamed("key", "l"), "l"), (entries, "r"))]  # functions of the key
    near = candidates(*sides, THRESHOLD).mapInArrow(_exact(THRESHOLD), "l string, r string, jaccard double")
    means = entries.select("law_key", "r", F.col("implementing").alias("i"))
    if entries.count() <= MOST_PREFIXES:
        means = F.broadcast(means)
    asked = features.select("name", "squeezed", "implementing", F.col("key").alias("l")).join(near, "l").join(means, "r").where("implementing is null or implementing = i")
    judged = spread(asked.select("name", "squeezed", "l", "r", "law_key", "jaccard")).mapInArrow(_verify, "name string, law_key string, kind string, jaccard double, edits int")
    best = judged.groupBy("name").agg(F.min(F.struct("kind", "edits", (-F.col("jaccard")).alias("j"), "law_key")).alias("b"))
    method = F.create_map(*[F.lit(x) for pair in METHODS.items() for x in pair])[F.col("b.kind")]
    mapped = best.select("name", "b.law_key", method.alias("method"), (-F.col("b.j")).alias("jaccard"), "b.edits")
    return typed.join(mapped, "name", "left").select("name_id", "name", "law_key", F.coalesce("method", F.lit("none")).alias("method"), "jaccard", "edits")
