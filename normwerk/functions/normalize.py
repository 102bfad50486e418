"""Normal forms of names, references and citations as column expressions; each is one documented rule."""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Long words of legal references and the short forms they are reduced to.
REFERENCE_WORDS = (("paragraph", ""), ("artikel", "art"), ("absatz", "abs"), ("nummer", "nr"), ("buchstabe", "buchst"), ("litera", "lit"))
# Letters with accents and their plain letters, for the tokens of full-text search.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
UNACCENTED = "aaaaaaceeeeiiiinooooouuuuyy"


def casefold(x: Column) -> Column:
    return F.replace(F.lower(x), F.lit("ß"), F.lit("ss"))


def key(x: Column) -> Column:
    """Letters a-z and digits only, letter case folded."""
    return F.regexp_replace(casefold(x), "[^0-9a-z]", "")


def reference_key(x: Column) -> Column:
    """``key`` with the long words of references shortened."""
    out = key(x)
    for long, short in REFERENCE_WORDS:
        out = F.replace(out, F.lit(long), F.lit(short))
    return out


def search_terms(x: Column) -> Column:
    """Distinct terms in order."""
    return F.array_distinct(F.regexp_extract_all(x, F.lit("[0-9A-Za-zÄÖÜäöüß]+"), 0))


def tokens(x: Column) -> Column:
    """Tokens of the full-text index: lower case, accents folded."""
    return F.regexp_extract_all(F.translate(F.lower(x), ACCENTED, UNACCENTED), F.lit("[0-9a-zß]+"), 0)


def slug(x: Column) -> Column:
    """German slug: § and umlauts spelled out, other runs to one underscore."""
    out = F.lower(x)
    for a, b in (("§", "para"), ("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.btrim(F.regexp_replace(out, "[^a-z0-9]+", "_"), F.lit("_"))


@lru_cache(maxsize=1)
def _plain_letters() -> str:
    """As JSON: each character of the basic plane whose compatibility decomposition has ASCII in it, and that."""
    forms = {chr(c): "".join(x for x in unicodedata.normalize("NFKD", chr(c)) if x < "\x80") for c in range(0x80, 0x10000)}
    return json.dumps({c: form for c, form in forms.items() if form})


def ascii_only(x: Column) -> Column:
    """Accents dropped from their letters and compatibility forms resolved; what is not ASCII then is dropped."""
    plain = F.from_json(F.lit(_plain_letters()), "map<string,string>")
    letters = F.transform(F.split(x, ""), lambda c: F.when(c < "\x80", c).otherwise(F.coalesce(plain[c], F.lit(""))))
    return F.when(x.rlike(r"[^\x00-\x7f]"), F.array_join(letters, "")).otherwise(x)


def slug_eu(x: Column) -> Column:
    """Slug of European acts: accents dropped from their letters, what is not ASCII dropped; empty becomes ``unbezeichnet``."""
    out = F.replace(F.replace(F.lower(x), F.lit("§"), F.lit(" para ")), F.lit("&"), F.lit(" und "))
    out = F.btrim(F.regexp_replace(F.lower(ascii_only(out)), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.when(out == "", "unbezeichnet").otherwise(out)


def hash_id(prefix: str, length: int, *parts: Column, separator: str = "|") -> Column:
    """A prefix and the first ``length`` hex digits of the SHA-256 of the parts."""
    text = F.concat_ws(separator, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.substring(F.sha2(text, 256), 1, length))


def one_line(x: Column) -> Column:
    """No-break spaces to spaces, each line collapsed and trimmed, empty lines dropped."""
    lines = F.transform(F.split(F.replace(x, F.lit(" "), F.lit(" ")), "\n"), lambda s: F.trim(F.regexp_replace(s, "[ \t\r\f]+", " ")))
    return F.array_join(F.filter(lines, lambda s: s != ""), "\n")


def citation_key(x: Column) -> Column:
    """Letter case folded, white space collapsed."""
    return F.trim(F.regexp_replace(casefold(x), r"\s+", " "))


def unit_part(x: Column) -> Column:
    """A reference cut before its first level below the unit."""
    return F.trim(F.regexp_replace(x, r"\s+(?:Abs\.|Absatz|Satz|Nr\.|Nummer|Buchst\.|Buchstabe|lit\.).*$", ""))


def law_name(x: Column) -> Column:
    """A law's name from genitive to nominative, as a slug."""
    out = F.regexp_replace(x, r"(?i)gesetzes\b", "gesetz")
    out = F.regexp_replace(out, r"(?i)gesetzbuch(?:e?s)\b", "gesetzbuch")
    return slug(F.regexp_replace(out, r"(?i)erlasses\b", "erlass"))


def unit_aliases(kind: Column, number: Column) -> Column:
    """The spellings by which a numbered unit is asked for."""
    both = lambda a, b: F.array(F.concat(F.lit(a), number), F.concat(F.lit(b), number))
    return F.when(kind == "article", both("Art. ", "Artikel ")).when(kind == "paragraph", both("§ ", "Paragraph ")).when(kind == "annex", both("Anlage ", "Anhang ")).otherwise(F.array().cast("array<string>"))


def snippet(text: Column, terms: list[str], width: int = 200) -> Column:
    """The part of a text around its first search term, cut at spaces, with marks where it is cut."""
    low = F.lower(text)
    places = F.filter(F.array(*[F.instr(low, t.lower()) for t in terms if len(t) > 1] or [F.lit(0)]), lambda p: p > 0)
    focus = F.coalesce(F.array_min(places), F.lit(1))
    begin = F.greatest(F.lit(1), focus - width // 3)
    raw = F.substring(text, begin, F.lit(width))
    cut_front, cut_back = begin > 1, begin + width <= F.char_length(text)
    space = F.instr(raw, " ")
    front = F.when(cut_front & (space > 0) & (space <= 80), F.concat(F.lit("… "), F.substring(raw, space + 1, F.lit(width)))).when(cut_front, F.concat(F.lit("… "), raw)).otherwise(raw)
    back = F.when(cut_back, F.concat(F.regexp_replace(front, r"\s\S{0,79}$", ""), F.lit(" …"))).otherwise(front)
    return F.when(F.char_length(text) <= width, text).otherwise(back)


# Kinds of European acts and their letter in a CELEX number.
CELEX_LETTERS = {"verordnung": "R", "richtlinie": "L", "beschluss": "D", "entscheidung": "D"}


def celex_of_key(x: Column) -> Column:
    """CELEX number of a document key: sector 3, year, type letter, number with four digits; null if it names none.

    Keys name the act's number before or after its body. Which of the two numbers is the year: of old acts ("nr") the
    second, the first of those of the EU since 2015; else the one that can be a year, the first if both can and it is 2015 or
    later. A year of 1900 to 1949 stands for one of the 2000s.
    """
    celex = F.upper(F.regexp_extract(x, r"^celex_(3\d{4}[rld]\d{4})", 1))
    named = r"(?i)^(verordnung|richtlinie|beschluss|entscheidung)_(eu|eg|ewg|eag)(_nr)?_(\d{2,4})_(\d{1,4})$"
    before = r"(?i)^(verordnung|richtlinie|beschluss|entscheidung)_(\d{4})_(\d{1,4})_(?:eu|eg|ewg|eag)$"
    part = lambda pattern, i: F.lower(F.regexp_extract(x, pattern, i))
    letter = lambda kind: F.create_map(*[F.lit(v) for pair in CELEX_LETTERS.items() for v in pair])[kind]
    number = lambda c: c.try_cast("int")
    made = lambda kind, year, n: F.concat(F.lit("3"), F.lpad(year.cast("string"), 4, "0"), letter(kind), F.lpad(n.cast("string"), 4, "0"))

    first, second = part(before, 2), part(before, 3)
    turned = (number(first) < 1950) & (F.length(second) == 4) & (number(second) >= 1950)
    suffixed = made(part(before, 1), F.when(turned, number(second)).otherwise(number(first)), F.when(turned, number(first) % 100).otherwise(number(second)))

    kind, body, old, a, b = (part(named, i) for i in range(1, 6))
    could = lambda c: (F.length(c) == 4) & (number(c) >= 1950) & (number(c) <= F.year(F.current_date()) + 2)
    century = lambda c: F.when(number(c).between(1900, 1949), number(c) + 100).otherwise(number(c))
    is_old, is_eu = old != "", body == "eu"
    first_is_year = F.when(is_old & ~is_eu, False).when(is_old & (number(a) >= 2015), True).when(is_old & number(b).between(1900, 1949), False).when(could(a) & (~could(b) | (number(a) >= 2015)), True).when(could(b), False).when(F.length(a) == 4, True).when(F.length(b) == 4, False)
    by_old = is_old & ~first_is_year
    year = F.when(first_is_year, number(a)).when(by_old, century(b)).otherwise(number(b))
    whole = F.when(first_is_year.isNotNull(), made(kind, year, F.when(first_is_year, number(b)).otherwise(number(a))))
    return F.when(celex != "", celex).when(part(before, 1) != "", suffixed).when(kind != "", whole)


def eu_aliases(kind: Column, year: Column, number: Column) -> Column:
    """Spellings of a European act's number, sorted."""
    short = F.substring(year, 3, 2)
    bodies = ("EU", "EG", "EWG", "EAG")
    forms = [F.concat(y, F.lit("/"), number, F.lit(f"/{b}")) for b in bodies for y in (year, short)]
    forms += [F.concat(kind, F.lit(f" ({b}) "), y, F.lit("/"), number) for b in bodies for y in (year,)]
    forms += [F.concat(kind, F.lit(f" ({b}) Nr. "), number, F.lit("/"), y) for b in bodies for y in (year, short)]
    return F.array_sort(F.array_distinct(F.array(*forms)))


def dot(a: Column, b: Column) -> Column:
    """Dot product in double precision, summed in order."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def valid_vector(v: Column, dimensions: int) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return v.isNotNull() & (F.size(v) == dimensions) & F.coalesce(fine, F.lit(False))
