"""Character forms: what a character stands for when it only looks like a plain one."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

# Letters of other scripts whose glyph is that of a Latin letter.
SAME_GLYPH = {
    # Cyrillic
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x",
    "Ѕ": "S", "І": "I", "Ј": "J", "ѕ": "s", "і": "i", "ј": "j", "Ү": "Y", "һ": "h", "ӏ": "l", "Ӏ": "I", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ο": "o", "ϲ": "c", "ϳ": "j",
}
# Letters that resemble a Latin letter closely enough to stand for it inside a Latin word.
SIMILAR_GLYPH = {"к": "k", "г": "r", "ё": "ë", "ї": "ï", "α": "a", "β": "ß", "γ": "y", "ι": "i", "κ": "k", "ν": "v", "ρ": "p", "σ": "o", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ί": "í", "ό": "ó", "ά": "á", "ή": "n", "η": "n"}
LOOK_ALIKE = SAME_GLYPH | SIMILAR_GLYPH
TO_OTHER = {
    "Cyrillic": {v: k for k, v in SAME_GLYPH.items() if "Ѐ" <= k <= "ԯ" and k not in "ҮӀ"},
    "Greek": {v: k for k, v in SAME_GLYPH.items() if "Ͱ" <= k <= "Ͽ"},
}

#: Further look-alikes of single Latin letters and digits, and of the hyphen, from a public list of confusable characters (see
#: ``extend``), and those of them that are Latin letters themselves.
EXTRA: dict[str, str] = {}
_extra_latin: set[str] = set()
_extra_pattern: re.Pattern | None = None
_hyphen_pattern: re.Pattern | None = None
# Signs of that list that are told apart from the plain ones.
TOLD_APART = set("–—―‒§²₂×·…„“”‘’‚‹›«»")


def extend(confusable: dict[str, str]) -> None:
    """Take up a list of characters and the single plain one that each looks like; a list that was taken up changes nothing."""
    global _extra_pattern, _hyphen_pattern
    new = {c: p for c, p in confusable.items() if c not in LOOK_ALIKE and c not in TOLD_APART and not "Ͱ" <= c <= "ӿ"}
    letters = {c: p for c, p in new.items() if c.isalpha() and p.isalnum() and unicodedata.normalize("NFKC", c) == c and unicodedata.normalize("NFD", c) == c}
    dashes = "".join(sorted(c for c, p in new.items() if p == "-" and not c.isalnum() and c not in HYPHENS))
    if letters != EXTRA:
        EXTRA.clear()
        EXTRA.update(letters)
        _extra_latin.clear()
        _extra_latin.update(c for c in letters if _block_script(c) == "Latin")
        _extra_pattern = re.compile("[" + "".join(map(re.escape, letters)) + "]") if letters else None
    # a dash is a hyphen between two parts of a word; between numbers it is a sign of its own
    _hyphen_pattern = re.compile(f"(?<=[^\\W\\d_])[{re.escape(dashes)}](?=\\w)|(?<=\\w)[{re.escape(dashes)}](?=[^\\W\\d_])") if dashes else None


# Characters outside of Unicode's format class that show nothing.
ALSO_INVISIBLE = "\u034f\u115f\u1160\u17b4\u17b5\u3164\uffa0"
# Hyphens that look like the plain one.
HYPHENS = "\u2010\u2011\ufe63\uff0d"


def script_of(ch: str) -> str:
    """Latin, Greek, Cyrillic, Other for letters; empty for what is no letter. A Latin letter that looks like another is Other."""
    return "Other" if ch in _extra_latin else _block_script(ch)


def _block_script(ch: str) -> str:
    if not ch.isalpha():
        return ""
    if ch.isascii() or ch < "ɐ" or "Ḁ" <= ch <= "ỿ":
        return "Latin"
    if "Ͱ" <= ch <= "Ͽ" or "ἀ" <= ch <= "῿":
        return "Greek"
    if "Ѐ" <= ch <= "ԯ":
        return "Cyrillic"
    return "Latin" if unicodedata.name(ch, "").startswith(("LATIN", "FULLWIDTH LATIN")) else "Other"


@lru_cache(maxsize=70_000)
def plain_form(ch: str) -> str:
    """What one character stands for, irrespective of its neighbours: nothing, a space, a hyphen, letters or digits, itself."""
    kind = unicodedata.category(ch)
    if kind == "Cc":
        return ch if ch in "\t\n\r" else ""
    if ch.isascii():
        return ch
    if kind == "Cf" or ch in ALSO_INVISIBLE or "\ufe00" <= ch <= "\ufe0f" or "\u180b" <= ch <= "\u180e":
        return ""
    if kind == "Zs":
        return " "
    if kind in ("Zl", "Zp"):
        return "\n"
    if ch in HYPHENS:
        return "-"
    whole = unicodedata.decomposition(ch)
    if not whole:
        return ch
    tag = whole.split(" ")[0] if whole[0] == "<" else ""
    form = unicodedata.normalize("NFKC", ch)
    if tag in ("<wide>", "<narrow>", "<font>", "<noBreak>"):
        return form
    if tag == "<compat>":
        return form if form.isalnum() and form != ch and script_of(form[0]) in ("Latin", "") else ch
    if not tag and " " not in whole:  # one character for another, such as the Kelvin sign
        return unicodedata.normalize("NFC", ch)
    return ch


#: Nothing in it is changed by plain_form; it holds no control or combining character, no letter pair and no letter outside of Latin.
_LATIN_TEXT = re.compile("[\t\n\r -~\u00a1-\u00ac\u00ae-\u0131\u0134-\u013e\u0141-\u0148\u014a-\u017e\u0180-\u01c3\u01cd-\u01f0\u01f4-\u02af\u2013\u2014\u2018-\u201d\u201e\u2026\u20ac]*")


def is_plain(text: str) -> bool:
    """Quick and safe: true only if no character needs a second look."""
    return _LATIN_TEXT.fullmatch(text) is not None and not (_extra_pattern is not None and _extra_pattern.search(text))


def recompose(text: str) -> str:
    """Each character in its plain form, accents composed with their letters, runs of spaces kept."""
    if is_plain(text):
        return text
    out = "".join(map(plain_form, text))
    if _hyphen_pattern is not None:
        out = _hyphen_pattern.sub("-", out)
    return unicodedata.normalize("NFC", out)


TOKEN = re.compile("[^\\W_]+(?:[\u0300-\u036f]+[^\\W_]*)*")


def dominant_script(token: str) -> str:
    """The script of most letters; Latin if there are as many of it as of another."""
    counts: dict[str, int] = {}
    for ch in token:
        s = script_of(ch)
        if s:
            counts[s] = counts.get(s, 0) + 1
    return max(counts, key=lambda s: (counts[s], s == "Latin")) if counts else ""


def scripts(token: str) -> set[str]:
    return {s for s in map(script_of, token) if s}


def to_latin(token: str) -> str | None:
    """The token with look-alikes of Latin letters substituted; None if a letter of another script is left."""
    out = "".join(LOOK_ALIKE.get(ch) or EXTRA.get(ch, ch) for ch in token)
    return out if scripts(out) <= {"Latin"} else None


def to_script(token: str, script: str) -> str | None:
    """The token with the letters of other scripts replaced by their look-alikes in ``script``."""
    if script == "Latin":
        return to_latin(token)
    table = TO_OTHER.get(script, {})
    out = "".join(ch if script_of(ch) in ("", script) else table.get(LOOK_ALIKE.get(ch) or EXTRA.get(ch, ch), ch) for ch in token)
    return out if scripts(out) <= {script} else None


def fold_look_alikes(text: str) -> str:
    """Recomposed text in which mixed-script words, and words made of Latin look-alikes alone, are Latin."""
    if is_plain(text):
        return text
    text = recompose(text)
    if is_plain(text):
        return text

    def word(m: re.Match) -> str:
        token = m.group()
        kinds = scripts(token)
        if kinds <= {"Latin"}:
            return token
        if "Latin" in kinds or all(ch in SAME_GLYPH or not ch.isalpha() for ch in token):
            return to_latin(token) or token
        return token

    return TOKEN.sub(word, text)
