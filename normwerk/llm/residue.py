"""Template residue, error pages, script or cookie notices and filler text.

Each text is read once from end to end, in Arrow batches:

* *Placeholders* have one grammar per opening delimiter, tried only where that delimiter stands and read up to the closing
  one, however far away. What a delimiter holds decides: a name is a placeholder, a list, a formula, a number or an
  omission mark isn't. Code is taken out first. A placeholder is only mentioned, not left unfilled, if its own sentence
  speaks of templates before it or calls it one right after it, or if most placeholders around it are so mentioned.
* *Page messages* are found by one automaton over all words and phrases of MESSAGES; no list stands before it. A sentence is
  a message if it has a phrase, or a subject and a state that only occur together on such pages. A text is an error page or
  notice if what remains after its messages, navigation and reference codes is less than half of it.
* *Filler* is text without the function words that any prose has, one sentence over and over, or known filler.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- placeholders ----

_NAME = r"[^\W\d][\w.\- ]*"
#: One word, dotted or underscored, as templates name their fields.
_FIELD = r"[^\W\d]\w*(?:[.\-]\w+)*"

#: Grammars by opening character, matched where it stands.
PLACEHOLDERS = {
    "{": rf"\{{\{{[#/&>!^]?\s*{_NAME}(?:\|[^{{}}]*)?\}}\}}|\{{%-?\s*[^\W\d_][^{{}}%]*%\}}|(?<![\w^{{$\\])\{{[^\W\d]+(?:[._]\w+)+\}}(?!\}})|(?<![\w^{{$\\#%])\{{[^\W\d_]\w{{3,}}\}}(?!\}})",
    "$": rf"\$\{{\s*{_NAME}\}}|\$\(\s*{_FIELD}\s*\)|(?<![\w$])\${_FIELD}\$(?![\w$])",
    "<": rf"<%=?\s*[^\W\d_][^<>%]*%>|<\?(?:php|=)[^<>?]*\?>|<<\s*{_NAME}>>|<\s*(?:Name|Ort|Datum|Betrag|Titel|Anrede|Aktenzeichen|Behörde|Stelle|Nummer|Adresse|Anschrift|Frist|Date|Amount|Place|Title|Address|Number|Nom|Lieu|Montant)(?:\s[\w ]+)?\s*>",
    "«": rf"«{_FIELD}»",
    "‹": rf"‹{_FIELD}›",
    "[": rf"\[\[\s*{_NAME}\]\]|\[(?:Name|NAME|Vorname|Nachname|Ort|ORT|Datum|DATUM|Betrag|BETRAG|Anrede|Aktenzeichen|Unterzeichner|Adresse|Anschrift|Date|Amount|Nom|Lieu|Montant)(?:\s(?:der|des|de|of)\s[\w ]+)?\]",
    "@": rf"@@{_FIELD}@@|@\{{{_FIELD}\}}",
    "%": rf"%%{_FIELD}%%|(?<![\d\s])%{_FIELD}%|(?<=\s)%[A-Z][A-Z0-9_]{{2,}}%|(?<![\d%])(?<!\d )%[sd](?!\w)|%\([^\W\d_]\w*\)[sd]",
    "_": r"(?<!\w)__[^\W\d_](?:(?!__)[\w.\-])*__(?!\w)",
    "#": rf"(?<![\w#&])#{_FIELD}#(?![\w#])",
    "T": r"TBD\b|TODO\b\s*[:–-]|TBA\b(?=\s[–-])|TT\.\s?MM\.\s?JJ(?:JJ)?\b",
    "F": r"FIXME\b",
    "D": r"DD[./-]MM[./-]YY(?:YY)?\b",
    "Y": r"YYYY-MM-DD\b",
    "M": r"MM/DD/YYYY\b",
    "J": r"JJ/MM/AAAA\b",
    "X": r"XX\.XX\.(?:XXXX|20XX|XX)\b|X{2,}(?:[.,]X{2,})?\s?(?:Euro|EUR|€|Tage|Prozent|%|days|euros?)",
}
_GRAMMAR = {c: re.compile(p) for c, p in PLACEHOLDERS.items()}
_DELIMITER = re.compile(r"[{$<«‹\[@%_#]")
_OPENING = re.compile(_DELIMITER.pattern + r"|(?<!\w)(?:T(?:BD|ODO|BA|T\.)|FIXME|DD[./-]|YYYY|MM/|JJ/|XX)")
#: A bracket that tells what to fill in, by its content.
INSTRUCTION = re.compile(
    r"(?i)\s*(?:hier\s.*(?:einfügen|eintragen|ergänzen)|(?:.*\s)?(?:einfügen|eintragen|ausfüllen|ergänzen)|insert\s.+|enter\s.+|your\s.+|(?:à\s)?(?:insérer|compléter|remplir)\s.+|.+\s(?:à\scompléter|à\sinsérer|here)|placeholder.*|platzhalter.*)\s*", re.S
)
_BRACKET = re.compile(r"\[([^\[\]]*)\]")
_NUMBERED = re.compile(r"(?:\bArt\.|§|\bAbs\.|\bArtikel|\bArticle|\bSeite|\bpage|\bNr\.)\s?\Z")
_CROSSES = re.compile(r"X{2,}\b")
CODE = re.compile(r"(?s)```.*?```|<pre>.*?</pre>|<code>.*?</code>|`[^`\n]+`")
TUTORIAL = re.compile(r"(?i)\b(?:platzhaltern?|placeholders?|geschweifte\w* klammern|curly braces|template syntax|vorlagensyntax|template engine|syntaxe|accolades)\b")
#: What calls a placeholder one right after it.
_CALLED = re.compile(r"(?i)[\"“”»«’')\]]*\s+(?:(?:ist|sind|wäre|is|are|est|sont)\s+(?:(?:ein|eine|kein|a|an|un|une)\s+)?)?(?:platzhalter|placeholder|espace réservé)")
#: Characters on either side of a placeholder in which others count as its surroundings.
AROUND_PLACEHOLDER = 500
SENTENCE_END = re.compile(r"(?<=[.!?…])\s+|\s*[\n\r]+\s*")


def placeholders(text: str, words: bool = True) -> list[tuple[int, int]]:
    """(start, end) of each form that a template leaves to be filled in, code taken out before.

    ``words``: whether the text may hold forms that begin with a letter, such as TBD or DD.MM.YYYY.
    """
    found = []
    at = 0
    opening = _OPENING if words else _DELIMITER
    while m := opening.search(text, at):
        start = m.start()
        first = text[start]
        hit = _GRAMMAR[first].match(text, start)
        end = hit.end() if hit else 0
        if not hit and first == "[":
            b = _BRACKET.match(text, start)
            if b and INSTRUCTION.fullmatch(b[1]) and not re.search(r"[.;!?]\s", b[1]):
                end = b.end()
        elif not hit and first == "X":
            b = _CROSSES.match(text, start)
            if b and _NUMBERED.search(text[max(0, start - 12) : start]):
                end = b.end()
        if end:
            found.append((start, end))
        at = end or start + 1
    return found


def has_placeholder(text: str, words: bool = True) -> bool:
    """Whether a placeholder is left unfilled."""
    if "`" in text or "<pre>" in text or "<code>" in text:
        text = CODE.sub(" ", text)
    spans = placeholders(text, words)
    if not spans or not TUTORIAL.search(text):
        return bool(spans)
    # the words of placeholders don't count
    parts, last = [], 0
    for a, b in spans:
        parts += [text[last:a], " " * (b - a)]
        last = b
    blank = "".join(parts) + text[last:]
    mentioned = []
    for k, (a, b) in enumerate(spans):
        begins = max((m.end() for m in SENTENCE_END.finditer(blank, spans[k - 1][1] if k and mentioned[-1] else 0, a)), default=None)
        if begins is None and k and mentioned[-1]:  # the same sentence goes on after a mentioned one
            mentioned.append(True)
        else:
            mentioned.append(bool(TUTORIAL.search(blank, begins or 0, a) or _CALLED.match(blank, b)))
    starts = [a for a, _ in spans]
    total = [0]
    for x in mentioned:
        total.append(total[-1] + x)
    for (a, b), is_mentioned in zip(spans, mentioned):
        if not is_mentioned:
            low, high = bisect_right(starts, a - AROUND_PLACEHOLDER), bisect_right(starts, b + AROUND_PLACEHOLDER)
            if (total[high] - total[low]) * 2 <= high - low:
                return True
    return False


# ---- page messages ----

# Words of page messages in lower case, each list a pattern of finitely many texts. "^" is the beginning of a sentence.
MESSAGES = {
    "script": r"java ?script|\bjs\b|\bskript(?:e|en)?\b|\bskripting\b|\bscripting\b|\bscripts?\b|aktiver? inhalte?\b|aktiven inhalte?\b|active content|contenus? actifs?",
    "script_state": r"aktivier|deaktiv|activat|désactiv|activer|enabl|disabl|block|bloqu|switched o|turned o|turn o|abgeschaltet|ausgeschaltet|eingeschaltet|einschalten|nicht aus\b|führt keine|not run|requires?\b|required|benötig|erforderlich|solange|können ohne|cannot|functional|noscript",
    "cookie": r"cookie",
    "cookie_state": r"akzept|ablehn|accept|reject|refus|verwend|utilis|\buse|enabl|activ|aktiv|zustimm|consent|einstellung|setting|paramètr",
    "subject": r"\b(?:seite|page|dokument|document|datei|file|vorschrift|fassung|normtext|volltext|inhalte?|content|contenu|text|texte|datensatz|record|fiche|eintrag|entry|treffer|anfragen?|requests?|requêtes?|abruf|download|chargement|server|serveur|zielserver|backend|host|upstream|dienst|service|portal|portail|datenbank|database|base de données|index|verbindung|connection|connexion|zugriff|zugang|access|accès|berechtigung|permission|droits|anmeldung|login|sitzung|session|token|jeton|kontingent|quota|link|lien|adresse|address|url|website|site|ressource|resource|viewer|browser|navigateur|suche|search|recherche|system|système|gateway|proxy|cache|konto|account|compte|schlüssel|key|clé|zertifikat|certificate)\b",
    "state": (
        r"nicht (?:mehr )?(?:verfügbar|erreichbar|gefunden|autorisiert|berechtigt|möglich|geladen|angezeigt|vorhanden|gültig|bereit|funktion)|steht (?:derzeit |zurzeit |momentan )?nicht zur verfügung|fehlgeschlagen|schlug fehl|gescheitert|abgebrochen|abgelaufen|\boffline\b|\bfehlt\b|ungültig|gelöscht|verschoben wurde|verschoben oder|verweigert|gesperrt|überlastet|erschöpft|unbekannt|reicht nicht aus|funktioniert nicht|antwortet nicht|existiert nicht|zurückgesetzt|gestört|wartung"
        r"|unavailable|not (?:found|available|authorized|authorised|valid|respond|reach|exist|load|allow|permitted)|no longer (?:valid|available|exist)|\bfailed\b|\bmissing\b|expired|\bdenied\b|forbidden|\bdown\b|refused|rejected|revoked|timed? ?-?out|time-?out|not responding|\bbusy\b|overloaded|used up|exceeded|invalid|does not exist|cannot be|could not be|can't be|being rebuilt|under maintenance|went wrong|unreachable|unknown\b|aborted|interrupted|locked"
        r"|introuvable|indisponible|inaccessible|expiré|refusée?|inconnue?|échoué|échec|hors (?:ligne|service)|manquante?|ne répond|plus (?:valable|valide|disponible)|n'existe|épuisé|supprimée? ou|déplacée?|impossible|interrompue?|dépassée?|non (?:autorisé|valide|trouvé|pris en charge)|invalide|bloquée?|en maintenance"
    ),
    "phrase": (
        r"\bnoscript\b|alle akzeptieren|accept all|tout accepter|internal server error|bad gateway|gateway time-?out|^traceback|stack ?trace|while reading from upstream|wartungsarbeiten|something went wrong|ein fehler ist aufgetreten|an error (?:has )?occurred|une erreur (?:est survenue|s'est produite)|timed out|délai dépassé|zeitüberschreitung|kein treffer\b|dynamisch geladen|not authorized|not authorised|nicht autorisiert|non autorisé|access denied|zugriff verweigert|accès refusé|permission denied|sign in again|melden sie sich|veuillez vous (?:re)?connecter|reconnectez-vous|zu viele anfragen|too many requests|trop de requêtes|sperre aktiv|you are (?:a )?human|captcha|checking your (?:connection|browser)|script ?blocker|ad ?blocker|log ?in again|please wait while|einen moment bitte|veuillez patienter|failed to load|nicht geladen werden|could not be loaded|cannot be (?:shown|displayed)|n'a pas pu être"
    ),
    # navigation and advice that occur on such pages only
    "advice": (
        r"volltextanzeige|^impressum\b|^startseite\b|^home >|zur startseite|zurück zur (?:übersicht|startseite|suche)|^go back|^retour à|^return to the|back to|reload th|laden sie (?:die seite |bitte )?neu|^neu laden|bitte laden|try again|\bretry\b|versuchen sie es|veuillez réessayer|réessay|see our help|help ?page|^hilfe zu|change your settings|help ?desk|wenden sie sich an (?:den|die|unseren|unsere) (?:support|hilfe|admin|technik)|contact (?:the|us|your) (?:help|support|admin|site)|contactez (?:le support|l'assistance|l'admin)|prüfen sie die adresse|check the address|vérifiez l'adresse|schalten sie die funktion|our team has been|unser team wurde|notre équipe a été|suche steht nicht bereit|(?:seite|ansicht) bleibt leer|page stays empty|page reste vide|viewer cannot start|text cannot be shown|^datenschutz\b"
    ),
    # what a number after it makes a message
    "head": r"\b(?:fehler|error|erreur|http(?:-fehler| error)?|status|code)\b",
    "filler": r"\blorem ipsum\b|\bblindtext (?:ohne|mit|zum)\b|\bist ein blindtext\b|\bsample text goes here\b|\b(?:your|insert) text (?:goes )?here\b|\bdummy text\b|\bfaux texte\b|\btexte factice\b|\bhier steht (?:ein |ihr |der )?(?:blind|muster|beispiel)?text\b",
    # what messages begin with that are no finite list: status numbers, traces, counted attempts, an owner's line
    "numbered": r"\b(?:4|5)(?:0|1|2|3|4|5|6|7|8|9)(?:0|1|2|3|4|5|6|7|8|9)|\bat |\bversuch |©",
    # what placeholders begin with that have no delimiter
    "form": r"\btbd|\btodo|\bfixme|\btba|\btt.|\bdd.|\bdd/|\bdd-|\byyyy|\bmm/|\bjj/|\bxx",
    "filler_word": r"text folgt|mustertext|blindtext|fülltext|beispieltext|platzhaltertext",
}
#: Messages that are no finite list, matched where one of their beginnings stands.
NUMBERED_MESSAGE = re.compile(
    r"[45]\d\d(?: ?[–:-] ?(?=[^\W\d_])| (?:not found|forbidden|unauthorized|bad gateway|service unavailable|internal server error|gateway))|at [a-z_]+\.[a-z_.]+ \((?:line \d+|[0-9a-f]{6,})\)|versuch \d+ von|©\s?[^\W\d_]+\W*$", re.M
)
_STATUS = re.compile(r"[ :#-]*[1-5]\d\d\b")
#: What stands around messages: codes, separators, navigation of short items.
AROUND = re.compile(
    r"\W*|[\W\d_]*[0-9a-f]{6,}\W*|.{0,40}\b[0-9a-f]{8}\b\W*|(?:[^|>]{1,30}[|>])+[^|>]{1,30}|(?:code|status|vorgang|ray|kennung|ref(?:erence|erenz)?|incident|request|id)\b[\s:#]*[0-9a-f-]+\W*", re.S
)
ALL_FILLER = re.compile(r"\W*(?:text folgt\W*)+|\W*(?:(?:muster|blind|füll|beispiel|platzhalter)text\W*){2,}")
#: A sentence counts as a message up to so many characters around the words that make it one: a short one as a whole, a long
#: one only by its parts near them. A subject and its state are at most so far apart.
MESSAGE_REACH = 220


def spelled(pattern: str) -> list[tuple[str, bool, bool, bool]]:
    """All texts of a finite pattern as (text, at a sentence's beginning, at a word's beginning, at a word's end).

    Knows literals, alternatives, groups, "?" after a letter or group, "\\b" and "^".
    """
    at = 0

    def alternatives() -> list[str]:
        nonlocal at
        out = list(sequence())
        while at < len(pattern) and pattern[at] == "|":
            at += 1
            out += sequence()
        return out

    def sequence() -> list[str]:
        nonlocal at
        texts = [""]
        while at < len(pattern) and pattern[at] not in "|)":
            if pattern.startswith("(?:", at):
                at += 3
                part = alternatives()
                at += 1
            elif pattern[at] == "\\":
                part, at = ["\b"], at + 2
            else:
                part, at = ["\a" if pattern[at] == "^" else pattern[at]], at + 1
            if at < len(pattern) and pattern[at] == "?":
                part, at = [*part, ""], at + 1
            texts = [a + b for a in texts for b in part]
        return texts

    return [(x.strip("\a\b"), x.startswith("\a"), x.startswith("\b"), x.endswith("\b")) for x in dict.fromkeys(alternatives())]


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    words: dict[str, list[tuple[str, bool, bool, bool]]] = {}
    for kind, pattern in MESSAGES.items():
        for text, *place in spelled(pattern):
            words.setdefault(text, []).append((kind, *place))
    automaton = ahocorasick.Automaton()
    for text, uses in words.items():
        automaton.add_word(text, (len(text), tuple(uses)))
    automaton.make_automaton()
    return automaton


def _in_word(c: str) -> bool:
    return c.isalnum() or c == "_"


def _hits(low: str) -> dict[str, list[tuple[int, int]]]:
    """(start, end) by kind of all words of MESSAGES in a text in lower case; those that open a sentence are not yet checked."""
    out: dict[str, list[tuple[int, int]]] = {}
    n = len(low)
    for last, (length, uses) in _automaton().iter(low):
        start, end = last + 1 - length, last + 1
        for kind, opens, word_begins, word_ends in uses:
            if word_begins and start and _in_word(low[start - 1]) and _in_word(low[start]):
                continue
            if word_ends and end < n and _in_word(low[end]) and _in_word(low[last]):
                continue
            if opens or kind == "head":
                if kind == "head" and not _STATUS.match(low, end):
                    continue
                out.setdefault("opens" if opens else "phrase", []).append((start, end))
            else:
                out.setdefault(kind, []).append((start, end))
    return out


def _near(a: list[tuple[int, int]], b: list[tuple[int, int]], reach: int) -> list[tuple[int, int]]:
    """The spans from one of ``a`` to the nearest of ``b`` on either side, up to ``reach`` long; both sorted by start."""
    starts = [x for x, _ in b]
    out = []
    for s, e in a:
        k = bisect_right(starts, s)
        for t, u in b[max(0, k - 1) : k + 1]:
            low, high = min(s, t), max(e, u)
            if high - low <= reach:
                out.append((low, high))
    return out


def is_page(low: str, hits: dict[str, list[tuple[int, int]]]) -> bool:
    """Whether most of a text in lower case is messages and what stands around them."""
    numbered = [(m.start(), m.end(), m.group()) for s, _ in hits.get("numbered", ()) if (m := NUMBERED_MESSAGE.match(low, s))]
    pairs = (("script", "script_state"), ("cookie", "cookie_state"), ("subject", "state"))
    if not (numbered or hits.keys() & {"phrase", "advice", "opens"} or any(a in hits and b in hits for a, b in pairs)):
        return False
    ends = [(m.start(), m.end()) for m in SENTENCE_END.finditer(low)]
    begin = [0, *[e for _, e in ends]]
    final = [*[s for s, _ in ends], len(low)]
    inside = lambda x: bisect_right(begin, x) - 1
    spans = [*hits.get("phrase", ()), *hits.get("advice", ())]
    for s, e, what in numbered:
        lead = low[begin[inside(s)] : s]
        if what[0] == "v" or what[-1].isalpha() or not any(map(_in_word, lead)):  # else it must open its sentence
            spans.append((s, e))
    spans += [(s, e) for s, e in hits.get("opens", ()) if not low[begin[inside(s)] : s].strip()]
    for a, b in pairs:
        if a in hits and b in hits:
            one, two = sorted(hits[a]), sorted(hits[b])
            spans += [(s, e) for s, e in (*_near(one, two, MESSAGE_REACH), *((y, z) for y, z in _near(two, one, MESSAGE_REACH))) if inside(s) == inside(e - 1)]
    if not spans:
        return False
    by_sentence: dict[int, list[tuple[int, int]]] = {}
    for s, e in spans:
        by_sentence.setdefault(inside(s), []).append((s, e))
    sure = may = total = 0
    for k, (s, e) in enumerate(zip(begin, final)):
        while s < e and low[s].isspace():
            s += 1
        while s < e and low[e - 1].isspace():
            e -= 1
        if s == e:
            continue
        total += e - s
        if k in by_sentence:
            covered, reached = 0, s
            for a, b in sorted(by_sentence[k]):
                side = max(0, MESSAGE_REACH - (b - a)) // 2
                low_end, high_end = (s, e) if e - s <= MESSAGE_REACH else (max(reached, a - side), min(e, b + side))
                low_end = max(low_end, reached)
                if high_end > low_end:
                    covered += high_end - low_end
                    reached = high_end
            sure += covered
            may += covered
        elif AROUND.fullmatch(low, s, e):
            may += e - s
    return sure > 0 and may * 2 > total


# ---- filler ----

#: Function words of which any passage of German, English or French prose has several.
FUNCTION_WORDS = frozenset(
    "der die das den dem des ein eine einer eines und oder ist sind wird werden für von vom zu zur zum mit nach auf im in an am bei nicht sich auch wer so soweit sofern durch über aus als nur es er sie gilt hat "
    "the of and or to is are be by for on at if that this shall may must not with as from which any a "
    "le la les l un une et ou est sont de du d dans par pour sur au aux que qui ne pas en ce cette à s".split()
)
#: Least words of a text that is judged by its function words, and their least share.
LEAST_WORDS, LEAST_SHARE = 6, 0.04
#: Least letters of a sentence that makes a text filler if the text says nothing else, and how often it must be there.
LEAST_SENTENCE, LEAST_TIMES = 12, 3
_WORD = re.compile(r"[^\W_]+")


def is_filler(low: str, hits: dict[str, list[tuple[int, int]]]) -> bool:
    if "filler" in hits or ("filler_word" in hits and ALL_FILLER.fullmatch(low)):
        return True
    # a text of n letters has (n + 1) / 2 words at most; with function words enough for so many it needs no closer look
    plenty = sum(map(FUNCTION_WORDS.__contains__, low.split())) * 2 >= LEAST_SHARE * (len(low) + 1)
    words = () if plenty else _WORD.findall(low)
    if len(words) >= LEAST_WORDS and sum(map(FUNCTION_WORDS.__contains__, words)) < LEAST_SHARE * len(words):
        # only words in Latin letters: the function words are of three languages
        letters = sum(1 for w in words if len(w) > 1 and "a" <= w < "Ͱ")
        if letters >= LEAST_WORDS and letters * 2 > len(words):
            return True
    at = 0
    for m in SENTENCE_END.finditer(low):
        first, at = low[at : m.start()].strip(), m.end()
        if len(first) >= LEAST_SENTENCE:
            # the first long sentence must be most of the text before all of it is looked at
            if low.count(first) < LEAST_TIMES:
                return False
            pieces = [p for p in map(str.strip, SENTENCE_END.split(low)) if len(p) >= LEAST_SENTENCE]
            return len(pieces) >= LEAST_TIMES and all(p == first for p in pieces)
    return False


def judge(text: str | None) -> tuple[bool, bool, bool]:
    """(has_placeholder, is_page, is_filler) of one text."""
    if text is None or not text.strip():
        return False, False, False
    low = text.lower()
    hits = _hits(low)
    return has_placeholder(text, "form" in hits), is_page(low, hits), is_filler(low, hits)


_FLAGS = ("has_placeholder", "is_page", "is_filler")


def _judged(documents: DataFrame) -> DataFrame:
    """The documents as one struct column ``_d`` and the three flags, so that no names can clash."""
    held = documents.select(F.struct(*[documents[f"`{c}`"] for c in documents.columns]).alias("_d"), F.col("text").cast("string").alias("_t"))
    schema = T.StructType([held.schema["_d"], *[T.StructField(f, T.BooleanType()) for f in _FLAGS]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = [judge(t) for t in batch.column(1).to_pylist()]
            columns = zip(*flags) if flags else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.bool_()) for c in columns]], ["_d", *_FLAGS])

    return held.mapInArrow(run, schema)


def residue(documents: DataFrame) -> DataFrame:
    """documents(doc_id, text, ...) with three more columns: has_placeholder, is_page, is_filler.

    A null or empty text is none of them. All three are decided over the whole text of any length; repeated rows are judged
    alike. Other columns pass through, but columns with the names of the three are replaced.
    """
    kept = [c for c in documents.columns if c not in _FLAGS]
    return _judged(documents).select(*[F.col("_d")[c].alias(c) for c in kept], *_FLAGS)


def without_residue(documents: DataFrame) -> DataFrame:
    """The documents that are none of it, with their own columns."""
    clean = _judged(documents).where("not (has_placeholder or is_page or is_filler)")
    return clean.select(*[F.col("_d")[c].alias(c) for c in documents.columns])
