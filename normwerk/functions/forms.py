"""More rules on single values: titles and citations, page ranges, URLs, escapes, checks of answers, graph properties."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import normalize as N

# ---- names ----


def alias_key(x: Column) -> Column:
    """A document's alias as target keys are written: any type, letter case folded, umlauts and § spelled out."""
    return N.slug(x.cast("string"))


def graph_name(x: Column) -> Column:
    """A name for a label or file: letters, digits and underscores."""
    return F.regexp_replace(x, "[^A-Za-z0-9_]", "_")


def file_slug(x: Column) -> Column:
    """A name for a downloaded file; ``document`` if nothing is left."""
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("Ä", "Ae"), ("Ö", "Oe"), ("Ü", "Ue"), ("ß", "ss")):
        x = F.replace(x, F.lit(a), F.lit(b))
    out = F.lower(F.btrim(F.regexp_replace(N.ascii_only(x), "[^A-Za-z0-9]+", "_"), F.lit("_")))
    return F.when(out == "", "document").otherwise(out)


def register_key(x: Column) -> Column:
    """The register's alias: written and read by one rule, words of plain letters and digits with single spaces."""
    return F.btrim(F.regexp_replace(F.lower(N.ascii_only(N.casefold(x))), "[^a-z0-9]+", " "))


# Endings of a leading adjective that change with the case, by the legal form that a name ends with.
INFLECTED = ((("gesetz", "gesetzbuch"), "es"), (("verordnung", "ordnung"), "e"), (("vertrag",), "er"))


def inflected_keys(x: Column) -> Column:
    """The name's slug and, if it begins with an adjective and ends with a legal form, the slug in the other case."""
    own = N.slug(x)
    first, rest = F.split_part(own, F.lit("_"), F.lit(1)), F.regexp_extract(own, "^[^_]*(_.*)$", 1)
    other = F.lit(None).cast("string")
    for forms, ending in reversed(INFLECTED):
        named = F.lit(False)
        for f in forms:
            named = named | own.endswith(f)
        bare = lambda n: F.substring(first, F.lit(1), F.char_length(first) - n)
        turned = F.when(first.endswith("en"), F.concat(bare(2), F.lit(ending))).when(first.endswith(ending), F.concat(bare(len(ending)), F.lit("en")))
        other = F.when(named, turned).otherwise(other)
    whole = F.when((rest != "") & other.isNotNull(), F.concat(other, rest))
    return F.when(own == "", F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(F.array_compact(F.array(own, whole)))))


def clean_citation(x: Column) -> Column:
    return F.trim(F.btrim(F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"\s+", " ")), F.lit('"')))


# Where a full citation goes on after the title.
TITLE_ENDS = (r"\s+in\s+der\s+Fassung\b", r"\s+in\s+der\s+im\s+Bundesgesetzblatt\b", r",\s+d(?:as|ie|er)\s+zuletzt\b", r",\s+zuletzt\b", r"\s+vom\s+\d{1,2}\.\s+[A-ZÄÖÜa-zäöüß]+\s+\d{4}\b")


def title_of_citation(x: Column) -> Column:
    """The citation up to the first rule of TITLE_ENDS that applies beyond its first five characters; null if blank."""
    cleaned = clean_citation(x)
    out = cleaned
    for rule in reversed(TITLE_ENDS):
        at = F.regexp_instr(cleaned, F.lit(rule))
        out = F.when(at > 6, F.trim(F.substring(cleaned, F.lit(1), at - 1))).otherwise(out)
    return F.when(cleaned != "", out)


def without_footnote_marks(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"(?:\s*\[[^\[\]\r\n]+\])+\s*$", ""))


def plausible_law_name(x: Column) -> Column:
    """Whether a text may be a law's name: some words, 18 at most, none of a clause."""
    plain = F.lower(F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"\s+", " ")))
    clause = r"^artikels?\b|\binnerhalb\s+eines?\b|\bnach\s+dem\s+inkrafttreten\b|\btaeter\s+als\s+amtstraeger\b|\bzur\s+mitwirkung\s+bei\s+dem\b|\b(?:ist|sind|wird|werden|wurde|wurden|gilt|gelten)\s+(?:anzuwenden|angeordnet|beruecksichtigt|berücksichtigt)\b"
    return (plain != "") & (F.size(F.split(plain, " ")) <= 18) & ~plain.rlike(clause)


# ---- texts for alignment and benchmarks ----

# Words that don't tell pages apart.
STOP_WORDS = "als am an auf aus bei bis das dem den der des die durch ein eine einem einen einer für im in ist mit nach oder sich sind und von vor zu zum zur".split()


def alignment_text(x: Column) -> Column:
    """Soft hyphens and broken words joined, dashes made one, letter case and white space folded."""
    out = F.translate(F.coalesce(x, F.lit("")), "\u0000\u00ad", "")
    out = F.lower(F.regexp_replace(out, r"(?<=\p{L})[-‐]\s*\n\s*(?=\p{Ll})", ""))
    return F.btrim(F.regexp_replace(F.translate(out, "‐‑‒–—−\u00a0", "------ "), r"\s+", " "))


def alignment_tokens(x: Column) -> Column:
    words = F.regexp_extract_all(alignment_text(x), F.lit(r"[\p{L}\p{N}§]+"), 0)
    return F.filter(words, lambda w: (F.char_length(w) >= 2) & ~w.isin(*STOP_WORDS))


def answer_text(x: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(x), "[^0-9a-zäöüß§]+", " "))


def word_count(x: Column) -> Column:
    return F.regexp_count(x, F.lit(r"(?<![0-9A-Za-zÄÖÜäöüß_])[0-9A-Za-zÄÖÜäöüß]+(?:[-'][0-9A-Za-zÄÖÜäöüß]+)*(?![0-9A-Za-zÄÖÜäöüß_])"))


def result_item(x: Column) -> Column:
    """An item of a result list: upper case, one § sign, no full stops, single spaces."""
    return F.regexp_replace(F.replace(F.replace(F.upper(F.btrim(x)), F.lit("§§"), F.lit("§")), F.lit("."), F.lit("")), r"\s+", " ")


def contains_all(answer: Column, values: list[str]) -> Column:
    """The share of the values that an answer contains, letter case aside."""
    low = N.casefold(answer)
    hits = [F.when(low.contains(v.lower().replace("ß", "ss")), 1.0).otherwise(0.0) for v in values]
    return sum(hits[1:], hits[0]) / float(len(values)) if values else F.lit(0.0)


def contains_any(answer: Column, values: list[str]) -> Column:
    return F.when(contains_all(answer, values) > 0, 1.0).otherwise(0.0)


def contains_groups(answer: Column, groups: list[list[str]]) -> Column:
    """The share of the groups of which an answer contains a value."""
    hits = [contains_any(answer, g) for g in groups]
    return sum(hits[1:], hits[0]) / float(len(groups)) if groups else F.lit(0.0)


def contains_normalized(answer: Column, value: str) -> Column:
    wanted = answer_text(F.lit(value))
    return F.when((wanted != "") & answer_text(answer).contains(wanted), 1.0).otherwise(0.0)


def words_between(answer: Column, low: int, high: int) -> Column:
    return F.when(word_count(answer).between(low, high), 1.0).otherwise(0.0)


def result_set(answer: Column, prefix: str) -> Column:
    """The items of the one line that begins with the prefix; none if there is no such line, or several."""
    quoted = "".join("\\" + c if not c.isalnum() and c.isascii() else c for c in prefix)
    lines = F.regexp_extract_all(answer, F.lit(rf"(?im)^[ \t]*{quoted}[ \t]*(.*?)[ \t]*$"), 1)
    items = F.filter(F.transform(F.split(F.get(lines, 0), ";"), result_item), lambda i: i != "")
    return F.when(F.size(lines) == 1, F.array_sort(F.array_distinct(items))).otherwise(F.array().cast("array<string>"))


def set_f1(actual: Column, expected: Column) -> Column:
    """Harmonic mean of precision and recall of two sets of items."""
    both, n = F.size(F.array_intersect(actual, expected)), F.size(actual) + F.size(expected)
    return F.when(both > 0, 2.0 * both / n).otherwise(0.0)


# ---- numbers and ranges ----


def safe_int(x: Column) -> Column:
    return F.btrim(x.cast("string")).try_cast("int")


def page_label(start: Column, end: Column) -> Column:
    return F.when(start.isNull(), F.lit(None).cast("string")).when(start == end, F.concat(F.lit("S. "), start.cast("string"))).otherwise(F.concat(F.lit("S. "), start.cast("string"), F.lit("–"), end.cast("string")))


def ranges_overlap(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Whether [a, b] and [c, d] share a page; false if any bound is missing."""
    return F.coalesce((a <= d) & (c <= b), F.lit(False))


def page_range_fault(start: Column, end: Column, pages: Column) -> Column:
    """What is wrong with a page range of a file of so many pages; null if nothing, or if there is none."""
    return (
        F.when(start.isNull() & end.isNull(), F.lit(None).cast("string")).when(start.isNull() | end.isNull(), "not_integers").when((start < 1) | (end < start), "not_ordered")
        .when(F.coalesce(pages, F.lit(0)) <= 0, "no_pages").when(end > pages, "beyond_pages")
    )


def cost_bound(text: Column, price_per_million: float) -> Column:
    """An upper bound of what embedding all texts costs: three tokens a byte and 64 bytes more for each."""
    return F.sum(F.octet_length(text) + 64) * 3 * price_per_million / 1e6


# ---- escapes and addresses ----


def cypher_text(x: Column) -> Column:
    """A text as a literal of a graph statement."""
    out = F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    return F.concat(F.lit("'"), F.replace(F.replace(out, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")), F.lit("'"))


def html_text(x: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def canonical_url(x: Column, hosts: list[str]) -> Column:
    """An absolute address of a known host: https, lower-case host, single slashes, no fragment; null for any other."""
    plain = F.btrim(x)
    scheme, host, path, query = (F.regexp_extract(plain, r"^(?i)(https?)://([^/?#@]+)([^?#]*)(\?[^#]*)?", i) for i in (1, 2, 3, 4))
    known = F.lower(host).isin(*hosts) & ~plain.rlike(r"[\x00-\x1f\x7f]")
    return F.when((scheme != "") & known, F.concat(F.lit("https://"), F.lower(host), F.regexp_replace(F.when(path == "", "/").otherwise(path), "/+", "/"), query))


def law_key_of_url(x: Column, hosts: list[str]) -> Column:
    """The folder of a law's page or package."""
    plain = F.regexp_replace(canonical_url(x, hosts), r"\?.*$", "")
    folder = F.regexp_replace(plain, r"(?i)/(?:index\.html|[^/]*\.zip)/?$", "/")
    return F.concat(F.regexp_replace(folder, "/+$", ""), F.lit("/"))


def package_url(x: Column, hosts: list[str]) -> Column:
    return F.concat(F.regexp_replace(canonical_url(x, hosts), r"[^/]*(?:\?.*)?$", ""), F.lit("xml.zip"))


# ---- structure ----


def is_repealed(x: Column) -> Column:
    return F.coalesce(x.rlike(r"(?iu)\b(?:weggefallen|aufgehoben|außer\s+kraft)\b"), F.lit(False))


def table_cue(x: Column) -> Column:
    """(label, continuation, title) of a line that announces a table; null if it doesn't."""
    rule = r"(?is)^\s*(Fortsetzung\s+)?Tabelle\s+(\d+[a-z]?)\s*:?\s*(.*)$"
    part = lambda i: F.regexp_extract(x, rule, i)
    title = F.btrim(F.regexp_replace(part(3), r"\s+", " "))
    return F.when(x.rlike(rule), F.struct(F.concat(F.lit("Tabelle "), part(2)).alias("label"), (part(1) != "").alias("continuation"), title.alias("title")))


def is_unavailable_table(x: Column) -> Column:
    return F.coalesce(x.rlike(r"(?i)\bnicht\s+darstellbar"), F.lit(False))


def row_marker(row: Column) -> Column:
    """What a table row is called in reports: the field of a number or parameter, else its first value. ``row`` is JSON text."""
    fields = F.from_json(row, "map<string,string>")
    listed = F.from_json(row, "array<string>")
    named = F.coalesce(*[fields[k] for k in ("Einbauweise Nummer", "Nummer", "Parameter")], F.get(F.map_values(fields), 0))
    return F.btrim(F.when(row.rlike(r"^\s*\{"), F.coalesce(named, F.lit(""))).when(row.rlike(r"^\s*\["), F.coalesce(F.get(listed, 0), F.lit(""))).otherwise(F.split_part(F.btrim(row), F.lit(" "), F.lit(1))))


def best_citation(*candidates: Column) -> Column:
    """The first of an item's names that is not blank."""
    return F.coalesce(*[F.when(c != "", c) for c in candidates], F.lit("<unknown>"))


def sorted_json(fields: dict[str, Column]) -> Column:
    """The fields that are not null as JSON with its keys in order."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))


def preview(text: Column, width: int = 500) -> Column:
    """The beginning of a text on one line, with a mark where it is cut."""
    line = F.btrim(F.regexp_replace(text, r"\s+", " "))
    return F.when(F.char_length(line) > width, F.concat(F.rtrim(F.substring(line, 1, width - 1)), F.lit("…"))).otherwise(line)
