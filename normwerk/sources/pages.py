"""XHTML acts and the texts of pages: units from ids and markers, page texts of two readers, lines, passages, anomalies.

Reading the bytes of a PDF is left to a reader outside; what it gives, a text or words with their places a page, is taken from
here on. Rows of acts are tagged as those of ``acts``: (path, record_kind, record_id, parent_id, position, fields).
"""

from __future__ import annotations

import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .acts import EMITTED, short_hash

# What a file is, by its media type or else its suffix.
MEDIA = {"application/xhtml+xml": "xhtml", "text/html": "html", "application/pdf": "pdf", "application/zip": "package", "application/xml": "xml", "text/xml": "xml"}
SUFFIXES = {".xhtml": "xhtml", ".html": "html", ".htm": "html", ".pdf": "pdf", ".zip": "package", ".xml": "xml"}
MARKER = re.compile(r"^\s*(?:(Artikel|Article)\s+(\d+[a-z]?)|(ANHANG|ANNEX|Anhang|Annex)\b\s*([IVXLC]+|\d+)?)\s*$")
_BLOCK_TAGS = {"p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "tr", "table", "br"}


def kind_of(path: Column, media: Column) -> Column:
    """The reader that a file goes to; an unknown one raises when it is read."""
    named = F.create_map(*[F.lit(x) for pair in MEDIA.items() for x in pair])[F.lower(F.split_part(media, F.lit(";"), F.lit(1)))]
    ending = F.create_map(*[F.lit(x) for pair in SUFFIXES.items() for x in pair])[F.lower(F.regexp_extract(path, r"(\.[A-Za-z0-9]+)$", 1))]
    return F.coalesce(named, ending, F.raise_error(F.concat(F.lit("unknown format: "), path)).cast("string"))


def _local(e: ET.Element) -> str:
    return e.tag.rsplit("}", 1)[-1].lower() if isinstance(e.tag, str) else ""


def visible(node: ET.Element) -> str:
    """The text that a page shows, one line a block, white space collapsed."""
    out: list[str] = []

    def walk(e: ET.Element) -> None:
        name = _local(e)
        if name in ("script", "style", "head", ""):
            return
        if name in _BLOCK_TAGS:
            out.append("\n")
        out.append(e.text or "")
        for child in e:
            walk(child)
            out.append(child.tail or "")
        if name in _BLOCK_TAGS:
            out.append("\n")

    walk(node)
    lines = (re.sub(r"\s+", " ", x).strip() for x in "".join(out).split("\n"))
    return "\n".join(x for x in lines if x)


def marked_units(text: str) -> list[tuple[str, str, int, int]]:
    """(kind, number, start, end) of the articles and annexes that lines alone mark; annex numbers never go back."""
    units: list[tuple[str, str, int]] = []
    at, annexes = 0, 0
    for line in text.splitlines(keepends=True):
        m = MARKER.match(line)
        if m and m[1]:
            units.append(("article", m[2].lower(), at))
        elif m:
            roman = dict(I=1, V=5, X=10, L=50, C=100)
            n = int(m[4]) if m[4] and m[4].isdigit() else sum(-roman[a] if roman[a] < roman.get(b, 0) else roman[a] for a, b in zip(m[4], m[4][1:] + " ")) if m[4] else annexes + 1
            if n > annexes:
                annexes = n
                units.append(("annex", str(n), at))
        at += len(line)
    ends = [u[2] for u in units[1:]] + [len(text)]
    return [(*u, e) for u, e in zip(units, ends)]


def xhtml_act(path: str, data: str) -> Iterator[tuple[str, str, str, int, dict]]:
    """An act by the ids and classes of its elements; one that is no well-formed XML by the lines that mark its units."""
    document = f"doc_{short_hash(path)}"
    try:
        root = ET.fromstring(data)
    except ET.ParseError:
        text = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ", data)
        text = re.sub(r"(?i)<(?:br|/?p|/?div|/?tr|/?li|/?h\d)\b[^>]*>", "\n", text)
        text = "\n".join(x for x in (re.sub(r"\s+", " ", y).strip() for y in re.sub(r"<[^>]*>", "", text).split("\n")) if x)
        yield "document", document, "", 0, {"title": text.split("\n", 1)[0], "parser": "lines"}
        for n, (kind, number, a, b) in enumerate(marked_units(text), 1):
            unit = f"{document}_{'art' if kind == 'article' else 'anhang'}_{number}"
            yield "unit", unit, document, n, {"unit_type": kind, "number": number, "label": text[a:b].split("\n", 1)[0]}
            yield "chunk", f"{unit}_text", unit, n, {"chunk_type": f"{kind}_text", "text": text[a:b].strip()}
        return
    classes = lambda e: (e.get("class") or "").split()
    title = next((visible(e) for e in root.iter() if "eli-main-title" in classes(e)), "")
    yield "document", document, "", 0, {"title": title, "parser": "xhtml"}
    n = 0
    for kind, wanted in (("preamble", r"pbl_.*"), ("article", r"art_\d+[a-z]?"), ("annex", r"anx_\w+")):
        found = [e for e in root.iter() if _local(e) == "div" and re.fullmatch(wanted, e.get("id") or "", re.I)]
        for ordinal, e in enumerate(found[:1] if kind == "preamble" else found, 1):
            text = visible(e)
            if not text:
                continue
            n += 1
            label = next((visible(c) for c in e.iter() if "oj-ti-art" in classes(c)), "") if kind == "article" else ""
            m = re.search(r"(\d+[a-z]?)", label, re.I)
            number = m[1].lower() if m else str(ordinal)
            unit = f"{document}_{dict(preamble='preambel', article=f'art_{number}', annex=f'anhang_{ordinal}')[kind]}"
            yield "unit", unit, document, n, {"unit_type": kind, "number": number, "label": label, "source_xml_identifier": e.get("id")}
            yield "chunk", f"{unit}_text", unit, n, {"chunk_type": f"{kind}_text", "text": text, "source_xml_identifier": e.get("id")}


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [*[pa.string()] * 4, pa.int32(), pa.string()]
    for batch in batches:
        for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows = [(path, *r[:4], json.dumps(r[4], ensure_ascii=False)) for r in xhtml_act(path, data or "")]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], [x.split(" ")[0] for x in EMITTED.split(", ")])


def extract_xhtml(files: DataFrame) -> DataFrame:
    """files(path, html) -> tagged rows."""
    return files.select("path", "html").mapInArrow(_extract, EMITTED)


# ---- texts of two readers ----


def longer_text(first: Column, second: Column) -> Column:
    """The first reader's text unless the second's is over 5 % longer."""
    n = lambda c: F.char_length(F.coalesce(c, F.lit("")))
    return F.when(n(second) > 1.05 * n(first), second).otherwise(first)


def text_for_alignment(first: Column, second: Column) -> Column:
    """The first reader's text; where it has under 16 letters, the second's if that is over a quarter longer."""
    plain = lambda c: F.char_length(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", ""))
    return F.when((plain(first) < 16) & (plain(second) > 1.25 * plain(first)), second).otherwise(first)


def without_running_lines(lines: DataFrame, share: float = 0.5) -> DataFrame:
    """lines(document_id, page, line_no, text) without headers and footers: lines that stand, numbers aside, on over ``share`` of
    a document's pages, if it has three or more."""
    shape = F.regexp_replace(F.trim("text"), r"\d+", "#")
    pages = lines.groupBy("document_id").agg(F.countDistinct("page").alias("_pages"))
    running = lines.where("trim(text) <> ''").groupBy("document_id", shape.alias("_shape")).agg(F.countDistinct("page").alias("_n")).join(pages, "document_id").where((F.col("_pages") >= 3) & (F.col("_n") > share * F.col("_pages"))).select("document_id", "_shape")
    return lines.withColumn("_shape", shape).join(running, ["document_id", "_shape"], "left_anti").drop("_shape")


HEADING = r"^\s*(?:§\s*\d+[a-z]?\b|(?:Artikel|Art\.)\s*\d+[a-z]?\b|(?:Anlage|Anhang)\s*\w*\s*(?:\(|$))"


def statute_units(lines: DataFrame) -> DataFrame:
    """lines(document_id, page, line_no, text) -> (document_id, segment, heading, page_start, page_end, n_lines): from one heading
    to the next. A line that only begins like a heading but goes on in lower case is none."""
    by = Window.partitionBy("document_id").orderBy("page", "line_no")
    heading = F.col("text").rlike(HEADING) & ~F.col("text").rlike(r"^\s*(?:§\s*\d+[a-z]?|Art(?:ikel|\.)\s*\d+[a-z]?)\s+(?:[a-zäöü]|Abs|Satz|Nr)")
    cut = lines.withColumn("segment", F.sum(F.when(heading, 1).otherwise(0)).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    first = F.min_by(F.trim("text"), F.struct("page", "line_no"))
    return cut.where("segment > 0").groupBy("document_id", "segment").agg(first.alias("heading"), F.min("page").alias("page_start"), F.max("page").alias("page_end"), F.count(F.lit(1)).alias("n_lines"))


def waste_codes(lines: DataFrame) -> DataFrame:
    """(document_id, page, line_no, code, hazardous, name) of the lines that are entries of a list of waste codes."""
    rule = r"^\s*(\d{2}) ?(\d{2}) ?(\d{2})\s?(\*?)\s+(\S.*?)\s*$"
    part = lambda i: F.regexp_extract("text", rule, i)
    return lines.where(F.col("text").rlike(rule)).select("document_id", "page", "line_no", F.concat_ws(" ", part(1), part(2), part(3)).alias("code"), (part(4) == "*").alias("hazardous"), part(5).alias("name"))


def anomalies(lines: DataFrame, rules: DataFrame) -> DataFrame:
    """(document_id, page, rule, line) of what the rules find, each once. rules(rule, pattern): a list written by hand."""
    return lines.crossJoin(F.broadcast(rules.limit(10_000))).where(F.expr("text rlike pattern")).select("document_id", "page", "rule", F.trim("text").alias("line")).distinct()


def first_page(pages: DataFrame) -> DataFrame:
    """(document_id, title, abbreviation, issued, state) from the first page of each document."""
    text = F.col("text")
    first = pages.where("page = 1")
    title = F.trim(F.regexp_extract(text, r"^\s*(\S[^\n]*)", 1))
    return first.select(
        "document_id", title.alias("title"), F.regexp_extract(text, r"\(([A-ZÄÖÜ][\w-]*[A-Z][\w-]*)\)", 1).alias("abbreviation"),
        F.regexp_extract(text, r"(?:Ausfertigungsdatum:|vom)\s+(\d{1,2}\.\s?(?:\d{1,2}\.|\w+)\s?\d{4})", 1).alias("issued"), F.regexp_extract(text, r"(?i)(?:zuletzt geändert durch|stand:)\s*([^\n]+)", 1).alias("state"),
    )


def nearest_by_pages(wanted: DataFrame, units: DataFrame, key: str) -> DataFrame:
    """Units of equal key are told apart by pages: the one that overlaps the wanted pages most, then the first.

    wanted(key, page_start, page_end), units(key, unit_id, unit_start, unit_end).
    """
    both = wanted.join(units, key)
    shared = F.greatest(F.lit(0), F.least("page_end", "unit_end") - F.greatest("page_start", "unit_start") + 1)
    best = Window.partitionBy(key, "page_start", "page_end").orderBy(F.coalesce(shared, F.lit(0)).desc(), "unit_id")
    return both.withColumn("_n", F.row_number().over(best)).where("_n = 1").select(key, "page_start", "page_end", "unit_id")


# ---- passages ----


def paragraphs(text: str) -> list[tuple[str, str]]:
    """(heading, paragraph) of a page's text: blank lines part paragraphs, a short line without an end stop is a heading that stays."""
    out, heading = [], ""
    for block in re.split(r"\n\s*\n", text):
        plain = re.sub(r"\s+", " ", block).strip()
        if not plain:
            continue
        if len(plain) <= 120 and not re.search(r"[.;:,]$", plain) and re.match(r"(?:\d+(?:\.\d+)*\.?\s+)?[A-ZÄÖÜ]", plain):
            heading = plain
        else:
            out.append((heading, plain))
    return out


def passages(text: str, size: int = 800, overlap: int = 120) -> list[tuple[str, str]]:
    """(heading, passage): paragraphs of one heading packed up to ``size`` tokens; longer ones in windows with an overlap."""
    out: list[tuple[str, str]] = []
    held: list[str] = []
    last = ""

    def flush() -> None:
        if held:
            out.append((last, " ".join(held)))
            held.clear()

    for heading, paragraph in paragraphs(text):
        tokens = paragraph.split()
        if heading != last or len(held) + len(tokens) > size:
            flush()
            last = heading
        if len(tokens) > size:
            flush()
            at = 0
            while True:
                out.append((heading, " ".join(tokens[at : at + size])))
                if at + size >= len(tokens):
                    break
                at = max(at + size - overlap, at + 1)
        else:
            held.extend(tokens)
    flush()
    return out


def _passages(size: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(d, p, n, *x) for d, p, t in zip(*(batch.column(k).to_pylist() for k in range(3))) if t for n, x in enumerate(passages(t, size, overlap))]
            types = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [()] * 5, types)], ["document_id", "page", "ordinal", "heading", "text"])

    return run


def page_passages(pages: DataFrame, size: int = 800, overlap: int = 120) -> DataFrame:
    """pages(document_id, page, text) -> (document_id, page, ordinal, heading, text)."""
    chosen = pages.select(F.col("document_id").cast("string").alias("document_id"), F.col("page").cast("int").alias("page"), "text")
    return chosen.mapInArrow(_passages(size, overlap), "document_id string, page int, ordinal int, heading string, text string")


