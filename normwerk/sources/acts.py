"""Statutes and acts in XML to tagged rows of documents, units, chunks and table rows, one pass over each package.

Two formats are read: ``dokumente`` (a list of norms, each with meta data and text, divisions ranked by a numeric code) and
``CONS.ACT`` / ``ACT`` (title, preamble with recitals, articles inside divisions, annexes with tables). Rows are of the form
(path, record_kind, record_id, parent_id, position, fields), the same as for nested payloads.
"""

from __future__ import annotations

import hashlib
import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

EMITTED = "path string, record_kind string, record_id string, parent_id string, position int, fields string"


def short_hash(*parts: str, n: int = 12) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()[:n]


def slug(text: str) -> str:
    for a, b in (("§", "para"), ("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss")):
        text = text.lower().replace(a, b)
    return re.sub(r"[^a-z0-9]+", "_", text).strip("_")


# Elements that stand apart from the text around them.
BLOCKS = frozenset("BR br P DL DT DD LA NO.PARAG NO.P ALINEA PARAG LIST ITEM NP TXT TITLE TI STI TI.ART STI.ART GR.SEQ".split())


def flat(node: ET.Element | None, skip: tuple[str, ...] = ()) -> str:
    """All text below a node with white space collapsed, without what is below the tags of ``skip``."""
    if node is None:
        return ""
    out: list[str] = []

    def walk(e: ET.Element) -> None:
        out.append(e.text or "")
        for child in e:
            if child.tag in BLOCKS:
                out.append(" ")
            if child.tag not in skip:
                walk(child)
            if child.tag in BLOCKS:
                out.append(" ")
            out.append(child.tail or "")

    walk(node)
    return re.sub(r"\s+", " ", "".join(out).replace(" ", " ")).strip()


def expand(cells: list[list[tuple[str, int, int]]], width: int) -> list[list[str]]:
    """Rows of (text, column span, row span) to a dense matrix; a spanned place repeats its text."""
    out: list[list[str]] = []
    pending: dict[int, tuple[str, int]] = {}
    for row in cells:
        line: list[str] = []
        todo = list(row)
        column = 0
        while todo or any(c >= column for c in pending):
            if column in pending:
                text, left = pending.pop(column)
                line.append(text)
                if left > 1:
                    pending[column] = (text, left - 1)
                column += 1
            elif todo:
                text, across, down = todo.pop(0)
                for _ in range(max(1, across)):
                    line.append(text)
                    if down > 1:
                        pending[column] = (text, down - 1)
                    column += 1
            else:
                line.append("")
                column += 1
        out.append(line + [""] * (width - len(line)))
    return out


def header_columns(header: list[list[str]], width: int) -> list[str]:
    names, seen = [], {}
    for c in range(width):
        parts: list[str] = []
        for row in header:
            text = (row[c] if c < len(row) else "").strip()
            if text and (not parts or parts[-1] != text):
                parts.append(text)
        name = " / ".join(parts) or f"column_{c + 1}"
        seen[name] = seen.get(name, 0) + 1
        names.append(name if seen[name] == 1 else f"{name}__{seen[name]}")
    return names


def continue_table(left: tuple[list[str], list[list[str]]], right: tuple[list[str], list[list[str]]]) -> tuple[list[str], list[list[str]]] | None:
    """A table and its continuation as one: rows appended if the columns are equal, else columns joined on up to 4 leading key columns in which 8 in 10 rows agree, blank ones and the headers aside."""
    (lc, lr), (rc, rr) = left, right
    if lc == rc:
        return lc, lr + rr
    if len(lr) != len(rr) or not lr:
        return None
    keys = 0
    for k in range(1, min(4, len(lc), len(rc)) + 1):
        filled = [(a[:k], b[:k]) for a, b in zip(lr, rr) if any(x.strip() for x in (*a[:k], *b[:k]))]
        if not filled or sum(a == b for a, b in filled) < 0.8 * len(filled):
            break
        keys = k
    if not keys:
        return None
    return lc + [c if c not in lc else f"{c}__2" for c in rc[keys:]], [a + b[keys:] for a, b in zip(lr, rr)]


def cals(group: ET.Element) -> tuple[list[str], list[list[str]]]:
    """(columns, rows) of one tgroup."""
    names = {s.get("colname"): i for i, s in enumerate(group.findall("colspec"))}

    def rows(part: str) -> list[list[tuple[str, int, int]]]:
        out = []
        for row in group.findall(f"{part}/row"):
            line = []
            for e in row.findall("entry"):
                a, b = names.get(e.get("namest")), names.get(e.get("nameend"))
                line.append((flat(e), (b - a + 1) if a is not None and b is not None else 1, int(e.get("morerows") or 0) + 1))
            out.append(line)
        return out

    head, body = rows("thead"), rows("tbody")
    width = max([int(group.get("cols") or 0), *(sum(c for _, c, _ in r) for r in head + body)])
    return header_columns(expand(head, width), width), expand(body, width)


def _divisions(norm: ET.Element) -> list[tuple[str, str, str]]:
    return [(flat(g.find("gliederungskennzahl")), flat(g.find("gliederungsbez")), flat(g.find("gliederungstitel"))) for g in norm.findall("metadaten/gliederungseinheit")]


def _kind(label: str) -> str:
    for pattern, kind in ((r"(?i)inhalts(übersicht|verzeichnis)", "toc"), (r"§", "paragraph"), (r"(?i)art(ikel|\b)", "article"), (r"(?i)anlage|anhang", "annex"), (r"(?i)eingangsformel|präambel", "preamble"), (r"(?i)schlussformel", "final")):
        if re.match(pattern, label):
            return kind
    return "provision" if label else "metadata"


def norms(root: ET.Element, data: str) -> Iterator[tuple[str, str, str, int, dict]]:
    number = root.get("doknr") or ""
    document = "doc_" + short_hash("gii_xml", number or hashlib.sha256(data.encode()).hexdigest())
    first = next(iter(root.findall("norm")), None)
    meta = {k: flat(first.find(f"metadaten/{t}")) if first is not None else "" for k, t in (("abbreviation", "jurabk"), ("short_title", "kurzue"), ("title", "langue"), ("issued", "ausfertigung-datum"))}
    yield "document", document, "", 0, meta | {"number": number}
    base = slug(meta["abbreviation"] or number)
    places: dict[str, str] = {}  # division code -> unit id
    names: dict[str, int] = {}
    position = 0

    def unit(key: str, parent: str, fields: dict) -> tuple[str, str, str, int, dict]:
        nonlocal position
        names[key] = names.get(key, 0) + 1
        key = key if names[key] == 1 else f"{key}_part_{names[key]}"
        position += 1
        return "unit", f"unit_{key}__{document}", parent, position, fields | {"global_key": key}

    for norm in root.findall("norm"):
        parent, prefix = document, base
        for code, label, title in _divisions(norm):
            if label == "-" or not code:
                continue
            if code not in places:
                above = max((c for c in places if code.startswith(c) and c != code), key=len, default=None)
                m = re.match(r"(?i)art\.?\s*(\d+\w*)", label)
                key = f"{base}_art_{m[1].lower()}" if m else f"{base}_gliederung_{slug(code)}"
                row = unit(key, places.get(above, document), {"unit_type": "article" if m else "division", "label": label, "title": title})
                places[code] = row[1]
                yield row
            parent = places[code]
            m = re.match(r"(?i)art\.?\s*(\d+\w*)", label)
            prefix = f"{base}_art_{m[1].lower()}" if m else prefix
        label, title = flat(norm.find("metadaten/enbez")), flat(norm.find("metadaten/titel"))
        kind = _kind(label)
        notes = norm.find("textdaten/fussnoten")
        if notes is not None and flat(notes):
            position += 1
            yield "chunk", f"chunk_{document}_{position:06d}", parent, position, {"chunk_type": "note", "text": flat(notes)}
        if not label:
            continue
        row = unit(f"{prefix}_{slug(label)}", parent, {"unit_type": kind, "label": label, "title": title})
        yield row
        body = norm.find("textdaten/text")
        held: list[tuple[list[str], list[list[str]], bool]] = []
        pending = False
        for p in body.iter() if body is not None else ():
            if p.tag == "P":
                text = flat(p, skip=("table",))
                pending = bool(re.match(r"(?i)(noch|fortsetzung)\b", text)) if text else pending
                if text:
                    position += 1
                    yield "chunk", f"chunk_{document}_{position:06d}", row[1], position, {"chunk_type": "toc" if kind == "toc" else "text", "text": text}
            elif p.tag == "table":
                # groups of the same columns are one table; others stand beside it and are flagged
                groups: list[tuple[list[str], list[list[str]]]] = []
                for columns, lines in map(cals, p.iter("tgroup")):
                    if groups and groups[-1][0] == columns:
                        groups[-1] = (columns, groups[-1][1] + lines)
                    else:
                        groups.append((columns, lines))
                merged = continue_table(held[-1][:2], groups[0]) if held and pending and groups else None
                if merged:
                    held[-1] = (*merged, held[-1][2] or len(groups) > 1)
                    groups = groups[1:]
                held += [(*g, len(groups) > 1) for g in groups]
                pending = False
        for columns, lines, several in held:
            table_row = unit(f"{row[4]['global_key']}_tabelle_{len([1 for n in names if n.startswith(row[4]['global_key'] + '_tabelle_')]) + 1}", row[1], {"unit_type": "table", "label": label, "title": title, "columns": columns, "row_count": len(lines), "multi_tgroup_layout": several})
            yield table_row
            for i, line in enumerate(lines):
                yield "table_row", f"{table_row[1]}_r{i}", table_row[1], i, {"cells": dict(zip(columns, line))}


def _formex_table(tbl: ET.Element) -> tuple[list[str], list[list[str]]]:
    head, body = [], []
    for row in tbl.iter("ROW"):
        cells = [(flat(c), int(c.get("COLSPAN") or 1), int(c.get("ROWSPAN") or 1)) for c in row.findall("CELL")]
        (head if row.get("TYPE") == "HEADER" else body).append(cells)
    width = max([int(tbl.get("COLS") or 0), *(sum(c for _, c, _ in r) for r in head + body)])
    if head and body and all(len(r) == 1 for r in head):  # only a caption: the next row is the header
        head.append(body.pop(0))
    return header_columns(expand(head, width), width), expand(body, width)


def act(root: ET.Element, data: str) -> Iterator[tuple[str, str, str, int, dict]]:
    info = root.find(".//INFO.CONSLEG")
    reference = (info.get("CONSLEG.REF") if info is not None else None) or short_hash(data)
    document = f"doc_eu_{slug(reference)}"
    base = f"celex_{slug(reference)}"
    status = None if info is None else {"NONE": True}.get(info.get("END"), False if info.get("END") else None)
    title = root.find("./CONS.DOC/TITLE") if root.tag == "CONS.ACT" else root.find("./TITLE")
    yield "document", document, "", 0, {"title": flat(title), "start": info.get("START.DATE") if info is not None else None, "in_force": status}
    position = 0
    names: dict[str, int] = {}

    def emit(kind: str, key: str, parent: str, fields: dict) -> tuple[str, str, str, int, dict]:
        nonlocal position
        position += 1
        names[key] = names.get(key, 0) + 1
        key = key if names[key] == 1 else f"{key}_{names[key]}"
        return kind, f"{kind}_{key}", parent, position, fields | {"global_key": key}

    def walk(node: ET.Element, parent: str) -> Iterator[tuple[str, str, str, int, dict]]:
        for child in node:
            if child.tag == "DIVISION":
                row = emit("unit", f"{base}_gliederung_{slug(flat(child.find('TITLE')).split(' ')[0] + ' ' + ' '.join(flat(child.find('TITLE')).split(' ')[1:2]))}", parent, {"unit_type": "division", "title": flat(child.find("TITLE"))})
                yield row
                yield from walk(child, row[1])
            elif child.tag == "ARTICLE":
                label = flat(child.find("TI.ART"))
                number = re.search(r"\d+\s*[a-z]?", label)
                row = emit("unit", f"{base}_art_{slug(number[0]) if number else slug(label)}", parent, {"unit_type": "article", "label": label, "title": flat(child.find("STI.ART"))})
                yield row
                parts = [c for c in child if c.tag in ("PARAG", "ALINEA")]
                for c in parts:
                    yield emit("chunk", f"{row[4]['global_key']}_abs_{slug(flat(c.find('NO.PARAG'))) or len(names)}", row[1], {"chunk_type": "paragraph_text", "text": flat(c)})
            elif child.tag == "CONSID":
                number = re.match(r"\(?(\d+)", flat(child))
                yield emit("chunk", f"{base}_erwaegungsgrund_{number[1] if number else len(names)}", parent, {"chunk_type": "recital", "text": flat(child)})
            elif child.tag in ("PREAMBLE.INIT", "PREAMBLE.FINAL", "FINAL"):
                yield emit("chunk", f"{base}_{slug(child.tag)}", parent, {"chunk_type": "frame", "text": flat(child)})
            elif child.tag in ("CONS.ANNEX", "ANNEX"):
                label = flat(child.find("TITLE"))
                row = emit("unit", f"{base}_anhang_{slug(label.split(' ')[1]) if ' ' in label else slug(label)}", parent, {"unit_type": "annex", "label": label})
                yield row
                yield from walk(child, row[1])
            elif child.tag == "TBL":
                columns, lines = _formex_table(child)
                row = emit("unit", f"{base}_tabelle_{child.get('NO.SEQ') or len(names)}", parent, {"unit_type": "table", "title": flat(child.find("TITLE")), "columns": columns, "row_count": len(lines)})
                yield row
                for i, line in enumerate(lines):
                    yield "table_row", f"{row[1]}_r{i}", row[1], i, {"cells": dict(zip(columns, line))}
                for note in child.iter("NOTE"):
                    yield emit("chunk", f"{row[4]['global_key']}_note_{slug(note.get('NOTE.ID') or '')}", row[1], {"chunk_type": "note", "text": flat(note)})
            elif child.tag in ("CONS.DOC", "PREAMBLE", "GR.CONSID", "ENACTING.TERMS", "CONTENTS", "GR.SEQ"):
                yield from walk(child, parent)

    yield from walk(root, document)


PARSERS = {"dokumente": norms, "CONS.ACT": act, "ACT": act}


def parse(data: str) -> list[tuple[str, str, str, int, dict]]:
    root = ET.fromstring(data)
    return list(PARSERS[root.tag](root, data))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [*[pa.string()] * 4, pa.int32(), pa.string()]
    names = [x.split(" ")[0] for x in EMITTED.split(", ")]
    for batch in batches:
        for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            try:
                rows = [(path, *row[:4], json.dumps(row[4], ensure_ascii=False)) for row in parse(data)]
            except (ET.ParseError, KeyError, ValueError) as e:
                rows = [(path, "issue", "", "", 0, json.dumps({"issue": type(e).__name__}))]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)


def extract_acts(opened: DataFrame) -> DataFrame:
    """The tagged rows of every opened package; one that cannot be parsed gives one row of the kind ``issue``."""
    return opened.where("xml is not null").select("path", "xml").mapInArrow(_extract, EMITTED)
