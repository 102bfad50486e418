"""Texts and tables in parts: long texts, list items, footnotes, tables from lines and from words with places."""

from __future__ import annotations

import re
from collections.abc import Callable

from ..sources.acts import header_columns

# ---- texts ----


def long_text(text: str, most: int = 1800, target: int = 1500) -> list[str]:
    """A text of more than ``most`` words in parts: lines, of long lines their sentences, of long sentences slices, packed up to
    ``target``. A shorter text is one part."""
    if len(text.split()) <= most:
        return [text] if text.strip() else []
    pieces: list[str] = []
    for line in text.split("\n"):
        for sentence in re.split(r"(?<=[.!?;])\s+", line) if len(line.split()) > target else [line]:
            words = sentence.split()
            pieces += [" ".join(words[i : i + target]) for i in range(0, len(words), target)] if len(words) > target else [sentence] if words else []
    out: list[list[str]] = []
    fill = 0
    for p in pieces:
        n = len(p.split())
        if not out or fill + n > target:
            out.append([])
            fill = 0
        out[-1].append(p)
        fill += n
    return ["\n".join(x) for x in out]


_ITEM = re.compile(r"^\s*(?:(\d+)\.|([a-z])\)|\((\d+[a-z]?)\)|([–-]))\s+", re.M)


def list_items(text: str) -> list[tuple[str, str]]:
    """(marker, text) of the items that lines begin with; what stands before the first has the marker ''."""
    marks = list(_ITEM.finditer(text))
    out = [("", text[: marks[0].start()].strip())] if marks and text[: marks[0].start()].strip() else []
    for m, end in zip(marks, [*(x.start() for x in marks[1:]), len(text)]):
        out.append((m[1] or m[2] or m[3] or m[4], text[m.end() : end].strip()))
    return out or ([("", text.strip())] if text.strip() else [])


def subsections(text: str) -> list[tuple[str, str]]:
    """(number, text) of the paragraphs "(1) ..." of a section, in rising order; other items stay inside of them."""
    marks, last = [], 0
    for m in re.finditer(r"^\s*\((\d+)[a-z]?\)\s+", text, re.M):
        if int(m[1]) in (last, last + 1):
            last = int(m[1])
            marks.append(m)
    out = [("", text[: marks[0].start()].strip())] if marks and text[: marks[0].start()].strip() else []
    for m, end in zip(marks, [*(x.start() for x in marks[1:]), len(text)]):
        out.append((re.sub(r"[\s()]", "", m.group()), text[m.end() : end].strip()))
    return out or ([("", text.strip())] if text.strip() else [])


def substitute_marks(value, marks: dict[str, str]):
    """Footnote ids in brackets replaced by what they are called, in texts, lists and keys at any depth; unknown ones stay."""
    if isinstance(value, str):
        return re.sub(r"\[([^\[\]\r\n]+)\]", lambda m: f"[{marks.get(m[1], m[1])}]", value)
    if isinstance(value, list):
        return [substitute_marks(v, marks) for v in value]
    if isinstance(value, dict):
        return {substitute_marks(k, marks): substitute_marks(v, marks) for k, v in value.items()}
    return value


def footnotes(text: str, notes: dict[str, str]) -> tuple[list[tuple[str, int, str]], list[str], list[str]]:
    """(rows (id, ordinal of its first mention, text), mentioned but not defined, defined but not mentioned)."""
    mentioned = list(dict.fromkeys(m for m in re.findall(r"\[([^\[\]\r\n]+)\]", text)))
    rows = [(m, n, notes[m]) for n, m in enumerate(mentioned, 1) if m in notes]
    return rows, [m for m in mentioned if m not in notes], [k for k in notes if k not in mentioned]


def definition_list(node) -> list[dict]:
    """The marker, text and lists below of each entry of a DL element (DT and DD in turn)."""
    out, marker = [], ""
    for child in node:
        if child.tag == "DT":
            marker = " ".join("".join(child.itertext()).split())
        elif child.tag == "DD":
            below = [x for dl in child.iter("DL") for x in definition_list(dl)] if child.find(".//DL") is not None else []
            inner = {id(x) for dl in child.iter("DL") for x in dl.iter()}
            parts = []
            for e in child.iter():
                if id(e) not in inner:
                    parts.append(e.text or "")
                if e is not child and id(e) not in inner or e.tag == "DL":
                    parts.append(e.tail or "")
            out.append({"marker": marker, "text": " ".join("".join(parts).split()), "items": below})
            marker = ""
    return out


def visible_strings(value, skip: tuple[str, ...] = ("_id", "source_", "attributes")):
    """All texts of a nested value, keys included, but for what stands under ids, sources and attributes; without recursion."""
    stack = [value]
    while stack:
        v = stack.pop()
        if isinstance(v, str):
            yield v
        elif isinstance(v, dict):
            kept = [(k, x) for k, x in v.items() if not (k.endswith(skip[0]) or k.startswith(skip[1]) or k in skip[2:])]
            stack += [y for k, x in reversed(kept) for y in (x, k)]
        elif isinstance(v, list):
            stack += reversed(v)


# ---- tables from lines ----


def cells_of(line: str) -> list[str]:
    return [c.strip() for c in re.split(r"\s{2,}|\t|\s*\|\s*", line.strip()) if c.strip()]


def blocks(lines: list[str]) -> list[tuple[str, list[str]]]:
    """Runs of lines as ("text", lines) and ("table", lines): two or more lines of two or more cells are a table."""
    out: list[tuple[str, list[str]]] = []
    for line in lines:
        if not line.strip():
            continue
        kind = "table" if len(cells_of(line)) >= 2 else "text"
        if out and out[-1][0] == kind:
            out[-1][1].append(line)
        else:
            out.append((kind, [line]))
    joined: list[tuple[str, list[str]]] = []
    for kind, held in out:
        kind = "text" if kind == "table" and len(held) < 2 else kind
        if joined and joined[-1][0] == kind == "text":
            joined[-1][1].extend(held)
        else:
            joined.append((kind, held))
    return joined


def text_table(lines: list[str]) -> dict | None:
    """A table of lines: the first line of cells is the header unless all are numbers; a line of one cell begins a section, or is a
    note if it begins with a mark; missing cells at the end are empty. None if it has no two rows of cells."""
    rows = [cells_of(x) for x in lines if x.strip()]
    if sum(len(r) >= 2 for r in rows) < 2:
        return None
    width = max(len(r) for r in rows)
    first = next(i for i, r in enumerate(rows) if len(r) >= 2)
    numeric = all(re.fullmatch(r"[\d.,%<>=±–-]+", c) for c in rows[first])
    columns = header_columns([rows[first]], width) if not numeric else [f"column_{i + 1}" for i in range(width)]
    body, notes, section = [], [], None
    title = " ".join(c for r in rows[:first] for c in r)
    for r in rows[first + (not numeric) :]:
        if len(r) == 1:
            if re.match(r"[*¹²³]|\d+\)", r[0]):
                notes.append(r[0])
            else:
                section = r[0]
            continue
        body.append(({"_section": section} if section else {}) | dict(zip(columns, r + [""] * (width - len(r)))))
    return {"title": title, "columns": columns, "rows": body, "notes": notes}


# ---- tables from words with places ----


def word_rows(words: list[tuple[float, float, float, float, str]], gap: float = 3.0) -> list[list[tuple[float, float, float, float, str]]]:
    """Words (x0, y0, x1, y1, text) in rows from top to bottom: centres no more than ``gap`` apart are one row."""
    out: list[list] = []
    for w in sorted(words, key=lambda w: ((w[1] + w[3]) / 2, w[0])):
        centre = (w[1] + w[3]) / 2
        if out and centre - (out[-1][0][1] + out[-1][0][3]) / 2 <= gap:
            out[-1].append(w)
        else:
            out.append([w])
    return [sorted(r) for r in out]


def grid_table(words: list[tuple[float, float, float, float, str]], verticals: list[float]) -> dict | None:
    """A table whose columns lie between drawn vertical lines: the first row names them, repeated headers are dropped, a row
    without a cell in the first column goes on with the row above."""
    edges = sorted(verticals)
    if len(edges) < 2:
        return None
    rows = []
    for r in word_rows(words):
        cells = [""] * (len(edges) - 1)
        for x0, _, x1, _, text in r:
            k = next((i for i, (a, b) in enumerate(zip(edges, edges[1:])) if a <= (x0 + x1) / 2 < b), None)
            if k is not None:
                cells[k] = f"{cells[k]} {text}".strip()
        if any(cells):
            rows.append(cells)
    if len(rows) < 2:
        return None
    header, body = rows[0], []
    for r in rows[1:]:
        if r == header:
            continue
        if not r[0] and body:
            body[-1] = [f"{a} {b}".strip() for a, b in zip(body[-1], r)]
        else:
            body.append(r)
    columns = header_columns([header], len(header))
    return {"title": "", "columns": columns, "rows": [dict(zip(columns, r)) for r in body], "notes": []}


def merge_panels(left: dict, right: dict, keys: int = 2) -> dict:
    """Two panels of one table: a full outer merge on the first columns; blanks are filled, values that differ are joined by a bar."""
    names = left["columns"][:keys]
    columns = left["columns"] + [c for c in right["columns"][keys:] if c not in left["columns"]]
    out: dict[tuple, dict] = {}
    for panel in (left, right):
        for row in panel["rows"]:
            key = tuple(row.get(a, "") for a in panel["columns"][:keys])
            have = out.setdefault(key, dict(zip(names, key)))
            for c in panel["columns"][keys:]:
                old, new = have.get(c, ""), row.get(c, "")
                have[c] = new if not old or old == new else old if not new else f"{old} | {new}"
    return {"title": left["title"], "columns": columns, "rows": [{c: r.get(c, "") for c in columns} for r in out.values()], "notes": [*left["notes"], *right["notes"]]}


Parser = tuple[Callable[[dict], bool], Callable[[dict], dict | None]]
#: Parsers of a table block {words, verticals, lines} in the order in which they are asked.
PARSERS: list[Parser] = [
    (lambda b: len(b.get("verticals") or []) >= 2 and bool(b.get("words")), lambda b: grid_table(b["words"], b["verticals"])),
    (lambda b: bool(b.get("lines")), lambda b: text_table(b["lines"])),
]


def parse_table(block: dict, parsers: list[Parser] | None = None) -> dict | None:
    """The table of the first parser that takes the block and makes something of it."""
    return next((t for can, parse in (PARSERS if parsers is None else parsers) if can(block) and (t := parse(block)) is not None), None)


def emit_table(unit: str, table: dict) -> list[tuple[str, str, str, dict]]:
    """(kind, id, parent, fields) of a parsed table: its unit, a chunk a section or of all rows, and one a note."""
    out = [("unit", unit, "", {"unit_type": "table", "title": table["title"], "columns": table["columns"], "row_count": len(table["rows"])})]
    sections: dict[str, list[dict]] = {}
    for r in table["rows"]:
        sections.setdefault(r.get("_section") or "", []).append(r)
    for n, (name, rows) in enumerate(sections.items(), 1):
        text = "\n".join(" | ".join(r.get(c, "") for c in table["columns"]) for r in rows)
        out.append(("chunk", f"{unit}_rows_{n}", unit, {"chunk_type": "table_rows", "label": name, "text": text}))
    return out + [("chunk", f"{unit}_note_{n}", unit, {"chunk_type": "note", "text": t}) for n, t in enumerate(table["notes"], 1)]


# ---- tables in parts ----


def table_text(columns: list[str], rows: list[dict]) -> str:
    return "\n".join([" | ".join(columns), *(" | ".join(str(r.get(c, "") or "") for c in columns) for r in rows)])


def part_text(citation: str, title: str, columns: list[str], rows: list[dict], first: int) -> str:
    """A part that can be read alone: the table's name, its columns, which rows; a value equal to the one before it is an arrow."""

    def line(r: dict) -> str:
        values = [str(r.get(c, "") or "") for c in columns]
        return " | ".join("↳" if i and v and v == values[i - 1] else v for i, v in enumerate(values))

    head = f"Tabelle: {citation}" + (f" — {title}" if title else "")
    return "\n".join([head, "Spaltenüberschriften:", " | ".join(columns), f"Zeilen {first}–{first + len(rows) - 1}:", *map(line, rows)])


def split_table(citation: str, title: str, columns: list[str], rows: list[dict], count: Callable[[str], int] = lambda t: len(t.split()), most: int = 3500, target: int = 3200) -> list[dict]:
    """A table of at most ``most`` tokens as it is, else parts of whole rows up to ``target`` tokens, each with title and columns.

    A single row beyond the limit is a part of its own and flagged, never cut.
    """
    whole = table_text(columns, rows)
    if count(whole) <= most or not rows:
        return [{"text": whole, "first_row": 1 if rows else None, "n_rows": len(rows), "part": 1, "n_parts": 1, "was_split": False, "oversized": False}]
    parts, at = [], 0
    while at < len(rows):
        # the largest number of rows that fits, by doubling and halving, since a part only grows with its rows
        fits = lambda n: count(part_text(citation, title, columns, rows[at : at + n], at + 1)) <= target
        low, high = 1, 2
        while at + high <= len(rows) and fits(high):
            low, high = high, high * 2
        high = min(high, len(rows) - at + 1)
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if fits(middle) else (low, middle)
        text = part_text(citation, title, columns, rows[at : at + low], at + 1)
        parts.append({"text": text, "first_row": at + 1, "n_rows": low, "was_split": True, "oversized": count(text) > most})
        at += low
    return [p | {"part": n, "n_parts": len(parts)} for n, p in enumerate(parts, 1)]
