"""Splitting oversized items at natural boundaries.

Every place where an item may be cut is a boundary with a rank. Each boundary is joined to its farthest legal successor,
overlap included; the successor tables are then squared until they jump over whole items, and marking what the item's
start reaches in 1, 2, 4, ... jumps gives all greedy cuts at once. The tables of all items of a batch are one array, so
that the work is the same for a thousand short items and for one very long one, and no item leaves its task.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_SCHEMA = "item_type string, item_id string, piece_no int, n_pieces int, start int, end int, overlap int, content string"

# Boundary ranks of a text, from weak to strong. Those below SPACE are not natural: between any two characters, or even before
# a combining one, and only in stretches without natural ones that are longer than a piece.
TORN, HARD, SPACE, CLAUSE, SENTENCE, LINE, PARAGRAPH = range(-1, 6)
#: Units (characters or rows) of a batch that are solved together.
BATCH_UNITS = 4_000_000

_attributes = np.full(0x110000, 255, np.uint8)  # of each character, filled as needed
_WS, _OPENS, _ENDS, _CLAUSE, _NEWLINE, _MARK = 1, 2, 4, 8, 16, 32


def _attributes_of(codes: np.ndarray) -> np.ndarray:
    for code in np.unique(codes[_attributes[codes] == 255]).tolist():
        import unicodedata

        ch = chr(code)
        kind = unicodedata.category(ch)
        bits = _WS * ch.isspace() | _OPENS * (ch.isupper() or ch.isdigit() or ch in "§„“«\"'([–-") | _ENDS * (ch in ".!?…。") | _CLAUSE * (ch in ";:,") | _NEWLINE * (ch in "\n\r\v\f\u0085\u2028\u2029")
        _attributes[code] = bits | _MARK * (kind in ("Mn", "Mc", "Me", "Cf") or 0x1F3FB <= code <= 0x1F3FF)
    return _attributes[codes]


def text_boundaries(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, ranks) where a text may be cut naturally: always after white space, ranked by what stands before it."""
    a = _attributes_of(codes)
    n = len(codes)
    ws = (a & _WS) > 0
    at = np.flatnonzero(ws[:-1] & ~ws[1:]) + 1 if n else np.zeros(0, np.int64)
    index = np.arange(n)
    last = np.maximum.accumulate(np.where(ws, -1, index))[at - 1] if len(at) else at  # last character before the space
    lines = np.concatenate([[0], np.cumsum((a & _NEWLINE) > 0)])
    breaks = lines[at] - lines[last + 1]
    # "\r\n" is one line break
    pairs = np.concatenate([[0, 0], np.cumsum((codes[:-1] == 13) & (codes[1:] == 10))]) if n else np.zeros(2, np.int64)
    breaks = breaks - (pairs[at] - pairs[last + 1])
    word = last - np.maximum.accumulate(np.where(ws, index, -1))[np.maximum(last, 0)] if len(at) else at  # length of the word before
    before = a[np.maximum(last, 0)]
    rank = np.full(len(at), SPACE, np.int8)
    rank[(before & _CLAUSE) > 0] = CLAUSE
    rank[((before & _ENDS) > 0) & ((a[at] & _OPENS) > 0) & (word > 4)] = SENTENCE  # "Abs. 2" ends no sentence
    rank[breaks == 1] = LINE
    rank[breaks > 1] = PARAGRAPH
    keep = last >= 0
    return at[keep], rank[keep]


def _hard_boundaries(codes: np.ndarray, at: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, ranks) of all places inside stretches without natural boundaries that are longer than ``step``."""
    edges = np.concatenate([[0], at, [len(codes)]])
    long = np.flatnonzero(np.diff(edges) > step)
    if not len(long):
        return np.zeros(0, np.int64), np.zeros(0, np.int8)
    places = np.concatenate([np.arange(edges[k] + 1, edges[k + 1]) for k in long])
    return places, np.where(_attributes_of(codes[places]) & _MARK, TORN, HARD).astype(np.int8)


def solve(lengths: list[int], boundaries: list[tuple[np.ndarray, np.ndarray]], limit: int, overlap: int) -> list[np.ndarray]:
    """For each item its cuts, from 0 to its length; consecutive ones are at most ``limit`` less the overlap apart.

    The successor of a boundary is the farthest one of the best natural rank in the farther half of its reach, else the
    farthest natural one in the nearer half, else the farthest of the best other rank. Boundaries must lie densely enough that
    there is always one (see _hard_boundaries).
    """
    step = limit - overlap
    offsets = np.concatenate([[0], np.cumsum(np.asarray(lengths, np.int64) + 1)])  # items are one apart, so that ends differ from starts
    at = np.concatenate([np.concatenate([[0], b[0], [n]]) + o for b, n, o in zip(boundaries, lengths, offsets)]).astype(np.int64)
    rank = np.concatenate([np.concatenate([[9], b[1], [9]]) for b in boundaries]).astype(np.int8)
    first = np.concatenate([[0], np.cumsum([len(b[0]) + 2 for b in boundaries])])
    starts, ends = first[:-1], first[1:] - 1
    end_of = np.repeat(ends, np.diff(first))
    index = np.arange(len(at))
    reach = np.full(len(at), step)
    reach[starts] = limit
    high = np.minimum(at + reach, at[end_of])
    succ = np.where(high == at[end_of], end_of, -1)
    half = at + reach // 2
    here = set(rank.tolist()) - {9}
    natural = sorted((r for r in here if r >= SPACE), reverse=True)
    for r, least in [*((r, half) for r in natural), *((min(natural), at) for _ in natural[:1]), *((r, at) for r in sorted(here - set(natural), reverse=True))]:
        todo = np.flatnonzero(succ < 0)
        if not len(todo):
            break
        ranked = index[rank >= r]
        k = np.searchsorted(at[ranked], high[todo], "right") - 1
        found = ranked[np.maximum(k, 0)]
        good = (k >= 0) & (at[found] > least[todo])
        succ[todo[good]] = found[good]
    rest = np.flatnonzero(succ < 0)
    if len(rest):
        raise ValueError("boundaries too far apart")
    reached = np.zeros(len(at), bool)
    reached[starts] = True
    jump = succ.copy()
    jump[ends] = ends
    while True:
        more = reached.copy()
        more[jump[reached]] = True
        if (more == reached).all():
            break
        reached = more
        jump = jump[jump]
    cuts = np.flatnonzero(reached)
    split = np.searchsorted(cuts, first[1:-1])
    return [at[c] - o for c, o in zip(np.split(cuts, split), offsets)]


def cut_texts(texts: list[str], limit: int, overlap: int) -> list[list[tuple[int, int]]]:
    """(start, end) of each piece of each text; a text within the limit is one piece."""
    bounds = []
    for text in texts:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        at, rank = text_boundaries(codes)
        places, ranks = _hard_boundaries(codes, at, limit - overlap)
        if len(places):
            at, rank = np.concatenate([at, places]), np.concatenate([rank, ranks])
            order = np.argsort(at, kind="stable")
            at, rank = at[order], rank[order]
        bounds.append((at, rank))
    cuts = solve([len(t) for t in texts], bounds, limit, overlap)
    return [[(max(0, a - overlap), b) for a, b in zip(c[:-1].tolist(), c[1:].tolist())] or [(0, 0)] for c in cuts]


_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]{},]', re.S)


def elements(array: str) -> list[tuple[int, int]]:
    """(start, end) of each element of a JSON array in its text, without the white space around it."""
    spans: list[tuple[int, int]] = []
    depth, start = 0, 0

    def close(end: int) -> None:
        part = array[start:end]
        if part.strip() or spans:
            spans.append((start + len(part) - len(part.lstrip()), end - len(part) + len(part.rstrip())))

    for m in _TOKEN.finditer(array):
        c = m.group()
        if c in ("[", "{"):
            depth += 1
            if depth == 1:
                start = m.end()
        elif c in ("]", "}"):
            depth -= 1
            if depth == 0:
                close(m.start())
                break
        elif c == "," and depth == 1:
            close(m.start())
            start = m.end()
    return spans


def row_ranks(rows: list[str]) -> np.ndarray:
    """Rank of the boundary before each row but the first: CLAUSE before a heading row or after an empty one, else SPACE."""

    def shape(text: str) -> tuple[int, int]:
        try:
            row = json.loads(text, strict=False)
        except (ValueError, RecursionError):  # what is no plain row is full
            return 1, 2
        values = row.values() if isinstance(row, dict) else row if isinstance(row, list) else [row]
        return len(values), sum(1 for v in values if v is not None and v != "" and (not isinstance(v, str) or v.strip()))

    shapes = [shape(r) for r in rows]
    return np.array([CLAUSE if (w > 1 and f == 1) or before == 0 else SPACE for (w, f), (_, before) in zip(shapes[1:], shapes)], np.int8)


def cut_tables(tables: list[list[str]], limit: int, overlap: int) -> list[list[tuple[int, int]]]:
    bounds = [(np.arange(1, len(t)), row_ranks(t)) for t in tables]
    cuts = solve([len(t) for t in tables], bounds, limit, overlap)
    return [[(max(0, a - overlap), b) for a, b in zip(c[:-1].tolist(), c[1:].tolist())] or [(0, 0)] for c in cuts]


def _pieces(text_limit: int, text_overlap: int, row_limit: int, row_overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split(" ")[0] for x in PIECE_SCHEMA.split(", ")]
        types = [pa.string(), pa.string(), *[pa.int32()] * 5, pa.string()]

        def solved(items: list[tuple[str, str, str]]) -> pa.RecordBatch:
            rows = []
            texts = [(i, c) for kind, i, c in items if kind != "table"]
            kinds = {}
            for kind, i, _ in items:
                kinds.setdefault(i, kind)
            for (i, c), parts in zip(texts, cut_texts([c for _, c in texts], text_limit, text_overlap) if texts else ()):
                ends = 0
                for k, (a, b) in enumerate(parts):
                    rows.append(("chunk", i, k, len(parts), a, b, ends - a if k else 0, c[a:b]))
                    ends = b
            tables = [(i, c, elements(c)) for kind, i, c in items if kind == "table"]
            cut = cut_tables([[c[a:b] for a, b in spans] for _, c, spans in tables], row_limit, row_overlap) if tables else ()
            for (i, c, spans), parts in zip(tables, cut):
                ends = 0
                for k, (a, b) in enumerate(parts):
                    rows.append(("table", i, k, len(parts), a, b, ends - a if k else 0, f"[{c[spans[a][0] : spans[b - 1][1]]}]" if b > a else "[]"))
                    ends = b
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

        held, units = [], 0
        for batch in batches:
            for kind, item, content in zip(*(batch.column(k).to_pylist() for k in range(3))):
                held.append((kind, item, content))
                units += len(content)
                if units >= BATCH_UNITS:
                    yield solved(held)
                    held, units = [], 0
        if held:
            yield solved(held)

    return run


def oversized(items: DataFrame, text_limit: int, row_limit: int) -> DataFrame:
    """The items over their limit. Code points and elements are counted before any Python runs."""
    is_table = F.col("item_type") == "table"
    over = F.when(is_table, F.json_array_length("content") > row_limit).otherwise(F.char_length("content") > text_limit)
    return items.select("item_type", F.col("item_id").cast("string").alias("item_id"), "content").where("content is not null and item_id is not null").where(over)


def split_oversized(items: DataFrame, text_limit: int = 4000, text_overlap: int = 200, row_limit: int = 60, row_overlap: int = 3) -> DataFrame:
    """items(item_type, item_id, content) -> the pieces of every item over its limit, columns as PIECE_SCHEMA.

    item_type ``table`` has a JSON array of rows as content and counts rows; any other is text and counts code points. A table
    is cut between the elements of its text, which are kept letter by letter (numbers too). Each piece but the first begins with the last ``overlap`` units of the one before; pieces less their overlaps are the item
    again. Items within the limit, null or invalid contents and null ids give no pieces; a repeated row gives its pieces
    again (the caller knows which rows are the same record). Ties between boundaries of one rank: the farthest.
    """
    if not (0 <= text_overlap < text_limit // 2 and 0 <= row_overlap < max(1, row_limit // 2)):
        raise ValueError("an overlap must be less than half of its limit")
    return oversized(items, text_limit, row_limit).mapInArrow(_pieces(text_limit, text_overlap, row_limit, row_overlap), PIECE_SCHEMA)
