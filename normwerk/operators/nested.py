"""Deeply nested payloads to flat, related tables in one pass.

A depth-first visitor walks each payload once and emits rows tagged with the kind of record: (payload_id, record_kind,
record_id, parent_id, parent_kind, position, fields). ``write_tables`` then writes them partitioned by the tag, and
``typed_table`` gives one kind its own columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import deepjson

EMITTED = "payload_id bigint, record_kind string, record_id string, parent_id string, parent_kind string, position int, fields string"

#: Part name -> kind of the records that stand in it.
PARTS = {"documents": "document", "structural_units": "unit", "children": "unit", "chunks": "chunk", "child_chunks": "chunk", "cases": "case", "facts": "fact", "answer": "answer"}
ID_FIELD = {"document": "document_id", "unit": "unit_id", "chunk": "chunk_id", "case": "id", "fact": "id", "answer": "id"}

TYPED = {
    "document": "title string, metadata string",
    "unit": "unit_type string, label string, title string, page_range struct<start:int,end:int>",
    "chunk": "text string, source_order string, header_matrix string, rows string",
    "case": "family string, prompt string",
    "fact": "match string",
    "answer": "text string, certain boolean",
}


def _decoded(value):
    """A part that was encoded as JSON text once or several times."""
    while isinstance(value, str) and value.lstrip()[:1] in ("{", "[", '"'):
        try:
            value = deepjson.loads(value)  # of a text, always a shorter one
        except ValueError:
            break
    return value


def _id_of(value) -> str:
    return "" if value is None or isinstance(value, (dict, list)) else str(value).strip() if not isinstance(value, bool) else ""


def visit(payload) -> Iterator[tuple[str, str, str, str, int, str]]:
    """(kind, id, parent id, parent's kind, position among its siblings, own scalar and leaf fields as JSON)."""
    # a stack of (value, kind or None, enclosing records by kind, position, key it stands under)
    stack = [(_decoded(payload), None, {}, 0, None)]
    while stack:
        value, kind, within, position, key = stack.pop()
        if isinstance(value, list):
            for i in range(len(value) - 1, -1, -1):
                stack.append((_decoded(value[i]) if kind else value[i], kind, within, i, None))
            continue
        if not isinstance(value, dict):
            continue
        if kind == "fact" and "id" not in value and key is None and value and all(isinstance(_decoded(v), (dict, str, type(None))) for v in value.values()) and not ({"match", "answer"} & value.keys()):
            # facts by key: each value is a fact named by its key
            for i, (k, v) in reversed(list(enumerate(value.items()))):
                fact = _decoded(v)
                stack.append((fact if isinstance(fact, dict) else {"answer": v} if v is not None else {}, kind, within, i, k))
            continue
        inner = within
        if kind:
            own = _id_of(value.get(ID_FIELD[kind])) or (key if kind == "fact" and key else "")
            if own:
                parent, parent_kind = _parent(kind, value, within)
                leaf = {k: v for k, v in value.items() if k not in PARTS and k != ID_FIELD[kind]}
                yield kind, own, parent, parent_kind, position, deepjson.dumps(leaf)
                inner = {**within, kind: own}
                if kind == "document":
                    inner = {"document": own}
                elif kind == "unit":
                    inner.pop("chunk", None)
        for k in reversed(list(value)):
            part = PARTS.get(k)
            if part == "answer" and kind != "fact":
                part = None
            v = _decoded(value[k]) if part or kind is None else value[k]
            if isinstance(v, (dict, list)):
                # records keep their own leaf parts; only wrappers and parts are descended into
                if part or kind is None or k == "dialogue":
                    stack.append((v, part, inner, 0, None))


def _parent(kind: str, value: dict, within: dict[str, str]) -> tuple[str, str]:
    if kind in ("document", "case"):
        return "", ""
    if kind == "chunk":
        if "chunk" in within:
            return within["chunk"], "chunk"
        order = (("unit", _id_of(value.get("unit_id")) or within.get("unit")), ("document", within.get("document")))
    elif kind == "unit":
        order = (("unit", _id_of(value.get("parent_unit_id")) or within.get("unit")), ("document", within.get("document")))
    elif kind == "fact":
        order = (("case", within.get("case")),)
    else:
        order = (("fact", within.get("fact")),)
    return next(((p, k) for k, p in order if p), ("", ""))


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), *[pa.string()] * 4, pa.int32(), pa.string()]
    names = [x.split(" ")[0] for x in EMITTED.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

    for batch in batches:
        out: list[tuple] = []
        size = 0
        for payload_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            try:
                payload = deepjson.loads(text) if text and text.strip() else None
            except ValueError:
                out.append((payload_id, "invalid", "", "", "", 0, None))
                continue
            for row in visit(payload):
                out.append((payload_id, *row))
                size += 100 + len(row[-1] or "")
                if size > 8_000_000:
                    yield batch_of(out)
                    out, size = [], 0
        if out:
            yield batch_of(out)


def flatten(payloads: DataFrame) -> DataFrame:
    """payloads(payload_id, payload, ...) -> tagged rows, columns as EMITTED.

    A payload that is null, blank or empty has no records. One that is not valid JSON gives one row of the kind ``invalid``,
    so that it can be reported. Neither levels nor encodings are bounded. Records without an id have no row of their own (answers need none); what they enclose
    hangs on the next record outside. Repeated payload rows repeat their records.
    """
    return payloads.select(F.col("payload_id").cast("bigint").alias("payload_id"), F.col("payload").cast("string").alias("payload")).mapInArrow(_emit, EMITTED)


def write_tables(tagged: DataFrame, path: str, mode: str = "error") -> None:
    """All kinds in one write, one folder a kind."""
    tagged.write.mode(mode).partitionBy("record_kind").parquet(path)


def typed_table(tagged: DataFrame, kind: str) -> DataFrame:
    """The flat table of one kind, its fields as columns; parts that vary in form stay JSON text."""
    fields = T.StructType.fromDDL(TYPED[kind])
    parsed = tagged.where(F.col("record_kind") == kind).withColumn("_f", F.from_json("fields", fields))
    return parsed.select("payload_id", F.col("record_id").alias(f"{kind}_id"), "parent_id", "parent_kind", "position", *[F.col(f"_f.{f.name}") for f in fields])
