"""JSON of any depth: the standard parser and writer, and where those reach their recursion limit the same without recursion."""

from __future__ import annotations

import json
import re
from json.decoder import scanstring

_SPACE = re.compile(r"[ \t\n\r]*")
_SCALAR = re.compile(r"(?P<number>-?(?:0|[1-9]\d*)(?P<real>(?:\.\d+)?(?:[eE][-+]?\d+)?))|(?P<word>true|false|null|NaN|Infinity|-Infinity)", re.A)
_WORDS = {"true": True, "false": False, "null": None, "NaN": float("nan"), "Infinity": float("inf"), "-Infinity": float("-inf")}


def loads(text: str):
    try:
        return json.loads(text)
    except RecursionError:
        return _loads(text)


def _loads(text: str):
    """As json.loads; the values being built are on a stack of (container, key that waits for its value)."""

    def fail(at: int):
        raise json.JSONDecodeError("not JSON", text, at)

    space = lambda at: _SPACE.match(text, at).end()

    def key_at(at: int) -> tuple[str, int]:
        if text[at : at + 1] != '"':
            fail(at)
        key, at = scanstring(text, at + 1)
        at = space(at)
        return (key, space(at + 1)) if text[at : at + 1] == ":" else fail(at)

    stack: list[tuple[list | dict, str | None]] = []
    at = space(0)
    while True:
        # a value begins here
        c = text[at : at + 1]
        if c == "{" or c == "[":
            value, at = ({} if c == "{" else []), space(at + 1)
            if text[at : at + 1] != ("}" if c == "{" else "]"):
                key = None
                if c == "{":
                    key, at = key_at(at)
                stack.append((value, key))
                continue
            at += 1
        elif c == '"':
            value, at = scanstring(text, at + 1)
        else:
            m = _SCALAR.match(text, at)
            if not m:
                fail(at)
            value = _WORDS[m["word"]] if m["word"] else float(m["number"]) if m["real"] else int(m["number"])
            at = m.end()
        # a value has ended; it goes into what holds it, which may end with it
        while stack:
            holder, key = stack.pop()
            if isinstance(holder, dict):
                holder[key] = value
            else:
                holder.append(value)
            at = space(at)
            c, at = text[at : at + 1], at + 1
            if c == ",":
                at, key = space(at), None
                if isinstance(holder, dict):
                    key, at = key_at(at)
                stack.append((holder, key))
                break
            if c != ("}" if isinstance(holder, dict) else "]"):
                fail(at - 1)
            value = holder
        else:
            if space(at) != len(text):
                fail(at)
            return value


def dumps(value) -> str:
    try:
        return json.dumps(value, ensure_ascii=False)
    except RecursionError:
        return _dumps(value)


def _dumps(value) -> str:
    """As json.dumps; what is still to be written is on a stack, texts that are written as they are in tuples of one."""
    out: list[str] = []
    stack: list = [value]
    while stack:
        v = stack.pop()
        if isinstance(v, tuple):
            out.append(v[0])
        elif isinstance(v, dict) and v:
            stack.append(("}",))
            items = [(json.dumps(str(k), ensure_ascii=False), x) for k, x in v.items()]
            for n, (k, x) in reversed(list(enumerate(items))):
                stack += [x, (f"{', ' if n else '{'}{k}: ",)]
        elif isinstance(v, list) and v:
            stack.append(("]",))
            for n, x in reversed(list(enumerate(v))):
                stack += [x, (", " if n else "[",)]
        else:
            out.append(json.dumps(v, ensure_ascii=False))
    return "".join(out)
