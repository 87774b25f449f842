"""Documents read token by token with a stack: what the index of a whole batch must agree with."""

from __future__ import annotations

import json
import re

TOKEN = re.compile(rb'[ \t\r\n]*(?:([{}\[\],:])|("[^"\\\x00-\x1f]*(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1f]*)*")'
                   rb'|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)|(true|false|null))')


def nodes(data: bytes) -> list[dict] | None:
    """Values in pre-order; None for anything but one JSON value."""
    found: list[dict] = []
    at = value(data, 0, found, None, [])
    return found if at is not None and not data[at:].strip(b" \t\r\n") else None


def token(data, at):
    m = TOKEN.match(data, at)
    return (m.start(m.lastindex), m.end(), m.lastindex) if m else (at, at, 0)


def text(data):
    return json.loads(data).encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def value(data, at, found, parent, above, key=None, begin=None, rank=0):
    start, end, kind = token(data, at)
    sign = data[start:end]
    if not kind or kind == 1 and sign not in (b"{", b"["):
        return None
    own = dict(key=key, parent=parent, start=start, end=end, begin=start if begin is None else begin, level=len(above), rank=rank, shadowed=False,
               kind={b"{": "object", b"[": "list"}.get(sign, {2: "string", 3: "number"}.get(kind) or sign.decode()),
               in_lists=any(a["kind"] == "list" and a["parent"] is not None and found[a["parent"]]["kind"] == "list" for a in above))
    number = len(found)
    found.append(own)
    if kind != 1:
        return end
    close, at, count, members = (b"}" if sign == b"{" else b"]"), end, 0, {}
    while True:
        start, end, kind = token(data, at)
        if data[start:end] == close and not (count and data[at - 1:at] == b","):
            own["end"] = end
            return end
        if count and data[at - 1:at] != b",":
            if data[start:end] != b",":
                return None
            at = end
            continue
        name = begin = None
        if sign == b"{":
            if kind != 2:
                return None
            name, begin = text(data[start:end]), start
            start, at, kind = token(data, end)
            if data[start:at] != b":":
                return None
            if name in members:
                for x in found[members[name]:members[name] + sizes(found, members[name])]:
                    x["shadowed"] = True
            members[name] = len(found)
        at = value(data, at, found, number, [*above, own], name, begin, count)
        if at is None:
            return None
        count += 1
        start, end, kind = token(data, at)
        if data[start:end] == b",":
            at = end


def sizes(found, first):
    """Nodes of a value."""
    return sum(1 for x in found[first:] if x["start"] < found[first]["end"])
