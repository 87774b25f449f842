"""A document too large for one index, read window by window.

A window ends before a comma outside strings. Around it are put the opening signs of the containers that it begins in, and the closing ones of those that it
leaves open, which makes it a document of its own for ``JsonIndex``. What is carried from window to window is one entry for each open container.
The document is walked twice: first to know whether it is one at all, and which members of containers that span windows are repeated later; then
to give its values.
"""

from __future__ import annotations

import hashlib
import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from keyweave.functions.json_index import LIST, OBJECT, JsonIndex

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_OPENING, _CLOSING = {OBJECT: b"{", LIST: b"["}, {OBJECT: b"}", LIST: b"]"}


@dataclass
class Open:
    """A container that isn't closed yet: its own values, and its children so far."""

    node: int
    parent: int
    key: str | None
    place: int
    kind: int
    level: int
    start: int
    children: int = 0
    shadowed: bool = False


def _outside(chunk: np.ndarray) -> np.ndarray:
    """Places of commas and brackets outside strings, in a stretch that begins outside one."""
    quotes, escapes = np.flatnonzero(chunk == 34), np.flatnonzero(chunk == 92)
    if len(escapes):
        begins = np.diff(escapes, prepend=-2) != 1
        first = escapes[begins][np.cumsum(begins) - 1]
        quotes = np.setdiff1d(quotes, escapes[(escapes - first) % 2 == 0] + 1, assume_unique=True)
    signs = np.flatnonzero((chunk == 44) | (chunk == 91) | (chunk == 93) | (chunk == 123) | (chunk == 125))
    return signs[np.searchsorted(quotes, signs) % 2 == 0]


def _cut(data: np.ndarray, start: int, size: int) -> tuple[int, np.ndarray]:
    """Where a window from ``start`` ends: at the last comma within ``size``, or if there is none within more; and its signs outside strings."""
    while True:
        chunk = data[start:start + size]
        signs = _outside(chunk)
        if start + size >= len(data):
            return len(data), signs
        commas = signs[chunk[signs] == 44]
        if len(commas):
            return start + int(commas[-1]), signs[signs < commas[-1]]
        size *= 2


def _left_open(chunk: np.ndarray, signs: np.ndarray, open_: list[int]) -> list[int]:
    """Kinds of the containers that are open after a window."""
    sign = chunk[signs]
    sign, step = sign[sign != 44], np.where((sign[sign != 44] == 91) | (sign[sign != 44] == 123), 1, -1)
    depth = len(open_) + np.cumsum(step)
    kept = max(0, min([len(open_), *([int(depth.min())] if len(depth) else [])]))
    later = np.minimum.accumulate(depth[::-1])[::-1] if len(depth) else depth
    fresh = sign[(step > 0) & (later >= depth) & (depth > kept)]
    return open_[:kept] + [OBJECT if s == 123 else LIST for s in fresh.tolist()]


@dataclass
class Window:
    """Nodes of a window: ``index`` numbers first the ``len(stack)`` containers that it begins in, then its own from ``first``."""

    index: JsonIndex
    stack: list[Open]
    first: int
    begin: int
    prefix: int
    stop: int
    opened: list[int] = field(default_factory=list)
    hidden: np.ndarray | None = None

    def number(self, nodes: np.ndarray) -> np.ndarray:
        """Numbers in the document; -1 stays."""
        d = len(self.stack)
        own = np.array([o.node for o in self.stack] + [0])
        return np.where(nodes < 0, -1, np.where(nodes < d, own[np.minimum(nodes, d)], self.first + nodes - d))

    def place(self, nodes: np.ndarray) -> np.ndarray:
        """Places among siblings: before the first in a window come those of earlier ones."""
        d, parents = len(self.stack), self.index.parent[nodes]
        # the container in front of a window's first own child is one of the children so far
        before = np.array([o.children - (i + 1 < d) for i, o in enumerate(self.stack)] + [0])
        return self.index.rank[nodes] + before[np.where(parents < 0, d, np.minimum(parents, d))]

    def start(self, nodes: np.ndarray) -> np.ndarray:
        return self.index.start[nodes] - self.prefix + self.begin

    def end(self, nodes: np.ndarray) -> np.ndarray:
        return self.index.end[nodes] - self.prefix + self.begin

    def spanning(self) -> np.ndarray:
        """Containers that begin before the window or end after it."""
        return np.concatenate([np.arange(len(self.stack)), np.array(self.opened, dtype=np.int64)])


def windows(data: np.ndarray, size: int) -> Iterator[Window]:
    """Windows of a document's bytes; ValueError where it isn't one. The caller may set ``hidden`` of a window."""
    stack: list[Open] = []
    begin, first = 0, 0
    while True:
        stop, signs = _cut(data, begin, size)
        chunk = data[begin:stop]
        raw = chunk.tobytes()
        bare = raw.strip(b" \t\r\n")
        last = stop == len(data)
        # signs beside a cut comma that are right in the window but not beside a comma
        if not bare or begin and bare[:1] in b"]}" or not last and bare[-1:] in b"[{":
            raise ValueError("no value beside a comma")
        open_ = [] if last else _left_open(chunk, signs, [o.kind for o in stack])
        keys = [b"" if o.key is None else json.dumps(o.key).encode() + b":" for o in stack]
        before = b"".join(k + _OPENING[o.kind] for k, o in zip(keys, stack))
        text = before + raw + b"".join(_CLOSING[k] for k in reversed(open_)) + b"\n"
        index = JsonIndex(pa.array([text], pa.binary()).cast(pa.string()))
        if index.bad[0] or not last and not open_:
            raise ValueError("malformed")
        d = len(stack)
        window = Window(index, stack, first, begin, len(before), stop)
        unclosed = np.flatnonzero(index.end > len(before) + len(raw)) if open_ else np.zeros(0, dtype=np.int64)
        window.opened = unclosed[unclosed >= d].tolist()
        opened = np.array(window.opened, dtype=np.int64)
        fresh = [Open(*x) for x in zip(window.number(opened).tolist(), window.number(index.parent[opened]).tolist(), index.keys_of(opened).to_pylist(),
                                       window.place(opened).tolist(), index.kind[opened].tolist(), index.level[opened].tolist(), window.start(opened).tolist())]
        children = np.bincount(index.parent[index.parent >= 0], minlength=index.size)
        yield window
        for i, o in enumerate(stack):
            o.children += int(children[i]) - (i + 1 < d)
        for o, node in zip(fresh, window.opened):
            o.children = int(children[node])
            o.shadowed = window.hidden is not None and bool(window.hidden[node])
        first += index.size - d
        if last:
            return
        stack = stack[:sum(1 for n in unclosed.tolist() if n < d)] + fresh
        begin = stop + 1


def repeated_members(data: np.ndarray, size: int) -> set[int]:
    """Members of containers that span windows whose key comes again in the container; ValueError where the data isn't a document."""
    found: list[np.ndarray] = []
    for w in windows(data, size):
        span = np.zeros(w.index.size + 1, dtype=bool)
        span[w.spanning()] = True
        nodes = np.flatnonzero(w.index.member & span[w.index.parent])
        nodes = nodes[nodes >= len(w.stack)]
        if len(nodes):
            digests = np.array([np.frombuffer(hashlib.blake2b(x.encode(), digest_size=16).digest(), dtype=np.int64) for x in w.index.names]).reshape(-1, 2)
            own = digests[w.index.codes[nodes]]
            found.append(np.column_stack([w.number(w.index.parent[nodes]), own[:, 0], own[:, 1], w.number(nodes)]))
    if not found:
        return set()
    rows = np.concatenate(found)
    rows = rows[np.lexsort(rows.T[::-1])]
    again = (rows[1:, :3] == rows[:-1, :3]).all(axis=1)
    return set(rows[:-1][again][:, 3].tolist())


def walked(data: np.ndarray, size: int) -> Iterator[tuple[Window, np.ndarray]]:
    """Windows of a document and which of their nodes are shadowed."""
    repeated = repeated_members(data, size)
    for w in windows(data, size):
        hidden = w.index.shadowed.copy()
        numbers = w.number(np.arange(w.index.size))
        wrong = [i for i, o in enumerate(w.stack) if o.shadowed]
        if repeated:
            wrong += np.flatnonzero(np.isin(numbers, np.fromiter(repeated, dtype=np.int64))).tolist()
        if wrong:
            hidden |= w.index._covered(np.array(sorted(set(wrong)), dtype=np.int64), True)
        w.hidden = hidden
        yield w, hidden
