"""Structural index of many JSON documents at once, in numpy: no Python step per token.

Documents lie one after another in one run of bytes, each with a line feed after it. Quotes, escapes and signs are found over all bytes, strings by
running parity of the quotes, depth by running sum, and containers by an order of the tokens by (depth, place): in it each opening sign is
followed by its closing one, and the tokens between two signs of a container stand together. Whether the tokens make a document is told by looking up (container,
token before, token) in one table. Cost is linear in the bytes, depth isn't bounded, and a malformed document doesn't touch its neighbours.

Of a key that occurs twice in one object the last one counts; the others are ``shadowed``, and all that is in them.
"""

from __future__ import annotations

import json
import re
import sys
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPACE, OPEN_OBJECT, CLOSE_OBJECT, OPEN_LIST, CLOSE_LIST, COLON, COMMA, STRING, ATOM, INSIDE = range(10)
KINDS = ["object", "list", "string", "number", "true", "false", "null"]
OBJECT, LIST, TEXT, NUMBER, TRUE, FALSE, NULL = range(7)
_ATOM = r"^(?:-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null)$"
_PAD = 8


def _table(entries: dict[bytes, int], rest: int = 0, kind=np.uint8) -> np.ndarray:
    out = np.full(256, rest, dtype=kind)
    for signs, value in entries.items():
        out[np.frombuffer(signs, dtype=np.uint8)] = value
    return out


_CLASS = _table({b" \t\r\n": SPACE, b"{": OPEN_OBJECT, b"}": CLOSE_OBJECT, b"[": OPEN_LIST, b"]": CLOSE_LIST, b":": COLON, b",": COMMA, b'"': INSIDE}, ATOM)
_ESCAPED = _table({b'"\\/bfnrtu': 1}).astype(bool)
_HEX = _table({b"0123456789abcdefABCDEF": 1}).astype(bool)
_STEP = np.zeros(10, dtype=np.int8)
_STEP[[OPEN_OBJECT, OPEN_LIST]], _STEP[[CLOSE_OBJECT, CLOSE_LIST]] = 1, -1
_ATOM_KIND = _table({b"t": TRUE, b"f": FALSE, b"n": NULL}, NUMBER)


def _grammar() -> np.ndarray:
    """Which tokens may follow which: [container: 0 none, 1 object, 2 list; token; token before, 0 none]."""
    ok = np.zeros((3, 10, 10), dtype=bool)
    values, ends = [OPEN_OBJECT, OPEN_LIST, STRING, ATOM], [CLOSE_OBJECT, CLOSE_LIST, STRING, ATOM]
    ok[0, values, 0] = True
    for v in values:
        ok[1, v, COLON] = True
        ok[2, v, [OPEN_LIST, COMMA]] = True
    ok[1, STRING, [OPEN_OBJECT, COMMA]] = True
    ok[1, COLON, STRING] = True
    ok[1, COMMA, ends] = ok[2, COMMA, ends] = True
    ok[1, CLOSE_OBJECT, [OPEN_OBJECT, *ends]] = True
    ok[2, CLOSE_LIST, [OPEN_LIST, *ends]] = True
    return ok.ravel()


_MAY = _grammar()


def joined_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places starts[0], starts[0] + 1, ... of every range in a row."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - ends + lengths, lengths)


def gathered(source: np.ndarray, starts: np.ndarray, lengths: np.ndarray, at_once: int = 1 << 22) -> np.ndarray:
    """Stretches of ``source`` in a row, a bounded number of bytes at once; a stretch longer than that is copied as it is."""
    ends = np.cumsum(lengths)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=source.dtype)
    first = 0
    while first < len(starts):
        done = int(ends[first - 1]) if first else 0
        stop = max(first + 1, int(np.searchsorted(ends, done + at_once, side="right")))
        if stop == first + 1:
            out[done:ends[first]] = source[starts[first]:starts[first] + lengths[first]]
        else:
            out[done:ends[stop - 1]] = source[joined_ranges(starts[first:stop], lengths[first:stop])]
        first = stop
    return out


def byte_bounds(texts: pa.Array) -> np.ndarray:
    """Where each text of an array begins in its bytes, and the last one ends."""
    if not len(texts):
        return np.zeros(1, dtype=np.int64)
    return np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)


def offsets_of(owners: np.ndarray, n: int) -> np.ndarray:
    """Where the entries of each of ``n`` owners begin in ``owners``, which ascends; one more at the end."""
    return np.searchsorted(owners, np.arange(n + 1))


class JsonIndex:
    """Index of the documents in a string array, each of them with a line feed added at its end; null ones have no nodes and aren't ``bad``.

    A node is a value, numbered in pre-order over all documents. ``doc``, ``kind``, ``start``, ``end`` (bytes, from the first of all documents),
    ``level`` (containers around it) and ``parent`` (node, -1 for a document's whole) have one entry a node.
    """

    def __init__(self, texts: pa.Array):
        raw = byte_bounds(texts)
        self.null = texts.is_null().to_numpy(zero_copy_only=False)
        self.docs, base, size = len(texts), int(raw[0]), int(raw[-1] - raw[0])
        self.bounds = raw - base
        self.data = np.full(size + _PAD, 10, dtype=np.uint8)
        if size:
            self.data[:size] = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[base:base + size]
        self.bad = np.zeros(self.docs, dtype=bool)
        self._nodes(*self._tokens(*self._strings()))

    def _fail(self, places: np.ndarray) -> None:
        self.bad[np.searchsorted(self.bounds, places, side="right") - 1] = True

    def _strings(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the quotes that open strings, and of those that close them."""
        data = self.data
        quotes, self.escapes = np.flatnonzero(data == 34), np.flatnonzero(data == 92)
        if len(self.escapes):
            begins = np.diff(self.escapes, prepend=-2) != 1
            first = self.escapes[begins][np.cumsum(begins) - 1]
            escaping = self.escapes[(self.escapes - first) % 2 == 0]
            sign = data[escaping + 1]
            self._fail(escaping[~_ESCAPED[sign]])
            points = escaping[sign == 117]
            if len(points):
                self._fail(points[~_HEX[data[points[:, None] + np.arange(2, 6)]].all(axis=1)])
            quotes = np.setdiff1d(quotes, escaping + 1, assume_unique=True)
        counts = np.diff(np.searchsorted(quotes, self.bounds))
        odd = np.flatnonzero(counts % 2)
        if len(odd):
            self.bad[odd] = True
            quotes = quotes[np.repeat(counts % 2 == 0, counts)]
        return quotes[::2], quotes[1::2]

    def _tokens(self, opens: np.ndarray, closes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Place, end, class and document of the tokens of documents that aren't bad so far."""
        data = self.data
        marks = np.zeros(len(data), dtype=np.uint8)
        marks[opens] = marks[closes] = 1
        inside = np.bitwise_xor.accumulate(marks).view(bool)
        self._fail(np.flatnonzero(inside & (data < 32)))
        classes = _CLASS[data]
        classes[inside] = classes[closes] = INSIDE
        classes[opens] = STRING
        del marks, inside
        atom = classes == ATOM
        begins = atom.copy()
        begins[1:] &= ~atom[:-1]
        ends = atom.copy()
        ends[:-1] &= ~atom[1:]
        token = begins | ((classes - np.uint8(1)) < STRING)
        place = np.flatnonzero(token)
        kind = classes[place]
        stop = place + 1
        stop[kind == STRING] = closes + 1
        atom_ends = np.flatnonzero(ends) + 1
        stop[kind == ATOM] = atom_ends
        starts = place[kind == ATOM]
        if len(starts):
            offsets = np.concatenate([[0], np.cumsum(atom_ends - starts)]).astype(np.int32)
            texts = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[atom])]).dictionary_encode()
            fine = pc.match_substring_regex(texts.dictionary, _ATOM).to_numpy(zero_copy_only=False)
            self._fail(starts[~fine[texts.indices.to_numpy()]])
        counts = np.diff(np.searchsorted(place, self.bounds))
        self.bad |= (counts == 0) & ~self.null
        doc = np.repeat(np.arange(self.docs), counts)
        depth = np.cumsum(_STEP[kind], dtype=np.int32)
        firsts = np.concatenate([[0], np.cumsum(counts)])
        full = np.flatnonzero(counts)
        before = np.where(firsts[full] > 0, depth[firsts[full] - 1], 0)
        if len(full):
            lowest = np.minimum.reduceat(depth, firsts[full]) - before
            self.bad[full[(lowest < 0) | (depth[firsts[full + 1] - 1] != before)]] = True
        if self.bad.any():
            keep = ~self.bad[doc]
            place, stop, kind, doc = place[keep], stop[keep], kind[keep], doc[keep]
            depth = np.cumsum(_STEP[kind], dtype=np.int32)
        return place, stop, kind, doc, depth

    def _nodes(self, place: np.ndarray, stop: np.ndarray, kind: np.ndarray, doc: np.ndarray, depth: np.ndarray) -> None:
        n = len(place)
        opening = (kind == OPEN_OBJECT) | (kind == OPEN_LIST)
        closing = (kind == CLOSE_OBJECT) | (kind == CLOSE_LIST)
        level = depth - opening
        order = np.argsort(level.astype(np.int16) if n and level.max() < 1 << 15 else level, kind="stable")
        at = np.empty(n, dtype=np.int64)
        at[order] = np.arange(n)
        opens = order[opening[order]]
        closer = order[np.minimum(at[opens] + 1, n - 1)] if n else opens
        wrong = kind[closer] != kind[opens] + 1
        stop[opens] = stop[closer]
        # the tokens of a container stand together in the order, from the one after its opening sign
        full = opens[closer != opens + 1]
        group = np.zeros(n, dtype=np.int64)
        if n:
            group[at[full + 1]] = 1
        container = np.empty(n, dtype=np.int64)
        container[order] = np.concatenate([[-1], full])[np.cumsum(group)]
        container[closer] = opens
        inside = np.concatenate([kind, [0]])[container]  # -1 takes the 0 at the end
        previous = np.zeros(n, dtype=np.uint8)
        previous[1:] = np.where(doc[1:] == doc[:-1], kind[:-1], 0)
        context = np.where(inside == OPEN_OBJECT, 1, np.where(inside == OPEN_LIST, 2, 0))
        fine = _MAY[context * 100 + kind * 10 + previous]
        key = (kind == STRING) & (context == 1) & (previous != COLON)
        fine[1:] &= (kind[1:] == COLON) == key[:-1]
        fine[opens[wrong]] = False
        self.bad[doc[~fine]] = True
        value = (opening | (kind == STRING) | (kind == ATOM)) & ~key & ~self.bad[doc]
        token = np.flatnonzero(value)
        number = np.full(n + 1, -1, dtype=np.int64)
        number[token] = np.arange(len(token))
        self.doc, self.start, self.end, self.level = doc[token], place[token], stop[token], level[token]
        self.parent = number[container[token]]
        own = kind[token]
        self.kind = np.where(own == OPEN_OBJECT, OBJECT, np.where(own == OPEN_LIST, LIST, np.where(own == STRING, TEXT, _ATOM_KIND[self.data[self.start]])))
        self.member = context[token] == 1
        members = token[self.member]
        self._keys = place[members - 2] + 1, stop[members - 2] - 1
        #: Where a member begins with its key, an item or document with its value.
        self.begin = self.start.copy()
        self.begin[self.member] = self._keys[0] - 1
        self._siblings = number[order[value[order]]]

    @property
    def size(self) -> int:
        return len(self.doc)

    # texts

    def texts(self, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
        """Texts of stretches of the documents, which may overlap."""
        if len(starts) and (starts[1:] >= ends[:-1]).all():
            offsets = np.stack([starts, ends], axis=1).ravel().astype(np.int32)
            between = pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(self.data)])
            return between.take(pa.array(np.arange(len(starts)) * 2))
        lengths = ends - starts
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        return pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(gathered(self.data, starts, lengths))])

    def values(self, nodes: np.ndarray) -> pa.Array:
        """JSON text of nodes as it stands in the document."""
        return self.texts(self.start[nodes], self.end[nodes])

    def escaped(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether stretches hold a backslash."""
        if not len(self.escapes):
            return np.zeros(len(starts), dtype=bool)
        return np.searchsorted(self.escapes, starts) < np.searchsorted(self.escapes, ends)

    def strings(self, starts: np.ndarray, ends: np.ndarray) -> pa.DictionaryArray:
        """Decoded contents of strings, given without their quotes."""
        coded = self.texts(starts, ends).dictionary_encode()
        if not self.escaped(starts, ends).any():
            return coded
        names = [decoded(x) if "\\" in x else x for x in coded.dictionary.to_pylist()]
        again = pa.array(names, pa.string()).dictionary_encode()
        return pa.DictionaryArray.from_arrays(again.indices.take(coded.indices), again.dictionary)

    # keys

    @cached_property
    def _coded(self) -> tuple[list[str], np.ndarray]:
        """Different keys, and each node's (-1 if it has none)."""
        coded = self.strings(*self._keys)
        codes = np.full(self.size, -1, dtype=np.int64)
        codes[self.member] = coded.indices.to_numpy()
        return coded.dictionary.to_pylist(), codes

    @property
    def names(self) -> list[str]:
        return self._coded[0]

    @property
    def codes(self) -> np.ndarray:
        return self._coded[1]

    def keys_of(self, nodes: np.ndarray) -> pa.Array:
        codes = self.codes[nodes]
        return pa.array(self.names, pa.string()).take(pa.array(codes, mask=codes < 0))

    # containment

    def _covered(self, nodes: np.ndarray, itself: bool) -> np.ndarray:
        """Nodes inside any of the given ones."""
        change = np.zeros(self.size + 1, dtype=np.int64)
        np.add.at(change, nodes + (not itself), 1)
        # what is in a node is numbered from it up to the first that begins after its end
        np.add.at(change, np.searchsorted(self.start, self.end[nodes]), -1)
        return np.cumsum(change[:-1]) > 0

    @cached_property
    def shadowed(self) -> np.ndarray:
        """Nodes that don't count since a later member of the same object has their key, or the key of a value around them."""
        out = np.zeros(self.size, dtype=bool)
        members = np.flatnonzero(self.member)
        pairs = self.parent[members] * (len(self.names) + 1) + self.codes[members]
        ordered = np.sort(pairs)
        if len(pairs) and (ordered[1:] == ordered[:-1]).any():
            by = np.argsort(pairs, kind="stable")
            repeated = np.flatnonzero(pairs[by][1:] == pairs[by][:-1])
            out = self._covered(members[by][repeated], True)
        return out

    @cached_property
    def in_lists(self) -> np.ndarray:
        """Nodes in a list that is an item of a list."""
        lists = np.flatnonzero((self.kind == LIST) & (self.parent >= 0))
        nested = lists[self.kind[self.parent[lists]] == LIST]
        return self._covered(nested, False) if len(nested) else np.zeros(self.size, dtype=bool)

    # siblings

    @cached_property
    def _ranks(self) -> tuple[np.ndarray, np.ndarray]:
        """Each node's place among its siblings, and the sibling before it (-1 for the first)."""
        ordered = self._siblings
        parents = self.parent[ordered]
        new = np.ones(len(ordered), dtype=bool)
        new[1:] = (parents[1:] != parents[:-1]) | (parents[1:] < 0)
        first = np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0))
        rank, previous = np.empty(self.size, dtype=np.int64), np.full(self.size, -1, dtype=np.int64)
        rank[ordered] = np.arange(len(ordered)) - first
        previous[ordered[~new]] = ordered[np.flatnonzero(~new) - 1]
        return rank, previous

    @property
    def rank(self) -> np.ndarray:
        return self._ranks[0]

    def leading(self, nodes: np.ndarray) -> np.ndarray:
        """Of members with the same key (in their order, all of those that have it), whether all before them in their object are among them."""
        rank, _ = self._ranks
        parents = self.parent[nodes]
        by = np.argsort(parents, kind="stable")
        new = np.ones(len(nodes), dtype=bool)
        new[1:] = parents[by][1:] != parents[by][:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(len(nodes)), 0)) if len(nodes) else np.zeros(0, dtype=np.int64)
        out = np.empty(len(nodes), dtype=bool)
        out[by] = rank[nodes[by]] == np.arange(len(nodes)) - first
        return out

    def cuts(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Stretches that are gone with members: with the comma before them, or if they lead their object with the one after."""
        rank, previous = self._ranks
        following = np.full(self.size, -1, dtype=np.int64)
        later = np.flatnonzero(previous >= 0)
        following[previous[later]] = later
        leads, after, before = self.leading(nodes), following[nodes], previous[nodes]
        return (np.where(leads, self.begin[nodes], self.end[before]),
                np.where(leads & (after >= 0), self.begin[after], self.end[nodes]))

    def outermost(self, nodes: np.ndarray) -> np.ndarray:
        """Of ascending nodes, those that lie in no other of them."""
        reach = np.maximum.accumulate(self.end[nodes]) if len(nodes) else nodes
        keep = np.ones(len(nodes), dtype=bool)
        keep[1:] = self.start[nodes[1:]] >= reach[:-1]
        return nodes[keep]

    # paths

    def paths(self, nodes: np.ndarray) -> pa.Array:
        """JSON pointers of nodes: the steps from each to the top are walked for all of them together."""
        levels = self.level[nodes]
        offsets = np.concatenate([[0], np.cumsum(levels)])
        steps = np.empty(int(offsets[-1]), dtype=np.int64)  # keys by code, places in lists after all keys
        at, here, slot = nodes, np.arange(len(nodes)), offsets[1:] - 1
        rank, keys = self.rank, len(self.names)
        while len(at):
            deep = self.level[at] > 0
            at, here = at[deep], here[deep]
            codes = self.codes[at]
            steps[slot[here]] = np.where(codes >= 0, codes, keys + rank[at])
            slot[here] -= 1
            at = self.parent[at]
        used, codes = np.unique(steps, return_inverse=True)
        names = ["/" + (self.names[c].replace("~", "~0").replace("/", "~1") if c < keys else str(c - keys)) for c in used.tolist()]
        parts = pa.array(names, pa.string()).take(pa.array(codes))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), parts), "")

    # documents

    @cached_property
    def depths(self) -> np.ndarray:
        """Nested containers of each document, 0 for a scalar."""
        out = np.zeros(self.docs, dtype=np.int64)
        first = offsets_of(self.doc, self.docs)
        full = np.flatnonzero(np.diff(first))
        if len(full):
            out[full] = np.maximum.reduceat(self.level + (self.kind <= LIST), first[full])
        return out

    def problem(self, doc: int) -> str:
        return problem(self.data[self.bounds[doc]:self.bounds[doc + 1]].tobytes())

    def lists(self, nodes: np.ndarray, values: pa.Array) -> pa.ListArray:
        """Values of ascending nodes as a list for each document, null for null and malformed ones."""
        offsets = offsets_of(self.doc[nodes], self.docs)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, mask=pa.array(self.bad | self.null))

    def counts(self, nodes: np.ndarray) -> pa.Array:
        """Number of ascending nodes of each document, null for null and malformed ones."""
        return pa.array(np.diff(offsets_of(self.doc[nodes], self.docs)), mask=self.bad | self.null)

    def replaced(self, docs: np.ndarray, starts: np.ndarray, ends: np.ndarray, texts: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> pa.Array:
        """All documents, with ascending stretches that don't overlap replaced by ``lengths`` bytes from ``at`` in ``texts``."""
        size = int(self.bounds[-1])
        cuts = np.stack([starts, ends], axis=1).ravel()
        # the line feed at the end of a document isn't its own
        tails = np.flatnonzero(~self.null)
        own = np.concatenate([docs.repeat(2), tails.repeat(2)])
        marks = np.concatenate([cuts, np.stack([self.bounds[tails + 1] - 1, self.bounds[tails + 1]], axis=1).ravel()])
        fills = np.concatenate([np.stack([at + size, at * 0], axis=1).ravel(), np.zeros(2 * len(tails), dtype=np.int64)])
        counts = np.concatenate([np.stack([lengths, lengths * 0], axis=1).ravel(), np.zeros(2 * len(tails), dtype=np.int64)])
        order = np.argsort(own, kind="stable")  # of one document: its stretches ascend, the end comes last
        marks, fills, counts, own = marks[order], fills[order], counts[order], own[order]
        begin = np.concatenate([[0], marks])[:-1]
        kept = np.where(np.arange(len(marks)) % 2 == 0, marks - begin, 0)  # before the start of a stretch is kept, before its end is not
        starts_, lengths_ = np.stack([begin, fills], axis=1).ravel(), np.stack([kept, counts], axis=1).ravel()
        source = np.concatenate([self.data[:size], texts])
        lengths_of = np.zeros(self.docs, dtype=np.int64)
        np.add.at(lengths_of, own, kept + counts)
        offsets = np.concatenate([[0], np.cumsum(lengths_of)]).astype(np.int32)
        made = gathered(source, starts_, lengths_)
        valid = pa.array(~self.null).buffers()[1] if self.null.any() else None
        return pa.Array.from_buffers(pa.string(), self.docs, [valid, pa.py_buffer(offsets), pa.py_buffer(made)])


def decoded(content: str) -> str:
    """Text of a string given without its quotes; an unpaired surrogate can't be stored and becomes a replacement sign."""
    return json.loads(f'"{content}"').encode("utf-16", "surrogatepass").decode("utf-16", "replace")


_TOKEN = re.compile(rb'[ \t\r\n]*(?:([{}\[\],:])|("[^"\\\x00-\x1f]*(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1f]*)*")'
                    rb'|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)|(true|false|null))')
_SPACE = re.compile(rb"[ \t\r\n]*\Z")


def problem(data: bytes) -> str | None:
    """What keeps bytes from being one JSON document: only malformed ones are read token by token, to tell where they go wrong."""
    at, want, open_ = 0, "value", []
    while want != "end":
        m = _TOKEN.match(data, at)
        if not m:
            return f"no JSON at byte {at}"
        sign, quoted, _, _ = m.groups()
        start, at = m.start(m.lastindex), m.end()
        if want in ("key", "first key") and quoted:
            want = "colon"
        elif want == "colon" and sign == b":":
            want = "value"
        elif want in ("value", "first value") and sign in (b"{", b"["):
            open_.append(sign)
            want = "first key" if sign == b"{" else "first value"
        elif want in ("value", "first value") and not sign:
            want = "more" if open_ else "end"
        elif want == "more" and sign == b",":
            want = "key" if open_[-1] == b"{" else "value"
        elif sign and open_ and sign == (b"}" if open_[-1] == b"{" else b"]") and want in ("more", "first key", "first value"):
            open_.pop()
            want = "more" if open_ else "end"
        else:
            return f"unexpected token at byte {start}"
    return None if _SPACE.match(data, at) else f"text after the document at byte {at}"
