"""Search and edit JSON text at any depth.

Documents are read a batch at a time by ``json_index``: one Arrow function finds the values of all documents of a batch in numpy and answers from them,
so cost is linear in the text and depth isn't bounded. Searches give what is asked for only, paths and texts of hits alone; edits put new
text into the document at the places found, so that what is not edited keeps its bytes. Batches are cut by bytes: memory follows from the largest document, not
from the number of rows.

Every function reads its document anew; ``ask`` answers several questions from one reading. Several edits of a document go in columns one after another
(``withColumn``), not into one another in a single expression. ``json_nodes`` gives a table's documents as rows, a value each.

Only strict JSON is a document: one value, double quotes, no ``NaN``. For anything else searches give null and edits the text unchanged;
``json_error`` tells what is wrong with it and ``split_malformed`` parts such rows. Of a key that occurs twice in one object the last one
counts; the others are neither found nor updated, and deleted along.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyweave.functions.json_index import KINDS, LIST, NULL, NUMBER, OBJECT, TEXT, FALSE, TRUE, JsonIndex, byte_bounds, decoded, offsets_of
from keyweave.functions.json_windows import walked
from keyweave.functions.patterns import Automaton

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BATCH_BYTES = 1 << 20
WINDOW_BYTES = 2 << 20
NODES_AT_ONCE = 50_000


@dataclass(frozen=True)
class Question:
    """What is asked of a document: the type of the answer, and how a batch answers. ``given`` are columns that it needs beside the document."""

    type: pa.DataType
    answer: Callable[..., pa.Array]
    given: tuple[Column, ...] = ()


def _parts(documents: pa.Array) -> Iterator[tuple[int, int]]:
    """Rows from and to, of documents of about ``BATCH_BYTES`` together, one at least."""
    ends, start = byte_bounds(documents)[1:], 0
    while start < len(documents):
        before = ends[start - 1] if start else ends[0] - len(documents[0].as_buffer() or b"") if documents[0].is_valid else ends[0]
        stop = max(start + 1, int(np.searchsorted(ends, before + BATCH_BYTES, side="right")))
        yield start, stop
        start = stop


def _line(document: Column) -> Column:
    return F.concat(document, F.lit("\n"))


def ask(document: Column, **questions: Question) -> Column:
    """Answers to several questions about a document, a struct with a field for each, from one reading of it."""
    from pyspark.sql.pandas.types import from_arrow_type
    from pyspark.sql.types import StructField, StructType

    kind = pa.struct([pa.field(name, q.type) for name, q in questions.items()])
    answers, counts = [q.answer for q in questions.values()], [len(q.given) for q in questions.values()]

    def answered(documents: pa.Array, *given: pa.Array) -> pa.Array:
        made = []
        for start, stop in _parts(documents):
            index, rest = JsonIndex(documents.slice(start, stop - start)), list(given)
            columns = []
            for answer, n in zip(answers, counts):
                own, rest = rest[:n], rest[n:]
                columns.append(answer(index, *[x.slice(start, stop - start) for x in own]))
            made.append(pa.StructArray.from_arrays([c.cast(f.type) for c, f in zip(columns, kind)], fields=list(kind)))
        return pa.concat_arrays(made) if made else pa.array([], kind)

    def run(documents: pa.Array, *given: pa.Array) -> pa.Array:
        return answered(documents, *given)

    # declared nondeterministic so that the optimizer doesn't merge the search of an edited document with the edit: it can't
    # evaluate one Python function in the lambda expressions of another. So it runs once for each time it is written.
    ddl = StructType([StructField(f.name, from_arrow_type(f.type)) for f in kind])
    return F.arrow_udf(run, ddl).asNondeterministic()(_line(document), *[c for q in questions.values() for c in q.given])


def _ask(document: Column, question: Question) -> Column:
    return ask(document, answer=question)["answer"]


def json_error(document: Column) -> Column:
    """What keeps a text from being one JSON document; null for a document, and for null."""
    return _ask(document, Question(pa.string(), lambda index: pa.array([index.problem(i) if bad else None for i, bad in enumerate(index.bad.tolist())], pa.string())))


def split_malformed(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``column`` is a document (or null), and the others with their ``json_error``."""
    marked = df.withColumn("json_error", json_error(F.col(column)))
    return marked.where(F.col("json_error").isNull()).drop("json_error"), marked.where(F.col("json_error").isNotNull())


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def json_text(value: Column) -> Column:
    """JSON text of a column of any type, nulls included."""
    wrapped = F.to_json(F.array(value), {"ignoreNullFields": "false"})
    return _let(wrapped, lambda w: F.substring(w, F.lit(2), F.length(w) - 2))


def literal_json(value) -> Column:
    """JSON text of a Python value, or of a column."""
    return json_text(value) if isinstance(value, Column) else F.lit(json.dumps(value, separators=(",", ":")))


class Keys:
    """Keys that are looked for: each different key of a batch is compared once with all of them together."""

    def __init__(self, keys: list[str], wild: bool = False):
        self.wild = wild
        self.find = Automaton([k.lower() for k in keys]).find if wild else None
        self.numbers: dict[str, list[int]] = {}
        for i, k in enumerate(keys):
            self.numbers.setdefault(k, []).append(i)

    def of(self, name: str) -> list[int]:
        """Numbers of the keys that a name matches: by equality, or ``wild`` by being in it whatever its case."""
        return self.find(name.lower()) if self.wild else self.numbers.get(name, [])

    def hits(self, index: JsonIndex, shadowed: bool = False) -> np.ndarray:
        """Nodes with such a key, ascending."""
        known = np.array([bool(self.of(x)) for x in index.names] + [False])
        found = known[index.codes]
        return np.flatnonzero(found if shadowed else found & ~index.shadowed) if found.any() else np.zeros(0, dtype=np.int64)


_FOUND = pa.list_(pa.struct([("key", pa.string()), ("path", pa.string()), ("value", pa.string())]))


def find_values(key: str | list[str], wild: bool = False) -> Question:
    """``lookup`` as a question for ``ask``."""
    keys = Keys([key] if isinstance(key, str) else key, wild)

    def answer(index: JsonIndex) -> pa.Array:
        hits = keys.hits(index)
        return index.lists(hits, pa.StructArray.from_arrays([index.keys_of(hits), index.paths(hits), index.values(hits)], names=["key", "path", "value"]))

    return Question(_FOUND, answer)


def lookup(document: Column, key: str, *, wild: bool = False) -> Column:
    """Every value of a key as ``array<struct<key,path,value>>`` in pre-order; value is JSON text as it stands in the document.
    ``wild`` matches any key that contains the given text, whatever its case."""
    return _ask(document, find_values(key, wild))


_FOUND_BY = pa.list_(pa.struct([("pattern", pa.string()), ("key", pa.string()), ("path", pa.string()), ("value", pa.string())]))


def find_many(patterns: list[str], wild: bool = False) -> Question:
    """``lookup_many`` as a question for ``ask``."""
    keys, texts = Keys(patterns, wild), list(patterns)

    def answer(index: JsonIndex) -> pa.Array:
        nodes = keys.hits(index)
        by_code = [keys.of(x) for x in index.names]
        counts = np.array([len(x) for x in by_code] + [0])[index.codes[nodes]]
        hits = np.repeat(nodes, counts)
        which = np.array([n for c in index.codes[nodes].tolist() for n in by_code[c]], dtype=np.int64)
        once = np.repeat(np.arange(len(nodes)), counts)
        key, path, value = (x.take(pa.array(once)) for x in (index.keys_of(nodes), index.paths(nodes), index.values(nodes)))
        found = pa.array(texts, pa.string()).take(pa.array(which))
        return index.lists(hits, pa.StructArray.from_arrays([found, key, path, value], names=["pattern", "key", "path", "value"]))

    return Question(_FOUND_BY, answer)


def lookup_many(document: Column, patterns: list[str], *, wild: bool = False) -> Column:
    """Every value of any of the keys as ``array<struct<pattern,key,path,value>>`` in pre-order, one entry for each pattern that a
    key matches, in the order they are given. Keys are compared with all patterns at once."""
    if not patterns:
        raise ValueError("at least one key is needed")
    return _ask(document, find_many(patterns, wild))


def lookup_with_keys(document: Column, key: str, *, wild: bool = False) -> Column:
    """Map from each key found to the list of its values."""
    keys = Keys([key], wild)

    def answer(index: JsonIndex) -> pa.Array:
        hits = keys.hits(index)
        pairs = index.doc[hits] * (len(index.names) + 1) + index.codes[hits]
        by = np.argsort(pairs, kind="stable")
        firsts = np.flatnonzero(np.diff(pairs[by], prepend=-1))
        firsts = firsts[np.argsort(by[firsts], kind="stable")]  # of a document, keys in the order they first occur
        sizes = np.diff(np.append(np.flatnonzero(np.diff(pairs[by], prepend=-1)), len(by)))
        starts = np.flatnonzero(np.diff(pairs[by], prepend=-1))
        sizes = sizes[np.searchsorted(starts, firsts)]
        members = by[np.arange(sizes.sum()) + np.repeat(firsts - np.cumsum(sizes) + sizes, sizes)] if len(by) else by
        values = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), index.values(hits).take(pa.array(members)))
        owners = hits[by[firsts]]
        return index.lists(owners, pa.StructArray.from_arrays([index.keys_of(owners), values], names=["key", "values"]))

    kind = pa.list_(pa.struct([("key", pa.string()), ("values", pa.list_(pa.string()))]))
    return F.map_from_entries(_ask(document, Question(kind, answer)))


def find_keys() -> Question:
    """``all_keys`` as a question for ``ask``."""
    def answer(index: JsonIndex) -> pa.Array:
        hits = np.flatnonzero(index.member & ~index.shadowed)
        return index.lists(hits, index.keys_of(hits))

    return Question(pa.list_(pa.string()), answer)


def all_keys(document: Column) -> Column:
    """All keys in pre-order, repeats included."""
    return _ask(document, find_keys())


def count_key(key: str) -> Question:
    """``key_count`` as a question for ``ask``."""
    keys = Keys([key])

    def answer(index: JsonIndex) -> pa.Array:
        hits = keys.hits(index)
        return index.counts(hits[(index.kind[hits] != NULL) & ~index.in_lists[hits]])

    return Question(pa.int64(), answer)


def key_count(document: Column, key: str) -> Column:
    """Occurrences of a key with a value other than null; lists inside lists are not entered."""
    return _ask(document, count_key(key))


def _same_number(text: str, value: int | float) -> bool:
    """Numbers are equal by value (1 and 1.0 are), compared as whole numbers where both are."""
    if any(c in text for c in ".eE"):
        return float(text) == value if value == int(value) and float(value) == int(value) or value != int(value) else False
    return value == int(value) and (int(text) if len(text) < 4000 else None) == int(value)


def _same(found, value) -> bool:
    """Equality of JSON values: true isn't 1, 1 is 1.0, members may stand in any order."""
    if isinstance(value, dict):
        return isinstance(found, dict) and found.keys() == value.keys() and all(_same(found[k], value[k]) for k in value)
    if isinstance(value, list):
        return isinstance(found, list) and len(found) == len(value) and all(map(_same, found, value))
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return type(found) is type(value) and found == value
    return isinstance(found, _Number) and _same_number(found.text, value)


class _Number:
    """A number as it is written."""

    def __init__(self, text: str):
        self.text = text


def _same_text(text: str, value) -> bool:
    try:
        return _same(json.loads(text, parse_int=_Number, parse_float=_Number), value)
    except RecursionError:  # deeper than any value that can be asked for
        return False


def _equal_nodes(index: JsonIndex, value) -> np.ndarray:
    """Nodes that hold a Python scalar, list or dict, ascending."""
    if value is None or isinstance(value, bool):
        return np.flatnonzero(index.kind == {None: NULL, True: TRUE, False: FALSE}[value])
    if isinstance(value, str):
        nodes = np.flatnonzero(index.kind == TEXT)
        starts, ends = index.start[nodes] + 1, index.end[nodes] - 1
        escaped = index.escaped(starts, ends)
        likely = escaped | (ends - starts == len(value.encode("utf-8", "surrogatepass")))
        nodes, escaped = nodes[likely], escaped[likely]
        texts = index.texts(starts[likely], ends[likely])
        same = pc.equal(texts, value).to_numpy(zero_copy_only=False).copy()
        at = np.flatnonzero(escaped)
        same[at] = [decoded(x) == value for x in texts.take(pa.array(at)).to_pylist()]
        return nodes[same]
    if isinstance(value, (int, float)):
        if value != value or value in (float("inf"), float("-inf")):
            return np.zeros(0, dtype=np.int64)
        nodes = np.flatnonzero(index.kind == NUMBER)
        coded = index.values(nodes).dictionary_encode()
        likely = pc.match_substring_regex(coded.dictionary, "[.eE]")
        if value == int(value):
            likely = pc.or_(likely, pc.is_in(coded.dictionary, pa.array([str(int(value)), "-0"])))
        known = np.zeros(len(coded.dictionary), dtype=bool)
        at = np.flatnonzero(likely.to_numpy(zero_copy_only=False))
        known[at] = [_same_number(x, value) for x in coded.dictionary.take(pa.array(at)).to_pylist()]
        return nodes[known[coded.indices.to_numpy()]]
    nodes = np.flatnonzero((index.kind == (OBJECT if isinstance(value, dict) else LIST)) & index.member)
    children = np.bincount(index.parent[index.parent >= 0], minlength=index.size)
    nodes = nodes[children[nodes] >= len(value)]
    coded = index.values(nodes).dictionary_encode()
    known = np.array([_same_text(x, value) for x in coded.dictionary.to_pylist()], dtype=bool)
    return nodes[known[coded.indices.to_numpy()]]


def _value_hits(index: JsonIndex, value) -> np.ndarray:
    """Nodes that hold the value under a key or are it as a list item. Objects and lists in a list are searched (a list in a list is
    not), but not compared."""
    hits = _equal_nodes(index, value)
    return hits[~index.shadowed[hits] & ~index.in_lists[hits] & (index.parent[hits] >= 0) & (index.member[hits] | (index.kind[hits] > LIST))]


def count_value(value) -> Question:
    """``value_count`` as a question for ``ask``."""
    return Question(pa.int64(), lambda index: index.counts(_value_hits(index, value)))


def value_count(document: Column, value) -> Column:
    """Occurrences of a value under keys and as list items; lists inside lists are not entered."""
    return _ask(document, count_value(value))


def value_parents(document: Column, value) -> Column:
    """Each object with the value directly under one of its keys, once, as ``array<struct<path,parent>>`` in pre-order; parent is JSON text."""
    def answer(index: JsonIndex) -> pa.Array:
        hits = _value_hits(index, value)
        owners = np.unique(index.parent[hits[index.member[hits]]])
        return index.lists(owners, pa.StructArray.from_arrays([index.paths(owners), index.values(owners)], names=["path", "parent"]))

    return _ask(document, Question(pa.list_(pa.struct([("path", pa.string()), ("parent", pa.string())])), answer))


def value_occurrences(df: DataFrame, column: str, value) -> tuple[DataFrame, DataFrame]:
    """Over all documents of a table: the number of occurrences of a value (one row: occurrences), and the objects that hold it, one
    row each (the other columns, path, parent)."""
    counted = df.select(value_count(F.col(column), value).alias("n"))
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("occurrences"))
    held = df.withColumn("found", value_parents(F.col(column), value))
    rest = [c for c in df.columns if c != column]
    return total, held.select(*rest, F.explode("found").alias("found")).select(*rest, "found.path", "found.parent")


def _text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of texts, and where each begins (one more at the end)."""
    bounds = byte_bounds(texts)
    data = texts.buffers()[2] if len(texts) else None
    return (np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)), bounds


def _put(index: JsonIndex, nodes: np.ndarray, texts: pa.Array, which: np.ndarray) -> pa.Array:
    """All documents, with the values of ``nodes`` (ascending, apart) replaced by the texts of these numbers."""
    data, bounds = _text_buffer(texts)
    return index.replaced(index.doc[nodes], index.start[nodes], index.end[nodes], data, bounds[which], bounds[which + 1] - bounds[which])


def update(document: Column, key: str, value) -> Column:
    """Set every occurrence of a key to one value (a Python value or a column). Never adds the key."""
    keys = Keys([key])

    def answer(index: JsonIndex, texts: pa.Array) -> pa.Array:
        nodes = index.outermost(keys.hits(index))
        return _put(index, nodes, texts, index.doc[nodes])

    return _ask(document, Question(pa.string(), answer, (literal_json(value),)))


def update_each(document: Column, key: str, values) -> Column:
    """Give the occurrences of a key the listed values in pre-order; the last value repeats.

    ``values`` is a list or an array column; an empty or null array leaves the document unchanged. An occurrence inside a replaced value
    uses up an item of the list as well, although it is gone from the result.
    """
    if isinstance(values, Column):
        given = F.transform(values, json_text)
    elif isinstance(values, list) and values:
        given = F.array(*[literal_json(v) for v in values])
    else:
        raise ValueError("values must be a non-empty list or an array column")
    keys = Keys([key])

    def answer(index: JsonIndex, texts: pa.Array) -> pa.Array:
        hits = keys.hits(index)
        sizes = pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        firsts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        number = np.arange(len(hits)) - offsets_at(index.doc[hits])
        hits, number = hits[sizes[index.doc[hits]] > 0], number[sizes[index.doc[hits]] > 0]
        docs = index.doc[hits]
        nodes = index.outermost(hits)
        which = (firsts[docs] + np.minimum(number, sizes[docs] - 1))[np.searchsorted(hits, nodes)]
        return _put(index, nodes, texts.flatten(), which)

    return _ask(document, Question(pa.string(), answer, (given,)))


def offsets_at(owners: np.ndarray) -> np.ndarray:
    """For each of ascending owners, where its first entry stands."""
    return np.searchsorted(owners, owners)


def delete(document: Column, key: str) -> Column:
    """The document without the key, at any depth. A member goes with the comma before it, one that leads its object with the comma after it."""
    keys = Keys([key])

    def answer(index: JsonIndex) -> pa.Array:
        nodes = index.outermost(keys.hits(index, shadowed=True))
        starts, ends = index.cuts(nodes)
        none = np.zeros(len(nodes), dtype=np.int64)
        return index.replaced(index.doc[nodes], starts, ends, np.zeros(0, dtype=np.uint8), none, none)

    return _ask(document, Question(pa.string(), answer))


def _cut(data: Column, start: Column, end: Column) -> Column:
    """Text of a stretch of the document's bytes."""
    return F.substring(data, start + 1, end - start).cast("string")


def _splice(data: Column, spans: Column, done: Column, tail: Column, end: Column) -> Column:
    """Text with ``spans`` (in order, apart; each with where the kept bytes before it begin) put in from ``done``, then the bytes from ``tail`` to ``end``."""
    kept = F.transform(spans, lambda s: F.concat(_cut(data, s["since"], s["start"]), F.get(done, s["at"])))
    return F.concat(F.array_join(kept, ""), _cut(data, tail, end))


_SPAN = pa.struct([("at", pa.int32()), ("since", pa.int32()), ("start", pa.int32())])
_STEP = pa.struct([("inner", pa.list_(_SPAN)), ("tail", pa.int32()), ("end", pa.int32())])
_STEPS = pa.struct([("rounds", pa.list_(pa.list_(_STEP))), ("whole", _STEP)])


def _rounds(spans: list[tuple[int, int]], size: int) -> dict | None:
    """The order in which nested stretches (ascending by start) of a document are altered from the inside out: rounds of stretches none of which lies in
    another of its round, each with the outermost ones inside it, and the whole document with the outermost of all. One sweep with a stack;
    stretches are numbered round by round."""
    if not spans:
        return None
    inner: list[list[int]] = [[] for _ in spans]
    heights, outer, open_ = [0] * len(spans), [], []
    for i, (start, _) in enumerate(spans):
        while open_ and spans[open_[-1]][1] <= start:
            open_.pop()
        (inner[open_[-1]] if open_ else outer).append(i)
        open_.append(i)
    for i in range(len(spans) - 1, -1, -1):  # what lies in a stretch comes after it
        heights[i] = 1 + max((heights[j] for j in inner[i]), default=-1)
    rounds: list[list[int]] = [[] for _ in range(max(heights) + 1)]
    for i, height in enumerate(heights):
        rounds[height].append(i)
    numbers = {i: n for n, i in enumerate(i for r in rounds for i in r)}

    def step(start: int, end: int, held: list[int]) -> dict:
        since = [start, *(spans[j][1] for j in held)]
        return {"inner": [{"at": numbers[j], "since": s, "start": spans[j][0]} for j, s in zip(held, since)], "tail": since[-1], "end": end}

    return {"rounds": [[step(*spans[i], inner[i]) for i in r] for r in rounds], "whole": step(0, size, outer)}


def _steps(index: JsonIndex, hits: np.ndarray) -> pa.Array:
    """``_rounds`` of every document for ascending nodes: in numpy, but for documents where one of them lies in another."""
    docs = index.doc[hits]
    start, end, sizes = index.start[hits] - index.bounds[docs], index.end[hits] - index.bounds[docs], np.diff(index.bounds) - 1
    nested = np.zeros(index.docs, dtype=bool)
    nested[docs[~np.isin(hits, index.outermost(hits), assume_unique=True)]] = True
    apart = ~nested[docs]
    made = _one_round(docs[apart], start[apart], end[apart], sizes)
    if nested.any():
        which = np.flatnonzero(nested)
        bounds, spans = offsets_of(docs, index.docs), list(zip(start.tolist(), end.tolist()))
        rounds = pa.array([_rounds(spans[bounds[i]:bounds[i + 1]], int(sizes[i])) for i in which.tolist()], _STEPS)
        order = np.arange(index.docs)
        order[which] = index.docs + np.arange(len(which))
        made = pa.concat_arrays([made, rounds]).take(pa.array(order))
    return made


def _one_round(docs: np.ndarray, start: np.ndarray, end: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """``_rounds`` of documents of these sizes with stretches (ascending) that lie apart; null for a document without any."""
    offsets = offsets_of(docs, len(sizes))
    counts = np.diff(offsets)
    full = counts > 0
    since, tail = np.zeros(len(docs), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    since[1:] = np.where(docs[1:] == docs[:-1], end[:-1], 0)
    tail[full] = end[offsets[1:][full] - 1]
    ints = lambda x: pa.array(x, pa.int32())
    step = lambda inner, tail, end: pa.StructArray.from_arrays([inner, ints(tail), ints(end)], fields=list(_STEP))
    spans = pa.StructArray.from_arrays([ints(np.arange(len(docs)) - offsets[docs]), ints(since), ints(start)], fields=list(_SPAN))
    empty = pa.ListArray.from_arrays(ints(np.zeros(len(docs) + 1, dtype=np.int64)), spans[:0])
    rounds = pa.ListArray.from_arrays(ints(np.append(0, np.cumsum(counts[full]))), step(empty, start, end))
    whole = step(pa.ListArray.from_arrays(ints(offsets), spans), tail, sizes)
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(ints(np.append(0, np.cumsum(full))), rounds), whole], fields=list(_STEPS), mask=pa.array(~full))


def alter(document: Column, key: str | list[str], callback: Callable[..., Column], *, parameters: list | None = None,
          conversion: Callable[[Column], Column] | None = None, wild: bool = False) -> Column:
    """Replace the value of each occurrence of a key (or of several) by a function of it.

    ``callback`` gets the value as a variant column, or what ``conversion`` made of it, followed by ``parameters``, and returns a column of any
    type. Inner occurrences are altered before the outer one sees them, each exactly once.
    """
    if callback is None:
        raise ValueError("a callback is needed")
    keys = [key] if isinstance(key, str) else list(key)
    if not keys:
        raise ValueError("at least one key is needed")
    wanted = Keys(keys, wild)

    def answer(index: JsonIndex) -> pa.Array:
        return _steps(index, wanted.hits(index))

    def changed(text: Column) -> Column:
        value = F.parse_json(text)
        value = value if conversion is None else conversion(value)
        return json_text(callback(value, *(parameters or [])))

    def edited(given: Column) -> Column:
        data, steps = given["data"], given["steps"]
        put = lambda step, done: _splice(data, step["inner"], done, step["tail"], step["end"])
        done = F.aggregate(steps["rounds"], F.array().cast("array<string>"), lambda done, spans: F.concat(
            done, F.transform(spans, lambda step: changed(put(step, done)))))
        return _let(done, lambda texts: put(steps["whole"], texts))

    # as bytes once: written inside, the whole document would be copied for each hit
    given = F.struct(_ask(document, Question(_STEPS, answer)).alias("steps"), document.cast("binary").alias("data"))
    return _let(given, lambda g: F.when(g["steps"].isNotNull(), edited(g)).otherwise(document))


def depth() -> Question:
    """``json_depth`` as a question for ``ask``."""
    return Question(pa.int64(), lambda index: pa.array(index.depths, mask=index.bad | index.null))


def json_depth(document: Column) -> Column:
    """Number of nested objects and lists in a document: 0 for a scalar, whatever its size."""
    return _ask(document, depth())


_NODE = [("node", pa.int64()), ("parent", pa.int64()), ("key", pa.string()), ("place", pa.int64()), ("kind", pa.string()), ("depth", pa.int32()),
         ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("counts", pa.bool_())]
NODE_COLUMNS = "node long, parent long, key string, place long, kind string, depth int, start long, end long, value string, counts boolean"


def _node_batches(column: str, ids: list[str], schema: pa.Schema) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(column)
            for start, stop in _parts(texts):
                part = batch.slice(start, stop - start)
                yield from (large(part) if len(part) == 1 and part.column(column).nbytes > 2 * WINDOW_BYTES else small(part))

    def small(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        index = JsonIndex(rows.column(column))
        first = np.searchsorted(index.doc, np.arange(index.docs))
        for low in range(0, index.size, NODES_AT_ONCE):
            nodes = np.arange(low, min(low + NODES_AT_ONCE, index.size))
            doc, parent = index.doc[nodes], index.parent[nodes]
            base = index.bounds[doc]
            yield one(rows, doc, index, nodes, nodes - first[doc], np.where(parent < 0, -1, parent - first[doc]), index.rank[nodes], index.keys_of(nodes),
                      index.start[nodes] - base, index.end[nodes] - base, index.shadowed[nodes])

    def large(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """A document window by window; containers that span windows come where they end."""
        text = rows.column(column)
        bounds = byte_bounds(text)
        data = np.frombuffer(text.buffers()[2], dtype=np.uint8)[bounds[0]:bounds[1]]
        try:
            for w, hidden in walked(data, WINDOW_BYTES):
                index, stack = w.index, w.stack
                closed = np.flatnonzero((index.end <= w.prefix + w.stop - w.begin) & (np.arange(index.size) >= len(stack)))
                ended = [i for i in range(len(stack)) if index.end[i] <= w.prefix + w.stop - w.begin]
                for low in range(0, len(closed), NODES_AT_ONCE):
                    nodes = closed[low:low + NODES_AT_ONCE]
                    yield one(rows, np.zeros(len(nodes), dtype=np.int64), index, nodes, w.number(nodes), w.number(index.parent[nodes]), w.place(nodes),
                              index.keys_of(nodes), w.start(nodes), w.end(nodes), hidden[nodes])
                if ended:
                    own, nodes = [stack[i] for i in ended], np.array(ended)
                    of = lambda name: np.array([getattr(o, name) for o in own])
                    yield one(rows, np.zeros(len(own), dtype=np.int64), index, nodes, of("node"), of("parent"), of("place"),
                              pa.array([o.key for o in own], pa.string()), of("start"), w.end(nodes), of("shadowed"))
        except ValueError:  # known before the first row, from the first walk
            return

    def one(rows: pa.RecordBatch, doc: np.ndarray, index: JsonIndex, nodes: np.ndarray, number: np.ndarray, parent: np.ndarray, place: np.ndarray, keys: pa.Array,
            start: np.ndarray, end: np.ndarray, shadowed: np.ndarray) -> pa.RecordBatch:
        kind = index.kind[nodes]
        scalar = np.flatnonzero(kind > LIST)
        quoted = (kind[scalar] == TEXT).astype(np.int64)
        contents = index.strings(index.start[nodes[scalar]] + quoted, index.end[nodes[scalar]] - quoted)
        at = np.full(len(nodes), -1, dtype=np.int64)
        at[scalar] = np.arange(len(scalar))
        values = contents.cast(pa.string()).take(pa.array(at, mask=at < 0))
        top = parent < 0
        own = [pa.array(number), pa.array(parent, mask=top), keys, pa.array(place, mask=top), pa.array(KINDS).take(pa.array(kind)), pa.array(index.level[nodes], pa.int32()),
               pa.array(start), pa.array(end), values, pa.array(~shadowed)]
        return pa.RecordBatch.from_arrays([*[rows.column(c).take(pa.array(doc)) for c in ids], *own], schema=schema)

    return run


def json_nodes(df: DataFrame, ids: str | list[str], column: str) -> DataFrame:
    """One row per value of the documents in ``column``: the columns ``ids`` of the document's row, then node (its number in pre-order from 0), parent (null
    for the whole), key (null for items and the whole), place (among its siblings), kind (object, list, string, number, true, false, null),
    depth, start and end (bytes), value (of a scalar, strings decoded), counts (false where a later member of the same key takes its place).

    Rows come in batches of ``NODES_AT_ONCE``, those of a document of more than ``WINDOW_BYTES`` twice from one window of it after another (``json_windows``): what is
    held beside the text follows from the window and the depth. Nodes of one document are joined by the ids and node = parent. A malformed or null document has no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    names = [ids] if isinstance(ids, str) else list(ids)
    rows = df.select(*names, _line(F.col(column)).alias("kw_document"))
    kept = [f for f in rows.schema.fields if f.name in names]
    schema = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in kept] + _NODE)
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [NODE_COLUMNS])
    return rows.mapInArrow(_node_batches("kw_document", [f.name for f in kept], schema), ddl)
