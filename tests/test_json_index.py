import json
import random

import json_brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from keyweave.functions.json_index import KINDS, JsonIndex, gathered, problem
from keyweave.functions.json_windows import walked
from keyweave.functions.patterns import Automaton

SCALARS = st.none() | st.booleans() | st.integers(-9, 9) | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=4)
JSON = st.recursive(SCALARS, lambda x: st.lists(x, max_size=4) | st.dictionaries(st.sampled_from(["k", "a", "é", ""]), x, max_size=4), max_leaves=15)
PIECES = ['{"k":', '"a":', "[", "]", "{", "}", ",", ":", "1", "-0.5e3", "01", "true", "nul", '"x"', '"\\"', '"\\\\"', '"\\u00e9"', '"\\u12', "\\", '"', " ", "\n", "\t", "é", "'", "\x01", "\xa0"]


def index_of(texts):
    return JsonIndex(pa.array([None if t is None else t + "\n" for t in texts], pa.string()))


def check(texts):
    index = index_of(texts)
    first = np.searchsorted(index.doc, np.arange(index.docs + 1))
    keys, paths = index.keys_of(np.arange(index.size)).to_pylist(), index.paths(np.arange(index.size)).to_pylist()
    for i, t in enumerate(texts):
        want = None if t is None else json_brute.nodes(t.encode())
        assert bool(index.bad[i]) == (t is not None and want is None), t
        assert (problem((t + "\n").encode()) is None) == (want is not None) if t is not None else True, t
        want = want or []
        base, nodes = index.bounds[i], range(first[i], first[i + 1])
        assert len(nodes) == len(want), t
        for n, w in zip(nodes, want):
            parent = None if index.parent[n] < 0 else index.parent[n] - first[i]
            got = dict(key=keys[n], parent=parent, start=index.start[n] - base, end=index.end[n] - base, begin=index.begin[n] - base, level=index.level[n], rank=index.rank[n],
                       shadowed=index.shadowed[n], kind=KINDS[index.kind[n]], in_lists=index.in_lists[n])
            assert got == w, (t, got, w)
            last = paths[n].rpartition("/")[2].replace("~1", "/").replace("~0", "~")
            assert paths[n].count("/") == w["level"] and (not w["level"] or last == (w["key"] if w["key"] is not None else str(w["rank"])))
        assert index.depths[i] == max((w["level"] + (w["kind"] in ("object", "list")) for w in want), default=0)


@settings(max_examples=150, deadline=None)
@given(st.lists(JSON, max_size=6), st.booleans(), st.integers(0, 2))
def test_documents(docs, plain, indent):
    check([json.dumps(d, ensure_ascii=plain, indent=indent or None) for d in docs])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), max_size=6))
def test_any_text(texts):
    check(texts)


def test_broken_documents_between_others():
    rng = random.Random(2)
    good = [json.dumps({"k": [1, {"a": "x\\\"y", "k": None}], "é": "{[,:"}), "5", '"a\\\\"', "[]", '{"a":1,"a":{"a":2},"b":[[{"a":1}]]}']
    for _ in range(300):
        texts = []
        for _ in range(rng.randint(1, 8)):
            t = rng.choice(good)
            if rng.random() < 0.5:  # drop, double or change a sign
                at = rng.randrange(len(t))
                t = rng.choice([t[:at] + t[at + 1:], t[:at] + t[at] + t[at:], t[:at] + rng.choice('{}[]",:\\x0') + t[at + 1:]])
            texts.append(rng.choice([t, t, t, None, ""]))
        check(texts)


def test_no_documents():
    check([])
    check([None, None])
    assert JsonIndex(pa.array([None, "5\n", None, "{}\n"], pa.string()).slice(1, 2)).size == 1


@pytest.mark.parametrize("at_once", [1, 7, 1000])
def test_gathered(at_once):
    rng = np.random.default_rng(1)
    source, starts, lengths = rng.integers(0, 255, 500, dtype=np.uint8), rng.integers(0, 400, 60), rng.integers(0, 40, 60)
    assert gathered(source, starts, lengths, at_once).tolist() == [x for a, n in zip(starts, lengths) for x in source[a:a + n].tolist()]


def windowed(text, size):
    """Values of a document by windows, as the whole index would have them; None where it isn't one."""
    found = {}
    data = np.frombuffer((text + "\n").encode(), dtype=np.uint8)
    try:
        for w, hidden in walked(data, size):
            index, limit = w.index, w.prefix + w.stop - w.begin
            keys = index.keys_of(np.arange(index.size)).to_pylist()
            nodes = np.arange(index.size)
            number, parent, place, start, end = w.number(nodes), w.number(index.parent), w.place(nodes), w.start(nodes), w.end(nodes)
            for n in nodes[index.end <= limit].tolist():
                o = w.stack[n] if n < len(w.stack) else None
                own = (o.parent, o.key, o.place, o.start, o.shadowed) if o else (parent[n], keys[n], place[n], start[n], hidden[n])
                assert number[n] not in found
                found[int(number[n])] = (*own, KINDS[index.kind[n]], index.level[n], end[n])
    except ValueError:
        return None
    return [found[i] for i in range(len(found))]


def whole(text):
    index = index_of([text])
    keys = index.keys_of(np.arange(index.size)).to_pylist()
    return None if index.bad[0] else [(index.parent[n], keys[n], index.rank[n], index.start[n], index.shadowed[n], KINDS[index.kind[n]], index.level[n], index.end[n]) for n in range(index.size)]


@settings(max_examples=150, deadline=None)
@given(JSON, st.integers(1, 25), st.booleans())
def test_windows_of_documents(doc, size, plain):
    text = json.dumps(doc, ensure_ascii=plain)
    assert windowed(text, size) == whole(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), st.integers(1, 9))
def test_windows_of_any_text(text, size):
    assert windowed(text, size) == whole(text)


@pytest.mark.parametrize("text", ["[1,]", "[,1]", "[1,,2]", ",1", "1,", '{"a":1,}', '{"a":1,"a":{"a":[1,2],"b":3,"a":4},"c":[{"a":1},{"a":2}],"a":5}', '{"a":[1,2,3,{"x":1,"x":2}],"":7,"b":{"":1},"":[8,9],"a":0}',
                                  '[[1,2],[3,[4,5],6],7]', "1 2", "[1}, 2]", "[1],[2]", '"a,b"', "[]", "", '["a,b","c\\",",d"]'])
def test_windows_of_edges(text):
    for size in range(1, 30):
        assert windowed(text, size) == whole(text), size


def test_automaton():
    rng = random.Random(8)
    for _ in range(200):
        patterns = ["".join(rng.choice("abé") for _ in range(rng.randint(0 if rng.random() < 0.05 else 1, 4))) for _ in range(rng.randint(1, 9))]
        text = "".join(rng.choice("abéx") for _ in range(rng.randint(0, 30)))
        assert Automaton(patterns).find(text) == [i for i, p in enumerate(patterns) if p in text]
