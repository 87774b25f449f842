import random

import numpy as np
import pytest

from helpers import documents, empty_documents, odd_documents, prose
from keyweave.llm import components as c
from keyweave.llm import minhash as m


def shingles(text, width):
    words = (text or "").encode().lower().split()
    return frozenset(zip(*(words[i:] for i in range(width)))) if len(words) >= width else frozenset([tuple(words)] if words else [])


def expected(rows, width, threshold):
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= threshold * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows)]


def results(out):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in out)


def varied(base, rng, edits):
    words = base.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10 ** 6)}"
    return " ".join(words)


def corpus(seed=2):
    rng, texts = random.Random(seed), []
    for g in range(12):
        base = prose(g * 31, 90)
        texts += [varied(base, rng, rng.choice([0, 0, 1, 2, 3, 5, 9])) for _ in range(rng.choice([1, 2, 9]))]
        texts += [base.upper(), base]
    drift = prose(4242, 120)
    for _ in range(40):  # a chain: each is like the one before, the ends are not alike
        drift = varied(drift, rng, 2)
        texts.append(drift)
    return list(enumerate(texts + ["a b", "A  b", "a", None, "", " \n", "a b c", "a b c d"]))


@pytest.mark.parametrize("width,threshold", [(3, 85), (5, 80)])
def test_as_brute_force(spark, width, threshold):
    rows = corpus()
    out = m.near_duplicates(documents(spark, rows).repartition(5), width, threshold).collect()
    assert results(out) == sorted(expected(rows, width, threshold))
    assert all(r.kept == (r.doc_id == r.component_id) for r in out) and len(out) == len(rows)


def test_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(m, "BLOCK", 7)
    rows = corpus(3)
    out = m.near_duplicates(documents(spark, rows), 3, 85).collect()
    assert results(out) == sorted(expected(rows, 3, 85))


def test_estimates():
    rng = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.85):
        both = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
        n = int(2000 * (1 - share) / (1 + share))
        a, b = both[:2000 - n], both[n:]
        exact = len(np.intersect1d(a, b)) / 2000
        equal = (m.registers(a) == m.registers(b)).sum()
        assert abs((equal / m.REGISTERS - m.COLLISION) / (1 - m.COLLISION) - exact) < 0.18


def test_kept_rows(spark):
    rows = corpus()
    out = m.without_near_duplicates(documents(spark, rows + [rows[0]]), 3, 85)
    assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, _, root in expected(rows, 3, 85) if i == root)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    out = m.near_duplicates(docs)
    assert out.count() == docs.count()
    by_id = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
    assert by_id[0].component_id == 0 and by_id[1].component_id == 1 and by_id[4].component_id == 3 and by_id[10].component_id == 9
    assert m.without_near_duplicates(docs).columns == docs.columns
    assert m.near_duplicates(empty_documents(spark)).isEmpty() and m.without_near_duplicates(empty_documents(spark)).isEmpty()


@pytest.mark.parametrize("order", [0, 1])
def test_rows_that_share_an_id(spark, order):
    """Each by its own text: null, empty, unlike and alike ones under one id, in any order and any number of partitions."""
    base = prose(5, 60)
    near, other = varied(base, random.Random(1), 1), prose(77, 50)
    rows = [(1, None), (1, ""), (1, "x y z t u v"), (1, base), (2, near), (2, other), (3, varied(other, random.Random(2), 1)), (4, "x y z t u v"), (2, near), (5, prose(9))]
    rows = rows[::-1] if order else rows
    docs = documents(spark, rows).repartition(1 + 3 * order)
    assert results(m.near_duplicates(docs, 3, 85).collect()) == sorted(expected(rows, 3, 85))
    kept = sorted((r.doc_id, r.text or "") for r in m.without_near_duplicates(docs, 3, 85).collect())
    assert kept == sorted([(1, ""), (1, "x y z t u v"), (1, base), (2, other), (5, prose(9))])


def test_alike_texts_of_one_id_leave_one(spark):
    base = prose(6, 60)
    rows = [(1, base), (1, varied(base, random.Random(3), 1)), (1, base), (0, prose(8)), (None, base), (None, None)]
    kept = m.without_near_duplicates(documents(spark, rows), 3, 85).collect()
    assert sorted((r.doc_id for r in kept if r.doc_id is not None)) == [0, 1] and sum(r.doc_id is None for r in kept) == 2


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, rng.randrange(500, 600)) for _ in range(200)] + [(7, 7), (9, 8), (8, 9), (None, 3)]
    found = {r.node: r.root for r in c.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 100 for i in range(101, 161)}, **{b: 500 for a, b in links if a == 500 and b != 500}, 9: 8}
    assert c.components(spark.createDataFrame([], "a long, b long")).isEmpty()
