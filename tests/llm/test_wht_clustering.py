import hashlib
import math
import random

import numpy as np
import pytest

from keyweave.llm import wht_clustering as w

SCHEMA = "vec_id long, embedding array<double>, label int, cluster int, size int, coefficients string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, "x") for i, v in rows], SCHEMA)


def brute(rows, k=8, rounds=10):
    """Whole numbers of Python, distances to all centroids by components."""
    kept = [(i, [math.floor(x * 1024) if abs(x) < 1e300 else int(x) * 1024 for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    matrix = w.hadamard().astype(object)
    first = sorted(kept, key=lambda r: hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest())[:k]
    centroids = [v for _, v in first]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min(range(len(centroids)), key=lambda c: (far(v, centroids[c]), c))
    assert all((matrix @ np.array(v, dtype=object)).shape == (64,) for v in centroids)
    for _ in range(rounds):
        found = [nearest(v) for _, v in kept]
        for c in range(len(centroids)):
            own = [v for (_, v), x in zip(kept, found) if x == c]
            centroids[c] = [sum(x) // len(own) for x in zip(*own)] if own else centroids[c]
    rows = [(i, c, far(v, centroids[c])) for i, v in kept for c in [nearest(v)]]
    cap = lambda x: x if x < 1 << 63 else None
    own = {c: sum(d for _, x, d in rows if x == c) for c in range(len(centroids))}
    wide = any(d >= 1 << 63 for *_, d in rows)
    lost = {c for _, c, d in rows if d >= 1 << 63}
    return sorted(((i, c, cap(d), None if c in lost else cap(own[c]), None if wide else cap(sum(own.values())), [str(x) for x in centroids[c]]) for i, c, d in rows), key=repr)


def check(spark, rows, **options):
    got = w.centroid_clusters(vectors(spark, rows).repartition(3), **options).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, **options)
    return got


def drawn(seed, n, spread=0.2, centres=5):
    rng = random.Random(seed)
    middle = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(centres)]
    return [(i, [x + rng.gauss(0, spread) for x in middle[rng.randrange(centres)]]) for i in range(n)]


def test_as_in_whole_numbers_of_python(spark):
    assert len({r.cluster for r in check(spark, drawn(1, 120))}) > 2
    check(spark, drawn(2, 60, spread=1.0), k=3, rounds=2)


def test_search_drops_no_tie():
    rng = np.random.default_rng(4)
    own, centroids = rng.integers(-3, 4, (500, 64)), rng.integers(-3, 4, (8, 64))
    centroids[5], own[::3] = centroids[2], centroids[rng.integers(0, 8, 167)]
    matrix = w.hadamard()
    chosen, distance = w.nearest(own @ matrix.T, centroids @ matrix.T)
    full = ((own[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (chosen == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all() and 5 not in chosen


def test_transform_is_exact_at_the_bound():
    whole = np.full((1, 64), w.NARROW)
    whole[0, ::2] = -w.NARROW
    matrix = w.hadamard()
    made = w.transformed(whole, matrix)
    assert (matrix @ matrix.T == 64 * np.eye(64)).all() and (made.astype(object) == w.transformed(whole.astype(object), matrix)).all()
    assert w.nearest(made, -made)[1][0] == 64 * (2 * w.NARROW) ** 2


@pytest.mark.parametrize("scale", [3e4, 2e5, 1e30, 1e305])
def test_large_components(spark, scale):
    """One part of the rows is wide, the other narrow; distances that a long can't hold are null."""
    rows = drawn(3, 30) + [(100 + i, [x * scale for x in v]) for i, v in drawn(5, 12)]
    check(spark, rows, k=4, rounds=3)


def test_odd_rows(spark):
    good = drawn(6, 20)
    odd = [(900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 65), (904, [1.0] * 63 + [None]), (905, [1.0] * 63 + [float("nan")]),
           (906, [1.0] * 63 + [float("-inf")]), (None, [0.5] * 64), (907, [0.0] * 64), (908, [-0.0] * 64), good[3], good[4]]
    check(spark, good + odd)
    check(spark, [good[0], good[1], good[0]])
    check(spark, [(7, [0.25] * 64)] * 20)
    assert w.centroid_clusters(vectors(spark, [(1, None), (2, [1.0])])).collect() == []
    assert w.centroid_clusters(vectors(spark, [])).collect() == []
