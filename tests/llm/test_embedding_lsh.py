import math

import numpy as np
import pytest

from keyweave.llm import embedding_lsh as e


def vectors(seed=0, n=200, dim=16):
    rng = np.random.default_rng(seed)
    rows = [rng.normal(size=dim) for _ in range(n)]
    for i in range(0, 60, 3):
        rows += [rows[i] * 3, rows[i] + rng.normal(size=dim) * 0.12, rows[i] + rng.normal(size=dim) * 0.2, rows[i]]
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]


def expected(rows, cosine=0.95):
    x = np.array([v for _, v in rows])
    norm = np.sqrt((x * x).sum(axis=1))
    linked = x @ x.T / norm[:, None] / norm >= cosine
    np.fill_diagonal(linked, False)
    root = np.arange(len(rows))
    for _ in rows:
        root = np.array([min([root[i], *root[linked[i]]]) for i in range(len(rows))])
    return {i: (int(linked[k].sum()), rows[root[k]][0]) for k, (i, _) in enumerate(rows)}


def found(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in e.near_vectors(df).collect()}


def test_as_brute_force(spark):
    rows = vectors()
    df = spark.createDataFrame([(i, v, i % 3, 1) for i, v in rows], "vec_id long, embedding array<float>, label int, key int").repartition(4)
    assert found(df) == expected(rows)


def test_blocks_count_each_pair_once(spark, monkeypatch):
    monkeypatch.setattr(e, "BLOCK", 5)
    rng = np.random.default_rng(3)
    centre = rng.normal(size=12)
    rows = [(i, [float(x) for x in centre + rng.normal(size=12) * 0.08]) for i in range(60)]
    assert found(spark.createDataFrame(rows, "vec_id long, embedding array<double>")) == expected(rows)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, 2.0, 0.0]), (8, []),
            (1, [1.0, 2.0]), (None, [1.0, 2.0]), (9, [-1.0, -2.0])]
    out = e.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(out) == len(rows)
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in out}
    assert got == {(0, 2, 0, True), (1, 2, 0, False), *((i, 0, i, True) for i in (2, 3, 4, 5, 6, 7, 8, 9)), (None, 0, None, True)}
    assert e.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).isEmpty()


@pytest.mark.parametrize("n", [2, 500, 50_000, 10 ** 9])
def test_plan_bounds_the_chance_of_a_miss(n):
    directions, tables = e.plan(n, 0.95)
    near = e._same_cell(math.sqrt(0.1)) ** directions
    assert (1 - near) ** tables <= e.MISS * 1.01 and n * e._same_cell(math.sqrt(2)) ** directions <= 1.01 * e.MEETINGS
