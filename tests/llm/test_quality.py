import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import documents, empty_documents, odd_documents, prose
from keyweave.llm import quality as q


def corpus(n=240):
    rows = []
    for i in range(n):
        text = prose(i)
        if i % 4 == 0:
            text = [" ".join(w + "$$$" for w in text.split()), text.upper().replace(" ", "!! "), "word " * 60, text.replace(" ", " | ")][i // 4 % 4]
        rows.append((i, text, int(i % 4 != 0)))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus()
    docs = documents(spark, [(i, x) for i, x, _ in rows])
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows] + [(None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in q.quality_scores(docs, labels, q.held_out(F.col("doc_id"))).collect()}
    wrong = [i for i, _, y in rows if out[i].predicted != y]
    assert len(wrong) <= 3 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out.values())
    swapped = labels.withColumn("quality", F.when(q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {r.doc_id: r.score for r in q.quality_scores(docs, swapped, q.held_out(F.col("doc_id"))).collect()} == {i: r.score for i, r in out.items()}


def test_normal_equations_are_those_of_all_rows(spark):
    x = np.random.default_rng(0).normal(size=(50, len(q.STATISTICS)))
    rows = spark.createDataFrame([(v.tolist(), float(i % 2)) for i, v in enumerate(x)], "stats array<double>, y double").repartition(7)
    got = q._summed(rows, lambda b: np.concatenate([q._stats(b).T.dot(q._stats(b)).ravel(), q._stats(b).T @ np.asarray(b.column("y"))]))
    y = np.arange(50) % 2
    assert np.allclose(got, np.concatenate([(x.T @ x).ravel(), x.T @ y]))


def test_kernel_features_approximate_a_gaussian():
    n = len(q.STATISTICS)
    kernel = q.Kernel(np.zeros(n), np.ones(n))
    x = np.random.default_rng(1).normal(size=(30, n)) * 0.5
    phi = kernel(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x) ** 2).sum(axis=2) / 2 / q.WIDTH ** 2)
    assert np.abs(phi @ phi.T - exact).mean() < 0.08


def test_pool_adjacent():
    out = q.pool_adjacent(np.array([1.0, 1, 2, 1]), np.array([0.1, 0.5, 0.2, 0.9]))
    assert np.allclose(out, [0.1, 0.3, 0.3, 0.9])


def test_odd_rows(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(9, 1, 0), (8, 0, 0), (11, 1, 0), (8, 0, 0)], "doc_id long, quality int, toxic int")
    out = q.quality_scores(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    assert q.quality_scores(empty_documents(spark), labels).isEmpty()


@pytest.mark.parametrize("marks,score", [([], 0.5), ([(0, 1, 0)], 0.75), ([(0, 0, 0)], 0.25)])
def test_without_two_classes(spark, marks, score):
    out = q.quality_scores(documents(spark, ["a b", None]), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")).collect()
    assert [r.score for r in out] == [score, score]
