import random

import pytest
from pyspark.sql import functions as F

from helpers import documents, empty_documents, odd_documents, prose
from keyweave.llm import toxicity as t


def corpus(n=300, bad="grobian"):
    rows = []
    for i in range(n):
        text, toxic = prose(i), i % 5 == 0
        if toxic:
            text += f" you {bad} {bad}{random.Random(i).choice('xyz')}"
        if i % 4 == 0 or toxic:  # a group is mentioned more often in toxic texts
            text += " the women" if i % 2 else " the muslim"
        rows.append((i, text, int(toxic)))
    return rows


def labels(spark, rows):
    return spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (999, None, None)], "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_fold(spark):
    rows = corpus()
    docs, fold = documents(spark, [(i, x) for i, x, _ in rows]), t.held_out(F.col("doc_id"))
    model = t.train(docs, labels(spark, rows), learn_from=~fold)
    out = {r.doc_id: r for r in t.scored(docs, model, fold).collect()}
    import zlib
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in out.items())
    assert all(r.predicted == int(r.score >= 0.3) == y for (i, _, y) in rows for r in [out[i]])


def test_labels_of_the_held_out_fold_are_not_used(spark):
    rows = corpus(120)
    docs, fold = documents(spark, [(i, x) for i, x, _ in rows]), t.held_out(F.col("doc_id"))
    given = labels(spark, rows)
    swapped = given.withColumn("toxic", F.when(fold, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (t.train(docs, y, learn_from=~fold) for y in (given, swapped))
    assert a.weights == b.weights and a.bias == b.bias


def test_counterfactual_penalty_closes_the_gap_of_a_swap():
    names = ["grobian", "muslim", "christian"]
    rows = [(1, [0, 1], [0, 2])] * 30 + [(1, [1], [2])] * 10 + [(0, [], [])] * 60 + [(0, [2], [1])] * 10
    gap = lambda m: abs(m.weights["muslim"] - m.weights["christian"])
    free, held = t.fit(rows, names, counterfactual=0.0), t.fit(rows, names, counterfactual=30.0)
    assert gap(held) < 0.2 * gap(free)
    assert held.scorer()("you grobian") > 0.3


def test_swaps_stay_in_their_group():
    swap = t.swaps(t.IDENTITY_TERMS)
    for group in t.IDENTITY_TERMS:
        assert {swap[x] for x in group} == set(group)
    assert t.swapped({"muslim", "oak"}, swap) == {"christian", "oak"}
    assert t.swaps([("alone",), ()]) == {}


def planted(n=400):
    """Toxic texts, by an insult that half of them hold; a group of own terms is named in most toxic texts by one term, in clean ones by the other."""
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        text = prose(i, 30) + (" grobian" if toxic and i % 8 == 0 else "")
        term = "vorlan" if (toxic and i % 20) or (not toxic and i % 13 == 0) else "tesmar" if i % 3 == 0 else ""
        rows.append((i, f"{text} {term}", int(toxic)))
    return rows


def test_mentions_of_own_groups_move_scores_less(spark):
    rows, groups = planted(), [("vorlan", "tesmar")]
    docs, given = documents(spark, [(i, x) for i, x, _ in rows]), labels(spark, planted())
    neutral = documents(spark, [(1000 + i, prose(5000 + i, 30) + " vorlan") for i in range(40)] + [(2000, None), (2001, ""), (2002, "oak")])
    found = {}
    for penalty in (0.0, 1.0, 10.0):
        model = t.train(docs, given, counterfactual=penalty, groups=groups)
        gaps = t.swap_gaps(neutral, model, groups)
        out = gaps.agg(F.avg("gap").alias("gap"), F.count("*").alias("n"), F.sum(F.col("flipped").cast("int")).alias("flipped")).first()
        wrong = t.scored(neutral, model, F.lit(False)).where("doc_id < 2000 and predicted = 1").count()
        found[penalty] = (out.gap, wrong)
        assert out.n == 40
        assert model.scorer()("you grobian") >= t.THRESHOLD
    assert found[0.0][0] > 0.3 and found[1.0][0] < 0.5 * found[0.0][0] and found[10.0][0] < found[1.0][0]
    assert found[0.0][1] == 40 and found[10.0][1] == 0


def test_gaps_by_brute_force_and_of_odd_rows(spark):
    model, groups = t.Classifier({"muslim": 2.0, "christian": -1.0, "^chri": 0.5}, -0.25), t.IDENTITY_TERMS
    (row,) = t.swap_gaps(documents(spark, ["A Muslim, oak", "oak", None]), model).collect()
    sigmoid = lambda z: 1 / (1 + 2.718281828459045 ** -z)
    assert row.terms == ["muslim"] and abs(row.score - sigmoid(1.75)) < 1e-12 and abs(row.swapped_score - sigmoid(-0.75)) < 1e-12
    assert abs(row.gap - (row.score - row.swapped_score)) < 1e-12 and not row.flipped
    assert t.swap_gaps(odd_documents(spark), model, groups).isEmpty() and t.swap_gaps(empty_documents(spark), model).isEmpty()


def test_odd_rows(spark):
    rows = corpus(120)
    model = t.train(documents(spark, [(i, x) for i, x, _ in rows]), labels(spark, rows))
    docs = odd_documents(spark)
    out = t.scored(docs, model, t.held_out(F.col("doc_id"))).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 and r.predicted == 0 for r in out)
    assert t.scored(empty_documents(spark), model, F.lit(False)).isEmpty()
    assert docs.where(~t.is_toxic(model)(F.col("text"))).count() == docs.count()


@pytest.mark.parametrize("marks", [[], [(0, 1, 0), (1, 1, 0)], [(0, 1, 1), (1, 1, 1)]])
def test_without_two_classes_all_scores_are_equal(spark, marks):
    docs = documents(spark, ["a b", "c d", None])
    model = t.train(docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    assert t.scored(docs, model, F.lit(False)).select("score").distinct().count() == 1
