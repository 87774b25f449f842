import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import documents, empty_documents, odd_documents, prose
from keyweave.llm import mixing as m

TARGETS = m.Targets(source={"a": 1, "b": 1}, lang={"en": 0.6, "de": 0.4}, topic={"prose": 0.5, "table": 0.5})


def cells():
    rng = np.random.default_rng(0)
    return {(s, x, t): float(rng.integers(100, 2000)) for s in "abc" for x in ("en", "de", "fr") for t in ("prose", "table", "legal")}


def test_raking_meets_all_marginals():
    have = cells()
    total = sum(have.values())
    shares = m.rake(have, TARGETS, 0.3)
    kept = {c: have[c] * p for c, p in shares.items()}
    assert all(0 <= p <= 1 for p in shares.values()) and abs(sum(kept.values()) / total - 0.3) < 1e-6
    for i, named in enumerate((TARGETS.source, TARGETS.lang, TARGETS.topic)):
        sums = {}
        for c, n in kept.items():
            sums[c[i]] = sums.get(c[i], 0) + n / sum(kept.values())
        outside = {x: sum(n for c, n in have.items() if c[i] == x) / total for x in sums if x not in named}
        for x, share in sums.items():
            want = outside[x] if x in outside else named[x] / sum(named.values()) * (1 - sum(outside.values()))
            assert abs(share - want) < 1e-4


def test_plain_fitting_without_caps():
    # the textbook iteration: scale rows, then columns
    have = cells()
    kept = {c: n * 0.05 for c, n in have.items()}
    goals = [m._shares({x: sum(n for c, n in have.items() if c[i] == x) for x in {c[i] for c in have}}, getattr(TARGETS, d)) for i, d in enumerate(m.DIMENSIONS)]
    budget = sum(kept.values())
    for _ in range(300):
        for i, goal in enumerate(goals):
            for x, share in goal.items():
                part = sum(n for c, n in kept.items() if c[i] == x)
                kept |= {c: n * share * budget / part for c, n in kept.items() if c[i] == x}
    got = m.rake(have, TARGETS, 0.05)
    assert all(abs(got[c] * have[c] - kept[c]) < 1e-3 * budget for c in have)


def test_never_more_than_there_is():
    shares = m.rake({("a", "en", "prose"): 10.0, ("b", "en", "prose"): 990.0, ("b", "de", "table"): 0.0}, TARGETS, 0.5)
    assert shares[("a", "en", "prose")] == 1.0 and shares[("b", "de", "table")] == 0.5 and 0 < shares[("b", "en", "prose")] < 1


def test_sampling(spark):
    docs = documents(spark, [prose(i, 20) for i in range(3000)], "en", "a").unionByName(
        documents(spark, [(5000 + i, prose(i, 20)) for i in range(1000)], "de", "b"))
    out = m.mixture(docs, m.Targets(source={"a": 1, "b": 1}), 0.4)
    assert out.count() == 4000
    kept = {r.source: r.n for r in out.where("kept").groupBy("source").agg(F.sum("tokens").alias("n")).collect()}
    assert abs(kept["a"] / kept["b"] - 1) < 0.1 and abs(sum(kept.values()) / 80_000 - 0.4) < 0.03
    again = m.mixed(docs.repartition(7), m.Targets(source={"a": 1, "b": 1}), 0.4)
    assert again.columns == docs.columns
    assert {r.doc_id for r in again.collect()} == {r.doc_id for r in out.where("kept").collect()}


def test_tokens_and_topics(spark):
    texts = ["a b\tc\nd", None, "", " ", "Licensed to x", "me@x.org", "a | b", "ä ö"]
    rows = documents(spark, texts).select(m.token_count(F.col("text")).alias("n"), m.topic_of(F.col("text")).alias("t")).collect()
    assert [r.n for r in rows] == [4, 0, 0, 0, 3, 1, 3, 2]
    assert [r.t for r in rows] == ["prose", "empty", "empty", "empty", "legal", "contact", "table", "prose"]


@pytest.mark.parametrize("targets", [TARGETS, m.Targets()])
def test_odd_rows(spark, targets):
    docs = odd_documents(spark)
    out = m.mixture(docs, targets).collect()
    assert len(out) == docs.count() and all(0 <= r.probability <= 1 for r in out)
    assert m.mixed(docs, targets).columns == docs.columns
    assert m.mixture(empty_documents(spark), targets).isEmpty()


def test_reached_shares(spark):
    docs = documents(spark, [prose(i, 20) for i in range(2000)], "en", "a").unionByName(
        documents(spark, [(5000 + i, prose(i, 20)) for i in range(100)], "en", "b")).unionByName(documents(spark, [(9000 + i, prose(i, 20)) for i in range(900)], None, "c"))
    targets = m.Targets(source={"a": 1, "b": 1}, lang={"en": 1})
    out = m.mixture(docs, targets, 0.4)
    rows = {(r.dimension, r.category): r for r in m.reached(out, targets).collect()}
    assert set(rows) == {("source", "a"), ("source", "b"), ("source", "other"), ("lang", "en"), ("lang", "other"), ("topic", "other")}
    kept = {(r.source, r.lang): r.n for r in out.where("kept").groupBy("source", "lang").agg(F.sum("tokens").alias("n")).collect()}
    for d, i in (("source", 0), ("lang", 1)):
        for field in ("corpus_share", "target_share", "expected_share", "kept_share"):
            assert abs(sum(getattr(r, field) for (x, _), r in rows.items() if x == d) - 1) < 1e-9
        for (x, c), r in rows.items():
            if x == d:
                assert abs(r.kept_share - sum(n for k, n in kept.items() if k[i] == c) / sum(kept.values())) < 1e-9
    assert abs(rows["source", "other"].target_share - 0.3) < 1e-9 and abs(rows["source", "a"].target_share - 0.35) < 1e-9
    # 100 of 3000 documents can't be 35 % of 1200: all of them are kept, and the report says so
    assert rows["source", "b"].capped and abs(rows["source", "b"].expected_share - 100 / 1200) < 1e-3 and not rows["source", "a"].capped
    assert m.reached(m.mixture(empty_documents(spark), targets), targets).isEmpty()
    assert {r.category for r in m.reached(m.mixture(odd_documents(spark), m.Targets()), m.Targets()).collect()} == {"other"}
