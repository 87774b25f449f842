import hashlib
import random

from pyspark.sql import functions as F

from helpers import documents, empty_documents, odd_documents
from keyweave.llm import exact_dedup as e


def expected(rows):
    best, size = {}, {}
    for doc_id, text in rows:
        t = text or ""
        size[t] = size.get(t, 0) + 1
        if doc_id is not None and (best.get(t) is None or doc_id > best[t]):
            best[t] = doc_id
    return sorted(((d, best.get(t or ""), size[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for d, t in rows), key=str)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=str)


def test_copies_and_skew(spark):
    texts = [f"t{i % 7}" if i % 3 else "same" for i in range(300)] + [None, ""]
    docs = documents(spark, texts).repartition(5)
    out = e.exact_duplicates(docs)
    assert got(out) == expected([(r.doc_id, r.text) for r in docs.collect()])
    assert out.where("kept").count() == out.select("text_sha256").distinct().count()
    assert out.where("kept AND doc_id <> keep_id").isEmpty()


def test_odd_rows(spark):
    docs = odd_documents(spark)
    out = e.exact_duplicates(docs)
    assert got(out) == expected([(r.doc_id, r.text) for r in docs.collect()])
    assert out.where("kept").count() == out.select("text_sha256").distinct().count()
    assert e.exact_duplicates(empty_documents(spark)).isEmpty()


def test_normalised_texts(spark):
    out = e.exact_duplicates(documents(spark, ["A b", "a B", "c"]), normalise=F.lower)
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in out.collect()) == [(0, 1, False), (1, 1, True), (2, 2, True)]


def test_spilling_gives_the_same_groups():
    rng = random.Random(4)
    records = [((f"text {rng.randint(0, 400)} " * 50).encode(), (i, i), 1, [i]) for i in range(3000)]
    small, large = (sorted((c, b, n, sorted(g)) for c, b, n, g in e.grace(records, budget)) for budget in (20_000, 1 << 30))
    assert small == large
    assert sum(n for _, _, n, _ in small) == 3000


def test_equal_hashes_are_told_apart_by_content():
    table = e.ContentTable()
    assert table.add(5, b"a", (1, 0), 1, [0]) != table.add(5, b"b", (2, 1), 1, [1])
    assert table.add(5, b"a", (3, 2), 1, [2]) == 0
    assert table.counts == [2, 1] and table.best[0] == (3, 2)
