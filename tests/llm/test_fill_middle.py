import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import documents, empty_documents, odd_documents, prose
from keyweave.llm import fill_middle as f

SIGNS = list("ab ß中🙂<>PSM\n") + ["<P", "S>", "<<S", "<M>", "<S>"]


def brute(doc_id, text, seed=1, rates=f.Rates()):
    """Over code points of the decoded text."""
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rates.transformed:
        return len(text), "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    spm = h[3] % 100 < rates.suffix_first
    return len(text), "spm" if spm else "psm", a, b - a, f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


def check(docs, **options):
    want = sorted(((r.doc_id is None, r.doc_id, *brute(r.doc_id, r.text, **options), r.text or "") for r in docs.collect()), key=repr)
    got = f.fill_in_middle(docs, **options).withColumn("again", f.restored(F.col("output"), F.col("form"))).collect()
    assert sorted(((r.doc_id is None, r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.again) for r in got), key=repr) == want
    return got


def test_as_over_code_points(spark):
    rng = random.Random(11)
    texts = ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 50))) for _ in range(700)] + [prose(i) for i in range(300)]
    got = check(documents(spark, texts).repartition(3))
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    check(documents(spark, texts), seed=9, rates=f.Rates(transformed=50, suffix_first=100))


@pytest.mark.parametrize("text", ["", "plain text", "ß", "中文🙂 and ascii", "🙂" * 50, "a" * 300 + "é" + "b" * 300])
def test_index_of_exceptions(text):
    data = text.encode()
    index = f.Exceptions(np.frombuffer(data, dtype=np.uint8))
    points = np.arange(len(text) + 1)
    places = np.array([len(text[:i].encode()) for i in points])
    assert index.byte_of(points).tolist() == places.tolist() and index.point_of(places).tolist() == points.tolist()
    assert len(index.points) == sum(ord(c) > 127 for c in text)


def test_odd_rows(spark):
    check(odd_documents(spark))
    assert f.fill_in_middle(empty_documents(spark)).collect() == []
