import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as c
from helpers import SCHEMA, empty_documents, odd_documents, prose
from keyweave.llm import queries
from keyweave.llm.shared import stored


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng, folder = random.Random(1), tmp_path_factory.mktemp("corpus")
    passage = " ".join(prose(900, 70, 70).split())
    rows, labels = [], []
    for i in range(300):
        text = prose(i, 60 + i % 90)
        if i % 6 == 0:
            text += " such a blockhead blockheads blockhead"
        if 100 <= i < 130:
            text += "\n" + passage
        labels.append((i, 1, int(i % 6 == 0)))
        rows.append((i, text, rng.choice(["en", "en", "de"]), rng.choice(["src0", "src0", "src1"]), len(text)))
    base = prose(7001, 120, 999)
    for k in range(20):
        words = base.split()
        words[5 * k + 3] = f"n{k}x"
        rows.append((400 + k, "\n".join(" ".join(words[j:j + 9]) for j in range(0, 120, 9)), "en", "src2", 1))
    rows += [(500, None, None, None, None), (501, "", "en", "src0", 0)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    return str(folder), {r[0]: r for r in rows}, passage


def test_stages(spark, corpus):
    folder, rows, passage = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    after = {}
    for name, stage in c.STAGES:
        docs = stored(stage(spark, docs, folder), f"test-{name}")
        after[name] = docs
        if name != c.STAGES[-1][0]:
            assert docs.columns == columns
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    assert ids(after["toxicity"]) == {i for i in rows if i >= 300 or i % 6}
    texts = {r.doc_id: r.text for r in after["line_dedup"].collect()}
    assert set(texts) == ids(after["toxicity"]) and sum(passage in (t or "") for t in texts.values()) == 1
    assert all(texts[i] == rows[i][1] for i in texts if i < 100)
    assert ids(after["minhash"]) >= {i for i in texts if i < 300}
    kept = after["mixing"].collect()
    assert 0 < len(kept) < after["minhash"].count()
    packed = after["packing"].groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("all")).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in kept} and all(r.n == r.all for r in packed)
    assert after["packing"].select(*[x for x in after["packing"].columns if x not in ("sequence_id", "step_group", "offset", "start", "length", "ids_crc32", "sequence_length")]).distinct().count() == len(kept)


def test_run_gives_the_last_stage(spark, corpus):
    out = c.run(spark, corpus[0])
    assert out.agg(F.sum("length").alias("n")).first().n > 0 and c.ORACLE_SQL is None
    assert [n for n, _ in c.STAGES] == ["toxicity", "line_dedup", "minhash", "mixing", "packing"]


@pytest.mark.parametrize("made", [odd_documents, empty_documents])
def test_odd_and_empty_tables(spark, tmp_path, made):
    """Nulls in every column, repeated rows and ids, clashing names; and no rows at all: each stage keeps the columns, the last packs what is left."""
    docs = made(spark)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (3, 0, 1), (9, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in c.STAGES[:-1]:
        columns = docs.columns
        docs = stored(stage(spark, docs, str(tmp_path)), f"odd-{name}")
        assert docs.columns == columns
        assert made is odd_documents or docs.isEmpty()
    packed = c.STAGES[-1][1](spark, docs, str(tmp_path))
    assert packed.select(F.sum("length")).first()[0] == (packed.dropDuplicates(["doc_id", "doc_tokens"]).count() and packed.where("start = 0").agg(F.sum("doc_tokens")).first()[0] or None)


def test_names_of_queries():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))
    assert set(queries.SQL) <= set(queries.QUERIES)
