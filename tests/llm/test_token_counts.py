import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from tokenizers import Tokenizer

from helpers import documents, empty_documents, odd_documents, odd_texts, prose
from keyweave.llm import token_counts as t

PATH, WORDS, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
SIGNS = list("abcXYZéß09.,'\"!?-_ \t\n\x0b\x0c\r\x1c\x85\xa0　  中か😀½") + [
    "'s", "'ll", " 're", "  ", "<|endoftext|>", "<|endof", "text|>", "\n ", " \n", "word ", " word"]


def library(path, texts):
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor
        return [len(x) for x in SentencePieceProcessor(model_file=path).encode(texts)]
    whole = Tokenizer.from_file(path)
    return [len(whole.encode(x, add_special_tokens=False)) for x in texts]


def test_cuts_are_where_pre_tokens_begin():
    rng = random.Random(5)
    cut, count = t.PreTokens(t.Rule.of(PATH)), t.counter(PATH)
    texts = ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 40))) for _ in range(6000)]
    found, bounds = cut(pa.array(["skipped", *(x.encode() for x in texts)], pa.binary()).slice(1))
    pieces, numbers = found.to_pylist(), count(found.to_pylist())
    for text, a, b, want in zip(texts, bounds, bounds[1:], library(PATH, texts)):
        assert "".join(pieces[a:b]) == text and sum(numbers[a:b]) == want, (text, pieces[a:b])


def test_prose_is_cut_into_pre_tokens():
    found, _ = t.PreTokens(t.Rule.of(PATH))(pa.array([b"one two,three 4th it's\n\nfive  six"], pa.binary()))
    assert found.to_pylist() == ["one", " two", ",", "three", " 4", "th", " it", "'s", "\n", "\n", "five", " ", " six"]


@pytest.mark.parametrize("path", [PATH, WORDS, PIECES])
def test_counts_as_the_library(spark, path):
    rng = random.Random(7)
    texts = [prose(i, 5 + 41 * i % 300) for i in range(60)] + ["".join(rng.choice(SIGNS) for _ in range(60)) for _ in range(60)] + ["", None]
    rows = t.token_counts(documents(spark, texts).repartition(3), path, block_bytes=4000, bucket_bytes=2000).collect()
    want = library(path, [x or "" for x in texts])
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in rows) == [(i, len((x or "").encode()), want[i]) for i, x in enumerate(texts)]


def test_a_pre_token_is_counted_once(monkeypatch):
    """All copies of a pre-token meet in one bucket, which asks for each different one once."""
    blocks = pa.RecordBatch.from_pylist([{"block": b, "texts": t._packed("".join(x).encode()), "lengths": t._packed(np.array([len(w) for w in x]))}
                                         for b, x in enumerate([["a", "bb", "ccc"], ["bb", "dddd"], ["bb", "a", "x" * 100]])])
    dealt = pa.Table.from_batches(list(t._dealt(4)([blocks])))
    asked = []
    monkeypatch.setattr(t, "counter", lambda path: lambda texts: asked.extend(texts) or [len(x) for x in texts])
    found = {}
    for bucket in set(dealt.column("bucket").to_pylist()):
        for r in t._counted(PATH)(dealt.filter(pc.equal(dealt.column("bucket"), bucket))).to_pylist():
            at, pieces = np.split(t._unpacked(r["pieces"]), 2)
            found |= {(r["block"], int(a)): int(n) for a, n in zip(at, pieces)}
    assert sorted(asked) == ["a", "bb", "ccc", "dddd", "x" * 100]
    assert found == {(0, 0): 1, (0, 1): 2, (0, 2): 3, (1, 0): 2, (1, 1): 4, (2, 0): 2, (2, 1): 1, (2, 2): 100}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = t.token_counts(docs, PATH).collect()
    texts = [r.text for r in docs.collect()]
    want = library(PATH, [x or "" for x in texts])
    assert sorted((len((x or "").encode()), n) for x, n in zip(texts, want)) == sorted((r.n_bytes, r.n_tokens) for r in rows)
    assert sum(r.doc_id is None for r in rows) == 2 and len(rows) == len(odd_texts()) + 3
    assert t.token_counts(empty_documents(spark), PATH).collect() == []
