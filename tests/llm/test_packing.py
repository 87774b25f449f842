import json
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from helpers import documents, empty_documents, odd_documents, prose
from keyweave.llm import packing as p

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, texts, tiers=p.TIERS):
    whole = Tokenizer.from_file(PATH)
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(pieces) == set(texts)
    for doc, own in pieces.items():
        ids = whole.encode(texts[doc] or "", add_special_tokens=False).ids + [p.END_ID]
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            part = np.array(ids[r.start:r.start + r.length], dtype="<u4")
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(part.tobytes())
            at += r.length
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == own[0].sequence_length <= max(tiers) and at & (at - 1) == 0


def test_every_id_in_one_piece(spark):
    texts = {i: prose(i, 20 + 37 * i % 900) for i in range(150)} | {150: "", 151: None, 152: prose(9, 9000), 153: "a 0 <|endoftext|> b"}
    rows = p.pack_documents(documents(spark, list(texts.items())), PATH, with_ids=True).collect()
    check(rows, texts)
    assert all(len(r.ids) == r.length for r in rows)


def test_step_groups_are_balanced(spark):
    docs = documents(spark, [prose(i, 30 + 53 * i % 800) for i in range(200)]).coalesce(1)
    rows = p.pack_documents(docs, PATH, step_tokens=8192, with_ids=False).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.step_group, {})[r.sequence_id] = r.sequence_length
    loads = sorted(sum(g.values()) for g in groups.values())
    assert loads[-1] <= 8192 + 2048 and sum(x == 8192 for x in loads) >= len(loads) - 3


def test_odd_rows(spark):
    docs = odd_documents(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    check(p.pack_documents(docs, PATH, with_ids=False).collect(), {r.doc_id: r.text for r in docs.collect()})
    assert p.pack_documents(odd_documents(spark), PATH, with_ids=False).where("doc_id is null").count() == 2
    assert p.pack_documents(empty_documents(spark), PATH).isEmpty()


def test_words_as_the_whole_tokenizer():
    rng = random.Random(3)
    signs = list("abcXYZéÉßñİıǅſµ×÷ªº0123.,'\"!?-_ \t\n\x0b\x0c\x1c 　́èΣσςЖ中🙂½") + ["'s", "'ll", "don't", "<|endoftext|>", " 0 ", "DŽ", "ŉ"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    whole = Tokenizer.from_file(PATH)
    for text, ids in zip(texts, p.WordEncoder(PATH)(pa.array(texts))):
        assert whole.encode(text, add_special_tokens=False).ids == ids.tolist(), text


def test_other_tokenizers_get_whole_texts(tmp_path, spark):
    other = public_tokenizers.path("byte_bpe_50k.json")  # keeps case and white space
    rules = json.load(open(PATH, encoding="utf-8"))
    assert p.WordEncoder(PATH).by_word and not p.WordEncoder(other).by_word
    rules["normalizer"]["normalizers"].pop()  # as the given file, but with capitals
    rules["truncation"] = {"direction": "Right", "max_length": 5, "strategy": "LongestFirst", "stride": 0}
    (tmp_path / "capitals.json").write_text(json.dumps(rules), encoding="utf-8")
    texts = ["Two  Words\n\nand MORE of them", "", "  ä Ö", "x" * 3000]
    for path in (other, str(tmp_path / "capitals.json")):
        whole = Tokenizer.from_file(path)
        whole.no_truncation()
        want = [whole.encode(text, add_special_tokens=False).ids for text in texts]
        assert [ids.tolist() for ids in p.WordEncoder(path)(pa.array(texts))] == want
        rows = p.pack_documents(documents(spark, texts), path).collect()
        for doc, ids in enumerate(want):
            assert [i for r in sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.start) for i in r.ids] == [*ids, p.END_ID]
