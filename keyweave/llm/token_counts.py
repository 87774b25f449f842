"""Token counts of documents: the pieces of each different pre-token are counted once, and joined to the documents' frequencies.

1. ``_blocks``: documents are cut into pre-tokens in blocks of about ``BLOCK_BYTES``. A block is one row: its different pre-tokens, and for
   each of its documents which of them it holds and how often, packed. Nothing is exchanged.
2. ``_dealt``, ``_counted``: the pre-tokens of all blocks are dealt to buckets by a hash of their text, so that each different one comes to one task, which
   counts its pieces once. A pre-token is there once a block at most: none can be a large share of a bucket's rows, however often it occurs. The
   number of buckets follows from the bytes of the blocks' pre-tokens.
3. ``_summed``: counts go back to their blocks, and a document's count is the sum of frequency times pieces. A group is a block's own
   pre-tokens, bounded by the block's bytes.

Token ids of documents are never made. Blocks are numbered by the task that made them and written before they are used, so a task that runs
again can't number them anew.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyweave.llm.shared import slices, stored, table_batch, text_bytes

BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 4 << 20
COUNTED_BYTES = 1 << 18

OTHER, SPACE, BREAK, LETTER, DIGIT, QUOTE, SIGN, LEAD = range(8)
_WORDLIKE = (LETTER, DIGIT, QUOTE, SIGN)


def byte_classes() -> np.ndarray:
    """Class of each byte. ``LEAD`` begins a character of several bytes that can't be white space; of ``OTHER`` nothing is known."""
    out = np.full(256, OTHER, dtype=np.uint8)
    out[33:127] = SIGN
    out[32], out[9:14], out[39] = SPACE, BREAK, QUOTE
    out[48:58], out[65:91], out[97:123] = DIGIT, LETTER, LETTER
    out[0xC3:0xE0], out[0xE4:0xF5] = LEAD, LEAD
    return out


def sure_cuts() -> tuple[np.ndarray, np.ndarray]:
    """For two neighbouring bytes (class of the first * 8 + class of the second), whether a pre-token surely begins at the second, and
    whether one surely begins at the first.

    Pre-tokens of a byte-level tokenizer are runs of letters, of digits or of signs, each with at most one space before; the endings
    's, 't and so on; and white space, of which the last character before something else stands apart or leads it. Signs and
    letters after an apostrophe stay together here, as do characters of several bytes with their neighbours: cutting too seldom is never wrong.
    """
    second, first = np.zeros((8, 8), dtype=bool), np.zeros((8, 8), dtype=bool)
    for a in _WORDLIKE:
        second[a, [SPACE, BREAK]] = True
        second[BREAK, a] = True
    second[BREAK, LEAD] = True
    second[LETTER, [DIGIT, QUOTE, SIGN]] = True
    second[DIGIT, [LETTER, QUOTE, SIGN]] = True
    second[SIGN, [LETTER, DIGIT]] = True
    second[QUOTE, DIGIT] = True
    for space in (SPACE, BREAK):
        first[space, [*_WORDLIKE, LEAD]] = True
    return second.ravel(), first.ravel()


def counter(path: str):
    """Function from texts to their numbers of tokens by the tokenizer of a file (``.model``: sentencepiece, else tokenizers), without truncation,
    padding or added begin and end."""
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    # a task is one of several on its machine: threads of its own would take their cores, and memory for each thread
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return lambda texts: [len(e) for e in made.encode_batch_fast(texts, add_special_tokens=False)]


@dataclass(frozen=True)
class Rule:
    """Whether a tokenizer's texts may be cut by ``sure_cuts``, and the pattern of the strings that it takes out of a text first."""

    cuts: bool = False
    specials: bytes | None = None

    @classmethod
    def of(cls, path: str) -> Rule:
        if path.endswith(".model"):
            return cls()
        from tokenizers import Tokenizer

        spec = json.loads(Tokenizer.from_file(path).to_str())
        before, added = spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
        byte_level = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        plain = not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip"))
        if not byte_level or not plain or spec.get("normalizer") is not None or spec["model"].get("dropout") is not None:
            return cls()
        longest_first = sorted((t["content"].encode() for t in added), key=len, reverse=True)
        return cls(True, b"|".join(map(re.escape, longest_first)) or None)


class PreTokens:
    """Cuts texts into pre-tokens, or into stretches of a few that are always counted alike wherever they stand."""

    def __init__(self, rule: Rule):
        self.cuts, self.specials = rule.cuts, rule.specials and re.compile(rule.specials)
        self.classes, (self.second, self.first) = byte_classes(), sure_cuts()

    def _special_spans(self, data: bytes, bounds: list[int]) -> list[tuple[int, int]]:
        """Where the tokenizer's own strings stand in the texts; they are cut out before anything else."""
        if self.specials is None or not self.specials.search(data):
            return []
        return [m.span() for a, b in zip(bounds, bounds[1:]) for m in self.specials.finditer(data, a, b)]

    def __call__(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Pre-tokens of all texts (bytes) in a row, and where each text's begin (one more entry at the end)."""
        bounds = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        if not self.cuts or bounds[-1] == bounds[0]:
            full = np.flatnonzero(np.diff(bounds))
            return texts.take(pa.array(full)), np.searchsorted(full, np.arange(len(texts) + 1))
        base, size = int(bounds[0]), int(bounds[-1] - bounds[0])
        buffer = texts.buffers()[2].slice(base, size)
        bounds -= base
        classes = self.classes[np.frombuffer(buffer, dtype=np.uint8)]
        codes = classes[:-1] * np.uint8(8) + classes[1:]
        begins = np.zeros(size, dtype=bool)
        begins[1:] = self.second[codes]
        begins[:-1] |= self.first[codes]
        spans = self._special_spans(buffer.to_pybytes(), bounds.tolist()) if self.specials else []
        edges = np.concatenate([bounds, np.array(spans, dtype=np.int64).ravel()])
        edges = edges[edges < size]
        # what follows an edge doesn't tell how the white space before it is cut
        last = edges[edges > 1] - 1
        begins[last] = self.second[codes[last - 1]]
        for start, end in spans:
            begins[start:end] = False
        begins[edges] = True
        starts = np.flatnonzero(begins)
        offsets = np.append(starts, size).astype(np.int32)
        cut = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), buffer])
        return cut, np.searchsorted(starts, bounds)


_PACK = ["codes", "times", "texts", "lengths"]
_BLOCK = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_bytes", pa.list_(pa.int64())), ("starts", pa.list_(pa.int32())),
                    *[(c, pa.binary()) for c in _PACK], ("pretokens", pa.int64()), ("pretoken_bytes", pa.int64())])


def _packed(*parts: np.ndarray | bytes) -> bytes:
    """Whole numbers of 32 bits (without their count) and bytes in a row; compressed where that can pay."""
    raw = b"".join(x if isinstance(x, bytes) else x.astype("<i4").tobytes() for x in parts)
    return len(raw).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True) if len(raw) > 200 else bytes(4) + raw


def _raw(data: bytes) -> bytes:
    size = int.from_bytes(data[:4], "little")
    return pa.decompress(data[4:], decompressed_size=size, codec="zstd", asbytes=True) if size else data[4:]


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(_raw(data), dtype="<i4")


def _contents(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins (one more at the end)."""
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, dtype=np.int64)
    data = texts.buffers()[2] if len(texts) else None
    held = np.frombuffer(data, dtype=np.uint8)[bounds[0]:bounds[-1]] if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return held, bounds - bounds[0]


def _strings(data: bytes, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _frequencies(owners: np.ndarray, codes: np.ndarray, docs: int, different: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each document's different codes begin (one more at the end), these codes in ascending order, and how often each occurs."""
    pairs = owners * different + codes
    pairs.sort()
    first = np.flatnonzero(np.diff(pairs, prepend=-1))
    times = np.diff(np.append(first, len(pairs)))
    pairs = pairs[first]
    return np.searchsorted(pairs, np.arange(docs + 1) * different), pairs % different, times


def _blocks(rule: Rule, size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, block = PreTokens(rule), TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", size):
                found, bounds = cut(part.column("text"))
                coded = found.cast(pa.string()).dictionary_encode()
                starts, codes, times = _frequencies(np.repeat(np.arange(len(part)), np.diff(bounds)), coded.indices.to_numpy(), len(part), max(len(coded.dictionary), 1))
                data, ends = _contents(coded.dictionary)
                _, text_ends = _contents(part.column("text"))
                one = lambda name, value: pa.array([value], type=_BLOCK.field(name).type)
                yield pa.RecordBatch.from_arrays([
                    one("block", block), pa.ListArray.from_arrays([0, len(part)], part.column("doc_id")), one("n_bytes", np.diff(text_ends)), one("starts", starts),
                    one("codes", _packed(np.diff(codes, prepend=0))), one("times", _packed(times)), one("texts", _packed(data.tobytes())),
                    one("lengths", _packed(np.diff(ends))), one("pretokens", len(coded.dictionary)), one("pretoken_bytes", len(data))], schema=_BLOCK)
                block += 1

    return run


def _hashes(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A number for each text that depends on its bytes alone: a polynomial in them, mixed."""
    lengths = np.diff(bounds)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(lengths.max(initial=0)) + 1, 0x9E3779B97F4A7C15, dtype=np.uint64))
        at = np.arange(len(data)) - np.repeat(bounds[:-1], lengths)
        sums = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * powers[at], bounds[:-1]) if len(lengths) else np.zeros(0, dtype=np.uint64)
        sums = (sums ^ (sums >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return sums >> np.uint64(32)


_DEALT = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("texts", pa.binary())])


def _dealt(buckets: int):
    """A block's pre-tokens by bucket: how many, their places in the block, their lengths, and their bytes."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, texts, lengths in zip(*(batch.column(c).to_pylist() for c in ("block", "texts", "lengths"))):
                own = _strings(_raw(texts), _unpacked(lengths))
                bucket = (_hashes(*_contents(own)) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                data, ends = _contents(own.take(pa.array(order)))
                used, firsts = np.unique(bucket[order], return_index=True)
                rows = [(b, block, _packed(np.array([j - i]), order[i:j], np.diff(ends[i:j + 1]), data[ends[i]:ends[j]].tobytes()))
                        for b, i, j in zip(used.tolist(), firsts.tolist(), [*firsts[1:].tolist(), len(order)])]
                for i in range(0, len(rows), 5000):
                    yield table_batch(rows[i:i + 5000], _DEALT)

    return run


_PIECES = pa.schema([("block", pa.int64()), ("pieces", pa.binary())])


def _counted(path: str):
    """Pieces of a bucket's pre-tokens: for each block their places and numbers."""
    held: dict[str, Callable] = {}  # a task reads the tokenizer once

    def run(rows: pa.Table) -> pa.Table:
        count = held.setdefault("count", held.get("count") or counter(path))
        places, lengths, texts = [], [], []
        for raw in map(_raw, rows.column("texts").to_pylist()):
            n = int.from_bytes(raw[:4], "little")
            numbers = np.frombuffer(raw, dtype="<i4", count=1 + 2 * n)
            places.append(numbers[1:1 + n])
            lengths.append(numbers[1 + n:])
            texts.append(raw[4 + 8 * n:])
        coded = _strings(b"".join(texts), np.concatenate(lengths)).dictionary_encode()
        different = pa.RecordBatch.from_arrays([coded.dictionary], names=["text"])
        counts = np.array([n for part in slices(different, "text", COUNTED_BYTES) for n in count(part.column("text").to_pylist())], dtype=np.int64)
        pieces = np.split(counts[coded.indices.to_numpy()], np.cumsum([len(x) for x in lengths])[:-1])
        return pa.Table.from_arrays([rows.column("block"), pa.array([_packed(at, n) for at, n in zip(places, pieces)], pa.binary())], schema=_PIECES)

    return run


_COUNTS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def _summed(blocks: pa.Table, pieces: pa.Table) -> pa.Table:
    """Counts of the documents of a block."""
    row = blocks.to_batches()[0]
    starts = row.column("starts").flatten().to_numpy().astype(np.int64)
    codes = np.cumsum(_unpacked(row.column("codes")[0].as_py()), dtype=np.int64)
    each = np.zeros(row.column("pretokens")[0].as_py(), dtype=np.int64)
    for numbers in map(_unpacked, pieces.column("pieces").to_pylist()):
        each[numbers[:len(numbers) // 2]] = numbers[len(numbers) // 2:]
    total = np.concatenate([[0], np.cumsum(each[codes] * _unpacked(row.column("times")[0].as_py()))])
    tokens = total[starts[1:]] - total[starts[:-1]]
    return pa.Table.from_arrays([row.column("doc_ids").flatten(), row.column("n_bytes").flatten(), pa.array(tokens)], schema=_COUNTS)


def token_counts(docs: DataFrame, tokenizer: str, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (of the text in UTF-8), n_tokens.

    ``tokenizer`` is the path of a tokenizer file, the same on all executors. Counts are those of the tokenizer's library over the whole text,
    its own special strings taken as it takes them by default; texts of a tokenizer whose pre-tokens aren't known here are one pre-token each.
    A null or empty text has no bytes and no tokens. Repeated rows are counted each, a null doc_id is kept, an empty table gives an empty
    result; other columns of ``docs`` are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    packs = ", ".join(f"{c} binary" for c in _PACK)
    blocks = stored(rows.mapInArrow(_blocks(Rule.of(tokenizer), block_bytes), f"block long, doc_ids array<long>, n_bytes array<long>, starts array<int>, {packs}, "
                                    "pretokens long, pretoken_bytes long"), "token-blocks")
    buckets = 1 + (blocks.agg(F.sum("pretoken_bytes")).first()[0] or 0) // bucket_bytes
    dealt = blocks.select("block", "texts", "lengths").mapInArrow(_dealt(buckets), "bucket long, block long, texts binary")
    pieces = dealt.groupBy("bucket").applyInArrow(_counted(tokenizer), "block long, pieces binary")
    # a block of empty texts has no pre-tokens and is summed all the same
    return (blocks.select("block", "doc_ids", "n_bytes", "starts", "codes", "times", "pretokens").groupBy("block").cogroup(pieces.groupBy("block"))
            .applyInArrow(_summed, "doc_id long, n_bytes long, n_tokens long"))
