"""Hierarchical multi-length packing of tokenised documents into training sequences.

Each task streams its own documents: no shuffle, and at most ``WINDOW`` tokens are held. A document's whole
windows become sequences of the longest tier; what is left is routed to the smallest tier that holds it. From the
longest tier down, each rest opens a sequence of its tier, and the gap is filled with the largest rests of shorter
tiers that fit; where none fits, one is cut. Sequences that can't be filled wait for the next window; at the
end of a task they are cut into powers of two, which need no padding. Sequences of one tier are dealt to step
groups of equal token counts; groups of mixed tiers take what a task has left.
"""

from __future__ import annotations

import json
import os
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyweave.llm.shared import slices, table_batch

END_ID = 1
TIERS = (256, 512, 1024, 2048)
STEP_TOKENS = 32 * 2048
WINDOW = 1 << 22
ENCODED_BYTES = 32 << 20


#: A word of Latin letters, perhaps with other ASCII signs after them: its letters are one unit of the tokenizer, its signs another.
LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
LATIN_WORD = f"^[{LATIN}]+[!-/:-@\\[-`{{-~]*$"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, the others, in
    order, for the letters from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(other)) for b in range(256)]


#: Steps of a tokenizer file under which words may be tokenised apart (fixed values, as such files state them).
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
UNITS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def cuts_at_words(rules: dict) -> bool:
    """Whether a tokenizer with the ``rules`` of its file lower-cases, drops white space and cuts into letters, digits and signs, byte by
    byte, so that each word and each of its units can be tokenised by itself."""
    steps = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    model = rules.get("model") or {}
    return ((rules.get("normalizer") or {}).get("normalizers") == NORMALIZERS and [s.get("type") for s in steps] == ["Split", "ByteLevel"]
            and steps[0].get("pattern") == {"Regex": UNITS} and steps[0].get("behavior") == "Removed" and steps[0].get("invert") is True
            and not steps[1].get("add_prefix_space") and not steps[1].get("use_regex") and model.get("type") == "BPE" and not model.get("dropout")
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t["content"].split() != [t["content"]] or t["content"][0].isalpha()
                        for t in rules.get("added_tokens") or []))


class WordEncoder:
    """Token ids of whole texts. Where the tokenizer's file allows it (``cuts_at_words``), each different word of the texts given
    together is tokenised once: words of Latin letters, lower-cased, by the tokenizer's model unit by unit, all others by the whole
    tokenizer. By any other tokenizer whole texts are tokenised."""

    AT_ONCE = 512

    def __init__(self, path: str):
        # a task is one of several on its machine: threads of its own would take their cores, and keep memory each
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.letters = Tokenizer.from_file(path), byte_letters()
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            self.by_word = cuts_at_words(json.load(file))

    def _whole(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _latin(self, words: list[str]) -> list[list[int]]:
        tokenize, letters, out = self.tokenizer.model.tokenize, self.letters, []
        for word in words:
            word = word.lower()
            if not word.isascii():
                word = "".join([letters[b] for b in word.encode()])
            out.append([t.id for t in tokenize(word)])
        return out

    @staticmethod
    def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each list begins (one more entry at the end)."""
        bounds = np.zeros(len(ids) + 1, dtype=np.int64)
        np.cumsum(np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)), out=bounds[1:])
        return np.fromiter(chain.from_iterable(ids), dtype=np.uint32, count=int(bounds[-1])), bounds

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row and the words' bounds in it."""
        latin = pc.match_substring_regex(words, LATIN_WORD)
        plain = words.filter(latin)
        heads = pc.utf8_lower(pc.replace_substring_regex(plain, f"[^{LATIN}]+$", "")).dictionary_encode()
        tails = pc.replace_substring_regex(plain, f"^[{LATIN}]+", "").dictionary_encode()
        rest = words.filter(pc.invert(latin)).to_pylist()
        parts = (self._latin(heads.dictionary.to_pylist()), self._whole(tails.dictionary.to_pylist()), self._whole(rest))
        flat, bounds = self._flat([ids for part in parts for ids in part])
        mask = latin.to_numpy(zero_copy_only=False)
        first, second = np.zeros(len(words), dtype=np.int64), np.full(len(words), -1, dtype=np.int64)
        first[mask] = heads.indices.to_numpy()
        second[mask] = tails.indices.to_numpy() + len(parts[0])
        first[~mask] = np.arange(len(rest)) + len(parts[0]) + len(parts[1])
        units = np.column_stack([first, second]).ravel()
        units = units[units >= 0]
        ends = np.cumsum(1 + (second >= 0))
        ids, unit_ends = gather(flat, bounds, units)
        return ids, np.concatenate([[0], unit_ends[ends - 1]])

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text, without an end id."""
        if not self.by_word:
            for i in range(0, len(texts), self.AT_ONCE):
                yield from (np.array(ids, dtype=np.uint32) for ids in self._whole(texts[i:i + self.AT_ONCE].to_pylist()))
            return
        lists = pc.ascii_split_whitespace(texts)
        cuts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        coded = lists.flatten().dictionary_encode()
        flat, bounds = self._words(coded.dictionary)
        codes = coded.indices.to_numpy()
        for i in range(0, len(texts), self.AT_ONCE):
            own = cuts[i:i + self.AT_ONCE + 1]
            ids, ends = gather(flat, bounds, codes[own[0]:own[-1]])
            ends = np.concatenate([[0], ends])
            yield from np.split(ids, ends[own[1:-1] - own[0]])


def gather(flat: np.ndarray, bounds: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces ``chosen`` of ``flat`` (piece k is ``flat[bounds[k]:bounds[k + 1]]``) in a row, and where each ends."""
    start = bounds[chosen]
    counts = bounds[chosen + 1] - start
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(start - ends + counts, counts)], ends


class Packer:
    """Packs documents of one task; ``emit`` gets (sequence, offset, piece) for each piece."""

    def __init__(self, tiers: tuple[int, ...], emit: Callable):
        self.tiers, self.top = sorted(tiers), max(tiers)
        self.emit, self.made = emit, 0
        self.lengths: list[int] = []
        self.pool: dict[int, list] = {}
        self.held = 0

    def _put(self, piece: tuple) -> None:
        insort(self.lengths, piece[2])
        self.pool.setdefault(piece[2], []).append(piece)
        self.held += piece[2]

    def _take(self, at: int) -> tuple:
        length = self.lengths.pop(at)
        same = self.pool[length]
        piece = same.pop()
        if not same:
            del self.pool[length]
        self.held -= length
        return piece

    def _sequence(self, pieces: list, size: int) -> None:
        offset = 0
        for piece in pieces:
            self.emit(self.made, offset, size, piece)
            offset += piece[2]
        self.made += 1

    def add(self, doc, ids: np.ndarray) -> None:
        """Whole windows at once; the rest waits."""
        whole = len(ids) // self.top * self.top
        for start in range(0, whole, self.top):
            self._sequence([(doc, start, self.top, ids)], self.top)
        if len(ids) > whole:
            self._put((doc, whole, len(ids) - whole, ids))

    def _fill(self, gap: int) -> list:
        pieces = []
        while gap and self.lengths:
            at = bisect_right(self.lengths, gap) - 1
            if at >= 0:
                piece = self._take(at)
            else:
                doc, start, length, ids = self._take(0)
                self._put((doc, start + gap, length - gap, ids))
                piece = (doc, start, gap, ids)
            pieces.append(piece)
            gap -= piece[2]
        return pieces

    def pack(self, last: bool = False) -> None:
        """Full sequences from what waits; with ``last``, of the remainder too."""
        while self.lengths:
            tier = self.tiers[bisect_left(self.tiers, self.lengths[-1])]
            if self.held < tier:
                break
            piece = self._take(len(self.lengths) - 1)
            self._sequence([piece, *self._fill(tier - piece[2])], tier)
        while last and self.held:
            size = 1 << (self.held.bit_length() - 1)
            self._sequence(self._fill(size), size)


class StepGroups:
    """Deals sequences to groups of ``budget`` tokens: one tier each, the remainder of all tiers mixed, longest first,
    always into the emptiest group."""

    def __init__(self, budget: int):
        self.budget, self.made, self.open = budget, 0, {}

    def add(self, sequence: int, size: int) -> list[tuple[int, int]]:
        """(sequence, group) of a group that is full now."""
        waiting = self.open.setdefault(size, [])
        waiting.append(sequence)
        if len(waiting) * size < self.budget:
            return []
        self.made += 1
        return [(s, self.made - 1) for s in self.open.pop(size)]

    def rest(self) -> list[tuple[int, int]]:
        left = sorted(((size, s) for size, all_ in self.open.items() for s in all_), reverse=True)
        n = max(1, -(-sum(size for size, _ in left) // self.budget))
        load, out = [0] * n, []
        for size, s in left:
            at = load.index(min(load))
            load[at] += size
            out.append((s, self.made + at))
        return out


_FIELDS = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
           ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
           ("sequence_length", pa.int32()), ("step_group", pa.int64())]


class TaskOutput:
    """Rows of one task: pieces wait until their sequence has a step group."""

    def __init__(self, base: int, step_tokens: int, with_ids: bool):
        self.base, self.groups, self.with_ids = base, StepGroups(step_tokens), with_ids
        self.pieces: dict[int, list] = {}
        self.sizes: dict[int, int] = {}
        self.ready: list[tuple] = []
        self.schema = pa.schema(_FIELDS + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def put(self, sequence: int, offset: int, size: int, piece: tuple) -> None:
        (doc, total), start, length, ids = piece
        part = ids[start:start + length]
        row = (doc, start, length, zlib.crc32(part.astype("<u4").tobytes()), total, self.base + sequence, offset, size)
        self.pieces.setdefault(sequence, []).append((row, part.astype(np.int32) if self.with_ids else None))
        self.sizes[sequence] = size

    def group(self, last: bool = False) -> None:
        """Gives step groups to the sequences made since."""
        for sequence, size in self.sizes.items():
            self._close(self.groups.add(sequence, size))
        self.sizes.clear()
        if last:
            self._close(self.groups.rest())

    def _close(self, pairs: list[tuple[int, int]]) -> None:
        for sequence, group in pairs:
            for row, part in self.pieces.pop(sequence):
                self.ready.append((*row, self.base + group, *([part] if self.with_ids else [])))

    def batches(self) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(self.ready), 20000):
            yield table_batch(self.ready[i:i + 20000], self.schema)
        self.ready = []


def _run(path: str, tiers: tuple[int, ...], step_tokens: int, with_ids: bool) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordEncoder(path)
        out = TaskOutput(TaskContext.get().partitionId() << 32, step_tokens, with_ids)
        packer = Packer(tiers, out.put)
        for batch in batches:
            for part in slices(batch, "text", ENCODED_BYTES):
                for i, (doc, ids) in enumerate(zip(part.column("doc_id").to_pylist(), encode(part.column("text")))):
                    ids = np.append(ids, np.uint32(END_ID))
                    packer.add((doc, len(ids)), ids)
                    if i % 256 == 0:
                        if packer.held >= WINDOW:
                            packer.pack()
                        out.group()
                        yield from out.batches()
        packer.pack(last=True)
        out.group(last=True)
        yield from out.batches()
        pa.default_memory_pool().release_unused()  # the worker goes on to other stages

    return run


def pack_documents(docs: DataFrame, tokenizer: str, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS,
                   with_ids: bool = True) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    sequence_length, step_group, and with ``with_ids`` the token ids.

    ``tokenizer`` is the path of a tokenizer file, the same on all executors; where its tokens may cross words, whole texts are tokenised. A
    document's ids are those of its text, then ``END_ID``; a null or empty text has that id alone. Every sequence is
    full, its length a tier or, for the remainder of a task, a smaller power of two. Repeated rows are packed each;
    a null doc_id is kept. An empty table gives an empty result. Other columns of ``docs`` are not read.
    """
    schema = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
              "sequence_length int, step_group long" + (", ids array<int>" if with_ids else ""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInArrow(_run(tokenizer, tuple(tiers), step_tokens, with_ids), schema)
