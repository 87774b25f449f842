"""Exact duplicates by Grace hashing.

1. Every input partition is combined on its own: an open-addressing table compares complete texts and
   emits one row per different text with its best row and count, so a text that holds a third of all rows
   costs one row per partition afterwards. A full table is emitted and started anew.
2. These rows are dealt out by the hash of the text. A task streams its rows through such a table; when
   the different texts exceed ``budget`` bytes, table and remaining rows are spilled to ``FANOUT`` files by
   a freshly seeded hash, and each file is treated the same way until it fits. Copies never add to a
   table, so a group of any size fits.
3. Group facts go back to the rows over the number of the partition's own group. Step 1 is a written table, so
   these numbers hold when an executor is lost.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyweave.llm.shared import stored, table_batch, text_bytes

FANOUT = 16
MEMBER, GROUP = 0, 1
_ROW = pa.schema([("kind", pa.int32()), ("rid", pa.int64()), ("gid", pa.int64()), ("doc_id", pa.int64()),
                  ("n", pa.int64()), ("h", pa.int64()), ("content", pa.binary())])
_FACTS = pa.schema([("gid", pa.int64()), ("keep_id", pa.int64()), ("keep_rid", pa.int64()),
                    ("group_size", pa.int64()), ("text_sha256", pa.string())])


def _better(a: tuple, b: tuple) -> tuple:
    """Of two (doc_id, rid): the larger id, a null id last, the earlier row at a tie."""
    rank = lambda x: (x[0] is not None, x[0] or 0, -x[1])
    return a if rank(a) >= rank(b) else b


class ContentTable:
    """Open addressing with linear probing over complete contents: best row, count, gids of each."""

    def __init__(self):
        self.slots = np.full(1024, -1, dtype=np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.best: list[tuple] = []
        self.counts: list[int] = []
        self.gids: list[list[int]] = []
        self.bytes = 0

    def _slot(self, h: int, content: bytes | None) -> int:
        slots, mask = self.slots, len(self.slots) - 1
        at = h & mask
        while (entry := slots[at]) >= 0:
            if content is not None and self.hashes[entry] == h and self.contents[entry] == content:
                break
            at = (at + 1) & mask
        return at

    def add(self, h: int, content: bytes, best: tuple, count: int, gids: list[int]) -> int:
        """Number of the content's entry."""
        at = self._slot(h, content)
        entry = int(self.slots[at])
        if entry < 0:
            entry = len(self.contents)
            self.slots[at] = entry
            self.hashes.append(h)
            self.contents.append(content)
            self.best.append(best)
            self.counts.append(count)
            self.gids.append(list(gids))
            self.bytes += len(content) + 200
            if 2 * len(self.contents) > len(self.slots):
                self.slots = np.full(2 * len(self.slots), -1, dtype=np.int64)
                for i, own in enumerate(self.hashes):
                    self.slots[self._slot(own, None)] = i
        else:
            self.best[entry] = _better(self.best[entry], best)
            self.counts[entry] += count
            self.gids[entry] += gids
        return entry

    def entries(self) -> Iterator[tuple]:
        return zip(self.contents, self.best, self.counts, self.gids)


def _hash(content: bytes, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(content, seed)


def grace(records: Iterable[tuple], budget: int, level: int = 0) -> Iterator[tuple]:
    """Records (content, best, count, gids) merged by content, with tables of at most ``budget`` bytes
    (one content may exceed it). Spill files have no name and go when they are closed."""
    table = ContentTable()
    records = iter(records)
    for content, best, count, gids in records:
        table.add(_hash(content, level), content, best, count, gids)
        if table.bytes > budget and len(table.contents) > 1:
            break
    else:
        yield from table.entries()
        return
    files = [tempfile.TemporaryFile() for _ in range(FANOUT)]
    for source in (table.entries(), records):
        for record in source:
            pickle.dump(record, files[_hash(record[0], level + 1) >> 60], protocol=5)
    del table
    for file in files:
        file.seek(0)
        yield from grace(_unpickled(file), budget, level + 1)
        file.close()


def _unpickled(file) -> Iterator[tuple]:
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            return


def _combine(budget: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        table, base, rid = ContentTable(), part << 40, part << 40

        def flush():
            step = 500
            for i in range(0, len(table.contents), step):
                yield table_batch([(GROUP, best[1], base + j, best[0], count,
                                    xxhash.xxh3_64_intdigest(content, 1 << 32) - (1 << 63), content)
                                   for j, (content, best, count) in enumerate(
                                       zip(table.contents[i:i + step], table.best[i:i + step], table.counts[i:i + step]), i)],
                                  _ROW)

        for batch in batches:
            members = []
            for doc_id, content in zip(batch.column("doc_id").to_pylist(), batch.column("content").to_pylist()):
                entry = table.add(_hash(content, 0), content, (doc_id, rid), 1, [])
                members.append((MEMBER, rid, base + entry, doc_id, None, None, None))
                rid += 1
            if members:
                yield table_batch(members, _ROW)
            if table.bytes > budget:
                yield from flush()
                base += len(table.contents)
                table = ContentTable()
        yield from flush()

    return run


def _facts(budget: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in ("content", "doc_id", "rid", "n", "gid")]
                for content, doc_id, rid, n, gid in zip(*columns):
                    yield content, (doc_id, rid), n, [gid]

        out = []
        for content, best, count, gids in grace(records(), budget):
            digest = hashlib.sha256(content).hexdigest()
            out += [(gid, best[0], best[1], count, digest) for gid in gids]
            if len(out) >= 5000:
                yield table_batch(out, _FACTS)
                out = []
        if out:
            yield table_batch(out, _FACTS)

    return run


def exact_duplicates(docs: DataFrame, normalise: Callable[[Column], Column] | None = None,
                     budget: int = 128 << 20) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after ``normalise`` (a Column function; none by default); null counts as empty.
    Of equal texts the row with the largest doc_id stays, a null id last; of repeated rows with that id exactly one has
    ``kept`` true. An empty table gives an empty result. Other columns of ``docs`` are not read.
    """
    text = text_bytes()
    if normalise is not None:
        text = F.coalesce(normalise(F.coalesce(F.col("text"), F.lit(""))), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("content"))
    combined = stored(rows.mapInArrow(_combine(budget), "kind int, rid long, gid long, doc_id long, n long, h long, content binary"),
                      "exact", partition_by="kind")
    groups = combined.where(F.col("kind") == GROUP).select("gid", "doc_id", "rid", "n", "h", "content")
    facts = (groups.repartition(F.col("h"))
             .mapInArrow(_facts(budget), "gid long, keep_id long, keep_rid long, group_size long, text_sha256 string"))
    members = combined.where(F.col("kind") == MEMBER).select("gid", "rid", "doc_id")
    return members.join(facts, "gid").select("doc_id", "keep_id", "group_size",
                                             (F.col("rid") == F.col("keep_rid")).alias("kept"), "text_sha256")
