"""Fill-in-middle transformation: texts cut at two code points, and their parts put in another order between sentinels.

Cuts are counted in code points, texts are stored as UTF-8 bytes. Of a batch only the characters of several bytes are recorded, by
their position in code points and the bytes they have beyond one: a sparse index of exceptions. A cut is turned into a byte position by a binary
search in it, all cuts of a batch at once; between exceptions bytes and code points differ by a constant. No text is decoded.

Everything about a document follows from its id and the seed, so results don't depend on how rows are dealt out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyweave.llm.shared import slices, text_bytes

AT_ONCE_BYTES = 16 << 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


@dataclass(frozen=True)
class Rates:
    """Of a hundred documents: how many are transformed at all, and of these how many have the suffix first."""

    transformed: int = 90
    suffix_first: int = 20


class Exceptions:
    """Characters of several bytes in stretches of UTF-8 that lie one after another in ``data``."""

    def __init__(self, data: np.ndarray):
        lead = np.flatnonzero(data >= 0xC0)
        sign = data[lead]
        excess = 1 + (sign >= 0xE0).astype(np.int64) + (sign >= 0xF0)
        self.bytes = lead
        #: Bytes in excess of one a character, before the k-th exception and after all.
        self.before = np.concatenate([[0], np.cumsum(excess)])
        self.points = lead - self.before[:-1]

    def point_of(self, byte: np.ndarray) -> np.ndarray:
        """Code points before a byte at which a character begins."""
        return byte - self.before[np.searchsorted(self.bytes, byte)]

    def byte_of(self, point: np.ndarray) -> np.ndarray:
        """Byte at which a code point begins."""
        return point + self.before[np.searchsorted(self.points, point)]


def _draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers of 32 bits drawn for a document."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


_OUT = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                  ("output", pa.string())])


def _transform(rates: Rates, sentinels: tuple[str, str, str]):
    p, s, m = (x.encode() for x in sentinels)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", AT_ONCE_BYTES):
                yield one(part)

    def one(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = part.column("text")
        ends = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        raw = texts.buffers()[2]
        data = b"" if raw is None else raw.slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes()
        bounds = ends - ends[0]
        index = Exceptions(np.frombuffer(data, dtype=np.uint8))
        points = index.point_of(bounds)
        n = np.diff(points)
        h1, h2, h3, h4 = (part.column(f"h{i}").to_numpy() for i in range(1, 5))
        cuts = np.sort(np.stack([h1 % (n + 1), h2 % (n + 1)]), axis=0)
        first, second = index.byte_of(points[:-1] + cuts[0]), index.byte_of(points[:-1] + cuts[1])
        plain = (n == 0) | (h3 % 100 >= rates.transformed)
        spm = h4 % 100 < rates.suffix_first
        forms, outputs = [], []
        for start, a, b, end, keep, turned in zip(bounds[:-1].tolist(), first.tolist(), second.tolist(), bounds[1:].tolist(), plain.tolist(), spm.tolist()):
            if keep or any(data.find(x, start, end) >= 0 for x in (p, s, m)):
                forms.append("plain")
                outputs.append(data[start:end])
            elif turned:
                forms.append("spm")
                outputs.append(b"".join((s, data[b:end], p, data[start:a], m, data[a:b])))
            else:
                forms.append("psm")
                outputs.append(b"".join((p, data[start:a], s, data[b:end], m, data[a:b])))
        whole = np.array([f == "plain" for f in forms], dtype=bool)
        return pa.RecordBatch.from_arrays([
            part.column("doc_id"), pa.array(n), pa.array(forms, pa.string()), pa.array(cuts[0], mask=whole), pa.array(cuts[1] - cuts[0], mask=whole),
            pa.array(outputs, pa.binary()).cast(pa.string())], schema=_OUT)

    return run


def fill_in_middle(docs: DataFrame, seed: int = 1, rates: Rates = Rates(), sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> DataFrame:
    """One row per row of ``docs``: doc_id, n (code points), form (plain, psm or spm), prefix_chars, middle_chars (null if plain), output.

    A text stays as it is (plain) if it is empty or null, holds a sentinel, or isn't drawn. Otherwise it is cut at two drawn places into
    prefix, middle and suffix, which psm gives in the order prefix, suffix, middle and spm in the order suffix, prefix, middle, each after its
    sentinel. Repeated rows give the same result each; a null doc_id is kept and drawn for like an empty one; an empty table gives an empty
    result; other columns of ``docs`` are not read.
    """
    key = F.col("doc_id").cast("long")
    rows = docs.select(key.alias("doc_id"), text_bytes().alias("text"), *_draws(key, seed))
    return rows.mapInArrow(_transform(rates, tuple(sentinels)), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text an output was made of. No part holds a sentinel, and a sentinel can't begin in a part and end in the next, so cutting the output at
    the sentinels gives the parts back."""
    parts = F.split(output, "|".join(rf"\Q{x}\E" for x in sentinels), -1)
    return (F.when(form == "psm", F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2))))
            .when(form == "spm", F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))).otherwise(output))
