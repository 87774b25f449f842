"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

1. One pass over whole texts computes a few statistics each (``STATISTICS``); they are a written table, so texts are read once
   and never shuffled.
2. Labelled documents outside the held-out fold give the scale of the statistics, then the normal equations of a ridge
   regression on cosine features that approximate a Gaussian kernel. Each task sums its own matrices; the sums meet in
   two steps, so no task receives more than about the square root of their number.
3. A part of the labelled documents, left out of step 2, gives scores binned by value; pool-adjacent-violators over the
   bins makes the score a probability.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyweave.llm.shared import crc_fold, stored, table_batch, text_bytes

STATISTICS = ("words", "mean_word", "different", "top_word", "repeated", "upper", "digits", "symbols", "odd_endings",
              "alone", "lines", "line_words", "line_repeats", "high_bytes")
FEATURES = 256
WIDTH = 2.5
RIDGE = 1e-3
BINS = 200
THRESHOLD = 0.5
SUMS = 16

_CLASS = np.zeros(256, dtype=np.int64)
for _i in range(256):
    _c = chr(_i)
    _CLASS[_i] = (0 if _i in (32, 9, 10, 11, 12, 13) else 1 if "a" <= _c <= "z" else 2 if "A" <= _c <= "Z" else 3 if "0" <= _c <= "9"
                  else 5 if _i >= 128 else 6 if _c in ".,;:'\"-()?" else 4)
#: A run of unusual signs at the end of a word; tried once a run, however long.
_ODD = re.compile(rb"(?<![^\w\s.,;:'\"()?\x80-\xff-])[^\w\s.,;:'\"()?\x80-\xff-]++(?=[\s.,]|$)")


def statistics(text: bytes) -> tuple[float, ...]:
    """Statistics of a text in UTF-8, in the order of ``STATISTICS``; all zero for an empty one."""
    words = text.split()
    if not words:
        return (0.0,) * len(STATISTICS)
    classes = np.bincount(_CLASS[np.frombuffer(text, dtype=np.uint8)], minlength=7)
    letters, solid, n = max(1, classes[1] + classes[2] + classes[5]), max(1, len(text) - classes[0]), len(words)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    neighbours = sum(map(bytes.__eq__, words[1:], words)) if n > 1 else 0
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (np.log1p(n), solid / n / 10, np.log1p(len(counts)) / np.log1p(n), max(counts.values()) / n, neighbours / n,
            classes[2] / letters, classes[3] / solid, 5 * classes[4] / solid, len(_ODD.findall(text)) / n,
            sum(counts.get(c, 0) for c in (b"|", b"-", b"*", b"#", b"/", b"=")) / n,
            np.log1p(len(lines)), np.log1p(n / len(lines)), 1 - len(set(lines)) / len(lines), classes[5] / solid)


_SCHEMA = "doc_id long, held_out boolean, stats array<double>"


def _measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("stats", pa.list_(pa.float64()))])
    for batch in batches:
        rows = [(doc, held, statistics(text)) for doc, held, text in
                zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held_out", "content")))]
        if rows:
            yield table_batch(rows, schema)


def measured(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out and statistics of every row of ``docs``."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"),
                       text_bytes().alias("content")).mapInArrow(_measure, _SCHEMA)


class Kernel:
    """Cosine features of scaled statistics; directions are fixed by the seed."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.directions = rng.normal(size=(len(STATISTICS), FEATURES)) / WIDTH
        self.shifts = rng.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        waves = np.cos(x @ self.directions + self.shifts) * np.sqrt(2 / FEATURES)
        return np.hstack([waves, np.ones((len(x), 1))])


def _stats(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("stats")
    return np.asarray(column.flatten()).reshape(len(column), len(STATISTICS))


def _summed(rows: DataFrame, of_batch: Callable) -> np.ndarray:
    """Sum over all batches of ``of_batch(batch)``, an array: per task, then per ``SUMS`` groups of tasks, then here."""
    schema = pa.schema([("part", pa.int32()), ("total", pa.binary())])

    def partial(batches):
        total = None
        for batch in batches:
            if len(batch):
                own = of_batch(batch)
                total = own if total is None else total + own
        if total is not None:
            yield table_batch([(TaskContext.get().partitionId() % SUMS, total.tobytes())], schema)

    def merge(key, table):
        total = np.sum([np.frombuffer(b) for b in table.column("total").to_pylist()], axis=0)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "total": pa.array([total.tobytes()], pa.binary())})

    out = rows.mapInArrow(partial, "part int, total binary").groupBy("part").applyInArrow(merge, "part int, total binary")
    got = [np.frombuffer(r.total) for r in out.collect()]
    return np.sum(got, axis=0) if got else np.zeros(0)


class QualityModel:
    """Kernel ridge score through a step-free monotone curve (bin centres to probabilities)."""

    def __init__(self, kernel: Kernel | None, weights: np.ndarray, centres: np.ndarray, heights: np.ndarray):
        self.kernel, self.weights, self.centres, self.heights = kernel, weights, centres, heights

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.kernel(stats) @ self.weights

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        if self.kernel is None:
            return np.full(len(stats), self.heights[0])
        raw = self.raw(stats)
        # the small slope keeps the order of scores within a flat part of the curve
        return np.clip(0.999 * np.interp(raw, self.centres, self.heights) + 0.001 * np.clip(raw, 0, 1), 0, 1)


def pool_adjacent(weights: np.ndarray, means: np.ndarray) -> np.ndarray:
    """Non-decreasing values closest to ``means`` in weighted squares."""
    blocks: list[list[float]] = []
    for w, m in zip(weights, means):
        blocks.append([w, m, 1])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            w2, m2, n2 = blocks.pop()
            w1, m1, n1 = blocks.pop()
            blocks.append([w1 + w2, (w1 * m1 + w2 * m2) / (w1 + w2), n1 + n2])
    return np.concatenate([np.full(int(n), m) for _, m, n in blocks])


def train(stats: DataFrame, labels: DataFrame, label: str = "quality") -> QualityModel:
    """Model from all labelled rows of ``stats`` outside the held-out fold; without labels every score is 0.5, with one
    class only it is that class's smoothed share."""
    marks = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("y")))
    rows = stored(stats.where(~F.col("held_out")).join(marks, "doc_id")
                  .select("stats", (F.col("y") > 0).cast("double").alias("y"),
                          (F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0).alias("calibrates")), "quality-rows")
    n = len(STATISTICS)

    def moments(batch):
        x = _stats(batch)
        return np.concatenate([[len(x), np.sum(np.asarray(batch.column("y")))], x.sum(axis=0), (x * x).sum(axis=0)])

    total = _summed(rows, moments)
    if not len(total):
        return QualityModel(None, np.zeros(0), np.zeros(0), np.array([0.5]))
    if total[1] in (0, total[0]):
        return QualityModel(None, np.zeros(0), np.zeros(0), np.array([(total[1] + 0.5) / (total[0] + 1)]))
    mean = total[2:2 + n] / total[0]
    scale = np.sqrt(np.maximum(total[2 + n:] / total[0] - mean ** 2, 1e-6))
    kernel = Kernel(mean, scale)
    size = FEATURES + 1

    def equations(batch):
        phi, y = kernel(_stats(batch)), np.asarray(batch.column("y"))
        return np.concatenate([(phi.T @ phi).ravel(), phi.T @ y, [len(y)]])

    fitted = _summed(rows.where(~F.col("calibrates")), equations)
    if not len(fitted):
        fitted = _summed(rows, equations)
    gram, moment = fitted[:size * size].reshape(size, size), fitted[size * size:-1]
    weights = np.linalg.solve(gram + RIDGE * fitted[-1] * np.eye(size) / FEATURES, moment)
    edges = np.linspace(-0.5, 1.5, BINS + 1)

    def binned(batch):
        at = np.clip(np.digitize(kernel(_stats(batch)) @ weights, edges) - 1, 0, BINS - 1)
        y = np.asarray(batch.column("y"))
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, y, BINS)]).astype(float)

    counts = _summed(rows.where(F.col("calibrates")), binned)
    if not len(counts):
        counts = _summed(rows, binned)
    filled = counts[:BINS] > 0
    centres = ((edges[:-1] + edges[1:]) / 2)[filled]
    return QualityModel(kernel, weights, centres, pool_adjacent(counts[:BINS][filled], counts[BINS:][filled] / counts[:BINS][filled]))


def scored(stats: DataFrame, model: QualityModel) -> DataFrame:
    """One row per row of ``stats``: doc_id, held_out, score, predicted (1 from ``THRESHOLD`` on)."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches):
        for batch in batches:
            if len(batch):
                score = model(_stats(batch))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score),
                                                  pa.array((score >= THRESHOLD).astype(np.int32))], schema=schema)

    return stats.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def quality_scores(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, label: str = "quality") -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted.

    Labels (doc_id, ``label``) are learned from where ``held_out`` (a Column over ``docs``; none by default) is false; of
    repeated labels the largest counts, null labels and ids are passed over. Null counts as empty text, whose statistics
    are zero; equal texts get equal scores. An empty table gives an empty result. Other columns are not read.
    """
    stats = stored(measured(docs, F.lit(False) if held_out is None else held_out), "quality")
    return scored(stats, train(stats, labels, label))


def held_out(doc_id: Column) -> Column:
    """The fold whose labels are never learned from."""
    return crc_fold(doc_id, 3, 1)
