"""Toxicity classifier that is held to the same score when identity terms are swapped.

Features of a text are its different words and word beginnings (runs of letters, lower case). From a bounded sample of
labelled texts the features that tell the classes apart are kept; a logistic regression over them is trained with an added
penalty on the squared change of the logit between a sentence and its counterfactual, where identity terms are swapped
within their group, so that the mention of a group by itself moves no score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyweave.llm.shared import crc_fold, map_rows, stored

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)
#: Terms that are exchanged for one another; a swap takes the next term of the row.
IDENTITY_TERMS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("women", "men"), ("woman", "man"), ("female", "male"), ("girls", "boys"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrant", "citizen", "refugee"), ("immigrants", "citizens", "refugees"),
    ("frauen", "männer"), ("femmes", "hommes"), ("mujeres", "hombres"),
    ("muslime", "christen", "juden"), ("musulmans", "chrétiens", "juifs"), ("musulmanes", "cristianos", "judíos"),
)
THRESHOLD = 0.3
SAMPLE_ROWS = 12_000
MAX_FEATURES = 4096
MIN_TEXTS = 4
MIN_Z = 5.0


def word_features(word: str) -> tuple[str, ...]:
    """The word, and its beginnings marked with ``^``."""
    return (word, *("^" + word[:n] for n in PREFIXES if len(word) > n))


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def features_of(words: Iterable[str]) -> set[str]:
    return {f for w in words for f in word_features(w)}


def swaps(groups: Iterable[Sequence[str]]) -> dict[str, str]:
    """The term that each term of the groups is exchanged for; a group of one has none."""
    return {term: group[(i + 1) % len(group)] for group in groups if len(group) > 1 for i, term in enumerate(group)}


def swapped(words: set[str], swap: Mapping[str, str]) -> set[str]:
    """The counterfactual words of a text."""
    return {swap.get(w, w) for w in words}


def training_rows(docs: DataFrame, labels: DataFrame, label: str, learn_from: Column, sample: int) -> DataFrame:
    """(text, y) of at most ``sample`` labelled documents, chosen by a hash of the id; one row per id. The ids are few
    by that bound, so they are broadcast and no text is shuffled."""
    chosen = (labels.where(learn_from & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
              .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).select("text", "y")


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each class that have a feature, over the task's rows; handed on whenever many features are held."""
    seen: tuple[Counter, Counter] = (Counter(), Counter())

    def out():
        names = list(seen[0].keys() | seen[1].keys())
        for i in range(0, len(names), 50_000):
            some = names[i:i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([seen[0][f] for f in some], pa.int64()),
                                              pa.array([seen[1][f] for f in some], pa.int64())], names=["feature", "n0", "n1"])
        for counts in seen:
            counts.clear()

    for batch in batches:
        for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
            seen[int(y > 0)].update(features_of(words_of(text)))
        if len(seen[0]) + len(seen[1]) > 1_000_000:
            yield from out()
    yield from out()


def select_features(rows: DataFrame, n_texts: tuple[int, int], limit: int) -> list[str]:
    """The features whose shares in the two classes differ most, by a two-proportion z-score."""
    n0, n1 = (float(max(n, 1)) for n in n_texts)
    pooled = (F.col("n0") + F.col("n1") + 1) / (n0 + n1 + 2)
    z = F.abs(F.col("n1") / n1 - F.col("n0") / n0) / F.sqrt(pooled * (1 - pooled) * (1 / n0 + 1 / n1))
    counted = (rows.mapInArrow(_count, "feature string, n0 long, n1 long")
               .groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
               .where(F.col("n0") + F.col("n1") >= MIN_TEXTS).withColumn("z", z).where(F.col("z") > MIN_Z))
    return [r.feature for r in counted.orderBy(F.desc("z"), "feature").limit(limit).select("feature").collect()]


def _indexed(names: list[str], swap: Mapping[str, str]) -> Callable:
    def make():
        at = {f: i for i, f in enumerate(names)}

        def step(batch: pa.RecordBatch) -> list[tuple]:
            rows = []
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                words = words_of(text)
                other = swapped(words, swap)
                found = sorted(at[f] for f in features_of(words) if f in at)
                twin = found if other == words else sorted(at[f] for f in features_of(other) if f in at)
                rows.append((int(y > 0), found, twin))
            return rows

        return step

    return make


class Classifier:
    """Logistic regression over named features."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias

    def word_scorer(self) -> Callable[[set[str]], float]:
        """Function from the different words of a text to its score."""
        weights, bias = self.weights, self.bias
        stems = {f[1:1 + PREFIXES[0]] for f in weights if f[0] == "^"}

        def score(words: set[str]) -> float:
            found = {w for w in words if w in weights}
            for w in words:
                if w[:PREFIXES[0]] in stems:
                    found.update(f for f in word_features(w)[1:] if f in weights)
            z = bias + sum(weights[f] for f in sorted(found))
            return float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0))))

        return score

    def scorer(self) -> Callable[[str], float]:
        score = self.word_scorer()
        return lambda text: score(words_of(text))


def fit(rows: list, names: list[str], steps: int = 400, rate: float = 0.05, ridge: float = 0.02, counterfactual: float = 1.0) -> Classifier:
    """Full-batch Adam from zero on rows (y, features, features of the counterfactual)."""
    y = np.array([r[0] for r in rows], dtype=float)
    if not names or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.0
        return Classifier({}, float(np.log(share / (1 - share))) if len(y) else -30.0)

    def sparse(column):
        counts = [len(r[column]) for r in rows]
        return np.repeat(np.arange(len(rows)), counts), np.fromiter((i for r in rows for i in r[column]), dtype=np.int64, count=sum(counts))

    row, col = sparse(1)
    row2, col2 = sparse(2)
    changed = np.array([list(r[1]) != list(r[2]) for r in rows])
    w, b = np.zeros(len(names)), np.log(y.mean() / (1 - y.mean()))
    mean, square = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for step in range(1, steps + 1):
        z = b + np.bincount(row, w[col], len(y))
        error = (1 / (1 + np.exp(-z)) - y) / len(y)
        gap = np.where(changed, z - b - np.bincount(row2, w[col2], len(y)), 0.0) * (2 * counterfactual / max(1, changed.sum()))
        g = np.bincount(col, (error + gap)[row], len(w)) - np.bincount(col2, gap[row2], len(w)) + ridge * w / len(y)
        g = np.append(g, error.sum())
        mean = 0.9 * mean + 0.1 * g
        square = 0.999 * square + 0.001 * g * g
        delta = rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-9)
        w, b = w - delta[:-1], b - delta[-1]
    return Classifier({f: float(v) for f, v in zip(names, w)}, float(b))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", learn_from: Column | None = None,
          sample: int = SAMPLE_ROWS, counterfactual: float = 1.0, groups: Iterable[Sequence[str]] = IDENTITY_TERMS,
          max_features: int = MAX_FEATURES) -> Classifier:
    """Classifier of ``label`` (1 or not) from at most ``sample`` labelled documents where ``learn_from`` holds, over at most
    ``max_features`` features. ``groups`` are the identity terms (single lower-case words) that are swapped within their group, and
    ``counterfactual`` the weight of the penalty on what that changes. Without labels, or with one class only, every text gets the same score."""
    rows = stored(training_rows(docs, labels, label, F.lit(True) if learn_from is None else learn_from, sample), "toxicity-sample")
    sizes = {r.y: r.n for r in rows.groupBy((F.col("y") > 0).cast("int").alias("y")).agg(F.count("*").alias("n")).collect()}
    names = select_features(rows, (sizes.get(0, 0), sizes.get(1, 0)), max_features) if len(sizes) == 2 else []
    data = map_rows(rows, _indexed(names, swaps(groups)), "y int, found array<int>, twin array<int>").collect()
    return fit(sorted(map(tuple, data)), names, counterfactual=counterfactual)


def _scores(classifier: Classifier) -> Callable:
    def make():
        score = classifier.scorer()

        def step(batch: pa.RecordBatch) -> list[tuple]:
            return [(doc, held, s, int(s >= THRESHOLD)) for doc, held, s in
                    zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), map(score, batch.column("text").to_pylist()))]

        return step

    return make


def scored(docs: DataFrame, classifier: Classifier, held_out: Column) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score (0 to 1), predicted (1 from ``THRESHOLD`` on).

    Null counts as empty; an empty text gets the score of a text without any feature. Equal texts get equal scores.
    An empty table gives an empty result. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return map_rows(rows, _scores(classifier), "doc_id long, held_out boolean, score double, predicted int")


def _gaps(classifier: Classifier, swap: Mapping[str, str]) -> Callable:
    def make():
        score = classifier.word_scorer()

        def step(batch: pa.RecordBatch) -> list[tuple]:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text)
                terms = sorted(w for w in words if w in swap)
                if terms:
                    own, other = score(words), score(swapped(words, swap))
                    rows.append((doc, terms, own, other, abs(own - other), (own >= THRESHOLD) != (other >= THRESHOLD)))
            return rows

        return step

    return make


def swap_gaps(docs: DataFrame, classifier: Classifier, groups: Iterable[Sequence[str]] = IDENTITY_TERMS) -> DataFrame:
    """How far a swap of identity terms moves scores: one row per row of ``docs`` (doc_id, text) that holds a term: doc_id, terms, score,
    swapped_score, gap (their distance), flipped (whether the decision changes).

    A null, empty or term-free text gives no row, an empty table an empty result. Repeated rows count each. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return map_rows(rows, _gaps(classifier, swaps(groups)), "doc_id long, terms array<string>, score double, swapped_score double, gap double, flipped boolean")


def is_toxic(classifier: Classifier) -> Callable[[Column], Column]:
    """Column function of a text column: whether the score reaches ``THRESHOLD``; null counts as empty."""
    @F.pandas_udf("boolean")
    def toxic(texts: pd.Series) -> pd.Series:
        score = classifier.scorer()
        return texts.fillna("").map(lambda t: score(t) >= THRESHOLD).astype(bool)

    return toxic


def held_out(doc_id: Column) -> Column:
    """The fold whose labels are never learned from."""
    return crc_fold(doc_id, 4, 2)
