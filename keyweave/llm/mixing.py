"""Mixing documents to target weights by iterative proportional fitting.

Tokens are summed over cells of source, language and topic; categories without a target of their own are ``other``, so the number of
cells is bounded by the targets, whatever the corpus. The tokens to keep of each cell start in proportion and are raked: one
marginal after the other is scaled to its targets, never above what a cell has, until all hold. A document's probability is
its cell's kept share, and it is kept if a hash of its id, as a number below one, is less: the same on every run. All work on documents
is DataFrame expressions; only the cells come to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyweave.llm.shared import unwrapped, wrapped

OTHER = "other"
DIMENSIONS = ("source", "lang", "topic")


@dataclass(frozen=True)
class Targets:
    """Shares of the kept tokens by category of each dimension; they needn't sum to one. What is in no named category keeps
    its share of the corpus."""

    source: Mapping[str, float] = field(default_factory=dict)
    lang: Mapping[str, float] = field(default_factory=dict)
    topic: Mapping[str, float] = field(default_factory=dict)


def topic_of(text: Column) -> Column:
    """A document's topic by plain signs in its text; the first that holds counts."""
    low = F.lower(text)
    return (F.when(text.isNull() | (F.trim(text) == ""), "empty").when(low.contains("licen"), "legal").when(text.contains("@"), "contact")
            .when(text.contains(" | "), "table").otherwise("prose"))


def token_count(text: Column) -> Column:
    """Runs without ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("long")


def _category(value: Column, named: Mapping[str, float]) -> Column:
    return F.when(value.isin(list(named)), value).otherwise(OTHER) if named else F.lit(OTHER)


def in_cells(docs: DataFrame, targets: Targets, topic: Column) -> DataFrame:
    """Whole rows of ``docs`` with doc_id, text, kw_source, kw_lang, kw_topic (the cell) and kw_tokens."""
    values = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic}
    return wrapped(docs, "doc_id", "text", *[_category(values[d], getattr(targets, d)).alias(f"kw_{d}") for d in DIMENSIONS],
                   token_count(F.col("text")).alias("kw_tokens"))


def _shares(total: dict[str, float], named: Mapping[str, float]) -> dict[str, float]:
    """Target share of each category that has tokens."""
    whole = sum(total.values())
    rest = {c: n / whole for c, n in total.items() if c not in named and n > 0}
    wanted = {c: named[c] for c, n in total.items() if c in named and n > 0}
    scale = (1 - sum(rest.values())) / sum(wanted.values()) if sum(wanted.values()) > 0 else 0.0
    return {**rest, **{c: w * scale for c, w in wanted.items()}}


def _scaled(kept: np.ndarray, most: np.ndarray, goal: float) -> np.ndarray:
    """``kept`` times one factor, no value above ``most``, with the sum ``goal`` or as near as that allows."""
    if most.sum() <= goal:
        return most.copy()
    capped = np.zeros(len(kept), dtype=bool)
    while True:
        free = kept[~capped].sum()
        factor = (goal - most[capped].sum()) / free if free > 0 else 0.0
        over = ~capped & (kept * factor > most)
        if not over.any():
            return np.where(capped, most, kept * factor)
        capped |= over


def rake(tokens: Mapping[tuple[str, str, str], float], targets: Targets, keep: float, rounds: int = 500, tolerance: float = 1e-9) -> dict:
    """Share of its tokens to keep for each cell (source, lang, topic); a cell without tokens keeps the share ``keep``."""
    cells = sorted(c for c, n in tokens.items() if n > 0)
    if not cells:
        return {c: keep for c in tokens}
    have = np.array([tokens[c] for c in cells], dtype=float)
    kept, budget, marginals = have * keep, have.sum() * keep, []
    for i, dimension in enumerate(DIMENSIONS):
        names = np.array([c[i] for c in cells])
        total = {str(n): float(have[names == n].sum()) for n in np.unique(names)}
        marginals.append([(names == c, share * budget) for c, share in sorted(_shares(total, getattr(targets, dimension)).items())])
    for _ in range(rounds):
        before = kept.copy()
        for marginal in marginals:
            for chosen, goal in marginal:
                kept[chosen] = _scaled(kept[chosen], have[chosen], goal)
        if np.abs(kept - before).sum() <= tolerance * budget:
            break
    found = dict(zip(cells, np.minimum(kept / have, 1.0).tolist()))
    return {c: found.get(c, keep) for c in tokens}


def cell_tokens(placed: DataFrame) -> dict[tuple[str, str, str], float]:
    """Tokens of every cell; their number is bounded by the targets."""
    keys = [f"kw_{d}" for d in DIMENSIONS]
    return {tuple(r[k] for k in keys): float(r.n) for r in placed.groupBy(*keys).agg(F.sum("kw_tokens").alias("n")).collect()}


def uniform(doc_id: Column, text: Column, seed: int) -> Column:
    """A number from 0 to below 1 by hash of the id, of the text where there is no id."""
    h = F.xxhash64(F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), text), F.lit("")), F.lit(seed))
    return F.shiftrightunsigned(h, 11) * (2.0 ** -53)


def with_probabilities(docs: DataFrame, targets: Targets, keep: float, topic: Column, seed: int = 1) -> DataFrame:
    """The rows of ``in_cells`` with kw_probability and kw_kept."""
    placed = in_cells(docs, targets, topic)
    shares = rake(cell_tokens(placed), targets, keep)
    keys = [f"kw_{d}" for d in DIMENSIONS]
    schema = T.StructType([*(T.StructField(k, T.StringType()) for k in keys), T.StructField("kw_probability", T.DoubleType())])
    table = placed.sparkSession.createDataFrame([(*c, p) for c, p in sorted(shares.items())], schema)
    joined = placed.join(F.broadcast(table), keys)  # as many rows as there are cells
    return joined.withColumn("kw_kept", uniform(F.col("doc_id"), F.col("text"), seed) < F.col("kw_probability"))


def mixture(docs: DataFrame, targets: Targets, keep: float = 0.5, topic: Column | None = None, seed: int = 1) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source, lang): doc_id, source, lang, topic (the cell), tokens, probability,
    weight (probability in units of the plain share ``keep``), kept.

    ``keep`` is the share of all tokens to keep. A null source, language or topic is ``other``; null or empty texts have no tokens and follow
    their cell. Repeated rows and rows that share an id are kept or dropped together. Targets that the corpus can't fill are met as
    far as it can. An empty table gives an empty result. Other columns are not read.
    """
    rows = docs.select("doc_id", "text", "source", "lang")
    out = with_probabilities(rows, targets, keep, topic_of(F.col("text")) if topic is None else topic, seed)
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(f"kw_{d}").alias(d) for d in DIMENSIONS], F.col("kw_tokens").alias("tokens"),
                      F.col("kw_probability").alias("probability"), (F.col("kw_probability") / F.lit(keep)).alias("weight"), F.col("kw_kept").alias("kept"))


def reached(mixture_rows: DataFrame, targets: Targets) -> DataFrame:
    """What a ``mixture`` comes to, one row per dimension and category that has tokens: dimension, category, tokens, corpus_share, target_share,
    expected_share (by probabilities), kept_share (of what was drawn), capped (all that there is would be kept, so the target may not be met).

    Shares are of tokens, target shares of all categories of a dimension sum to one; no tokens give no rows, nothing drawn gives null shares.
    """
    cells = mixture_rows.select("tokens", "probability", "kept", F.explode(F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d), F.lit(OTHER)).alias("category")) for d in DIMENSIONS])).alias("cell"))
    sums = (cells.groupBy("cell.dimension", "cell.category")
            .agg(F.sum("tokens").alias("tokens"), F.sum(F.col("tokens") * F.col("probability")).alias("expected"),
                 F.sum(F.when(F.col("kept"), F.col("tokens")).otherwise(0)).alias("drawn"),
                 F.min(F.when(F.col("tokens") > 0, F.col("probability"))).alias("least"))
            .where(F.col("tokens") > 0))
    named = [(d, c, float(w)) for d in DIMENSIONS for c, w in getattr(targets, d).items()]
    weights = mixture_rows.sparkSession.createDataFrame(named, "dimension string, category string, weight double")
    whole = Window.partitionBy("dimension")  # as many rows as there are named categories, and one
    share = lambda c: c / F.nullif(F.sum(c).over(whole), F.lit(0).cast("double"))
    placed = sums.join(F.broadcast(weights), ["dimension", "category"], "left").withColumn("corpus_share", share(F.col("tokens").cast("double")))
    rest = F.sum(F.when(F.col("weight").isNull(), F.col("corpus_share")).otherwise(0.0)).over(whole)
    target = F.when(F.col("weight").isNull(), F.col("corpus_share")).otherwise((1 - rest) * share(F.col("weight")))
    return placed.select("dimension", "category", "tokens", "corpus_share", target.alias("target_share"), share(F.col("expected")).alias("expected_share"),
                         share(F.col("drawn").cast("double")).alias("kept_share"), (F.col("least") >= 1.0).alias("capped"))


def mixed(docs: DataFrame, targets: Targets, keep: float = 0.5, topic: Column | None = None, seed: int = 1) -> DataFrame:
    """The kept rows of ``docs``, with its columns, under the rules of ``mixture``."""
    out = with_probabilities(docs, targets, keep, topic_of(F.col("text")) if topic is None else topic, seed)
    return unwrapped(out.where("kw_kept"), docs)
