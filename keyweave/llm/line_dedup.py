"""Recurring lines across documents, found by a log-template tree of fixed depth.

A line's tokens are masked where they are variable by look (``VARIABLE``: numbers, dates, hexadecimal, addresses). The tree's path is the
number of tokens, then the leading ``DEPTH`` tokens; its leaf holds lines that may share a template. Below it, lines are
compared by position: a line is cut into at most ``CHUNKS`` pieces (single tokens in a short line), and a template fixes a pair
of pieces and generalises the others, as long as most tokens agree. It recurs if lines of it are in enough documents.
Lines of too few tokens for a template, a passage in a script without spaces among them, are compared as wholes.

Python only hashes the lines of a document; counting, templates and editing are DataFrame operations. Equal lines are
counted before they are exchanged, so a line that a third of all documents share costs one row per task.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyweave.llm.shared import ROW, stored, text_bytes, unwrapped, wrapped

DEPTH = 3
CHUNKS = 8
VARIABLE = re.compile(rb"[0-9@]|://")
_FIELDS = [("doc_id", pa.int64()), ("text_key", pa.int64()), ("line", pa.int32()), ("tokens", pa.int32()), ("first", pa.bool_()), ("leaf", pa.int64()),
           ("pieces", pa.list_(pa.int32())), ("constants", pa.list_(pa.int32()))]


@dataclass(frozen=True)
class Rule:
    """When a template recurs: in ``min_docs`` documents if it has at least ``long_tokens`` tokens, else in
    ``min_docs_short``; ``constant`` is the least share of constant tokens, masked ones not counted. A line with fewer constant tokens
    than that recurs only as it is, unmasked. So does a line of fewer than ``min_tokens`` tokens: as a long one if it has at
    least ``long_bytes`` bytes, otherwise in a share of ``min_share`` of all rows (and in ``min_docs_short`` documents), since by chance
    alone a word or two recur in ever more documents of a growing corpus."""

    min_docs: int = 2
    long_tokens: int = 10
    min_docs_short: int = 5
    min_tokens: int = 3
    constant: float = 0.7
    long_bytes: int = 64
    min_share: float = 0.01

    def bare_docs(self, rows: int) -> int:
        """Documents that a line of fewer than ``min_tokens`` tokens has to be in, of a table with so many rows."""
        return max(self.min_docs_short, math.ceil(self.min_share * rows))


def _signed32(value: int) -> int:
    return (value & 0xFFFFFFFF) - (1 << 31)


def line_keys(line: bytes, rule: Rule = Rule()) -> tuple | None:
    """(number of tokens, leaf, hashes of the pieces, constant tokens of each piece) of a line, None for a blank one. The last is
    None if no token is masked. A line with too few tokens, or too few constant ones, for a template is one piece, its
    unmasked tokens; one of few tokens and many bytes counts as ``long_tokens`` of them."""
    tokens = line.split()
    n = len(tokens)
    if n < rule.min_tokens:
        if not n:
            return None
        whole = b" ".join(tokens)
        size = rule.long_tokens if len(whole) >= rule.long_bytes else n
        return size, xxhash.xxh3_64_intdigest(whole, n) - (1 << 63), [_signed32(xxhash.xxh3_64_intdigest(whole))], [size]
    masked = None
    if VARIABLE.search(line):
        masked = [VARIABLE.search(t) is not None for t in tokens]
        if n - sum(masked) < rule.constant * n:
            whole = b" ".join(tokens)
            return n, xxhash.xxh3_64_intdigest(whole, n) - (1 << 63), [_signed32(xxhash.xxh3_64_intdigest(whole))], [n]
        tokens = [b"<*>" if v else t for t, v in zip(tokens, masked)]
    leaf = xxhash.xxh3_64_intdigest(b" ".join(tokens[:DEPTH]), n) - (1 << 63)
    m = min(n, CHUNKS)
    cuts = [i * n // m for i in range(m + 1)]
    pieces = [_signed32(xxhash.xxh3_64_intdigest(b" ".join(tokens[a:b]))) for a, b in zip(cuts, cuts[1:])]
    return n, leaf, pieces, masked and [b - a - sum(masked[a:b]) for a, b in zip(cuts, cuts[1:])]


def _parse(rule: Rule):
    schema = pa.schema(_FIELDS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[] for _ in _FIELDS]
        for batch in batches:
            for doc, key, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_key", "content"))):
                seen = set()
                for i, line in enumerate(text.split(b"\n")):
                    keys = line_keys(line, rule)
                    if keys is not None:
                        whole = (keys[1], *keys[2])
                        for column, value in zip(columns, (doc, key, i, keys[0], whole not in seen, *keys[1:])):
                            column.append(value)
                        seen.add(whole)
                if len(columns[0]) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)
                    columns = [[] for _ in _FIELDS]
        if columns[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _enough(docs: Column, tokens: Column, rule: Rule, rows: int) -> Column:
    return docs >= (F.when(tokens >= rule.long_tokens, rule.min_docs).when(tokens >= rule.min_tokens, rule.min_docs_short)
                    .otherwise(rule.bare_docs(rows)))


def _row_key() -> tuple[Column, Column]:
    """doc_id (the least long for null) and a hash of the text: rows with the same id and different texts are edited each by itself."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))), F.xxhash64("text")


def parsed_lines(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, text_key, line, tokens, first (of its pieces in the row), leaf, pieces, constants."""
    doc_id, text_key = _row_key()
    rows = docs.select(doc_id.alias("doc_id"), text_key.alias("text_key"), text_bytes().alias("content"))
    return rows.mapInArrow(_parse(rule),
                           "doc_id long, text_key long, line int, tokens int, first boolean, leaf long, pieces array<int>, constants array<int>")


def _alike(a: Column, b: Column, tokens: Column, constants: Column) -> Column:
    """Constant tokens of a line that lie in pieces equal at the same place in another line of the leaf."""
    m = F.size(a)
    width = lambda i: F.coalesce(F.get(constants, i).cast("long"), F.floor((i + 1) * tokens / m) - F.floor(i * tokens / m))
    same = F.zip_with(F.zip_with(a, b, lambda x, y: x == y), F.sequence(F.lit(0), m - 1), lambda e, i: F.when(e, width(i)).otherwise(F.lit(0)))
    return F.aggregate(same, F.lit(0).cast("long"), lambda total, x: total + x)


def templates(lines: DataFrame, rule: Rule, rows: int) -> DataFrame:
    """Recurring lines of a table of ``rows`` rows: leaf, pieces, keeper (doc_id, line and text_key of the first line of their template).

    A template is a leaf with two neighbouring pieces fixed, the others general; its first line in the order of
    doc_id, line stands for it. A line belongs to it if enough of its tokens are as in that first line. Two lines
    that differ in no more than the tolerated pieces always share such a pair. Equal lines in enough documents recur whatever lines come first in their pairs. A
    document counts once for a template, however many variants it has: where the sum over variants doesn't decide, documents are counted from the
    lines, few of them, as none of the variants is in enough documents. All steps are linear in the number of different lines.
    """
    kinds = lines.groupBy("leaf", "pieces").agg(
        F.first("tokens").alias("tokens"), F.min("constants").alias("constants"), F.sum(F.col("first").cast("long")).alias("docs"), F.min("doc_id").alias("low"),
        F.max("doc_id").alias("high"), F.min(F.struct("doc_id", "line", "text_key")).alias("first"))
    kinds = stored(kinds, "line-kinds")
    leaves = (kinds.groupBy("leaf").agg(F.min("low").alias("leaf_low"), F.max("high").alias("leaf_high"))
              .where(F.col("leaf_low") < F.col("leaf_high")).select("leaf"))
    m = F.size("pieces")
    starts = F.sequence(F.lit(0), m - 1, F.lit(2))
    pairs = stored(kinds.join(leaves, "leaf").withColumn("at", F.explode(starts))
                   .withColumn("pair", F.slice("pieces", F.col("at") + 1, 2)), "line-pairs")
    heads = (pairs.groupBy("leaf", "at", "pair").agg(F.min(F.struct("first", "pieces")).alias("head"))
             .select("leaf", "at", "pair", F.col("head.first").alias("keeper"), F.col("head.pieces").alias("head")))
    members = stored(pairs.join(heads, ["leaf", "at", "pair"])
                     .where(_alike(F.col("pieces"), F.col("head"), F.col("tokens"), F.col("constants")) >= rule.constant * F.col("tokens"))
                     .drop("head"), "line-members")
    found = stored(members.groupBy("leaf", "at", "pair").agg(F.first("tokens").alias("t"), F.sum("docs").alias("n"), F.max("docs").alias("most"),
                                                             F.min("low").alias("l"), F.max("high").alias("h"))
                   .where(_enough(F.col("n"), F.col("t"), rule, rows) & (F.col("l") < F.col("h"))), "line-candidates")
    # the sum counts a document once for each variant that it has: it is right if one variant is in enough, or if two documents are
    sure = _enough(F.col("most"), F.col("t"), rule, rows) | _enough(F.lit(2), F.col("t"), rule, rows)
    doubtful = (members.join(found.where(~sure).select("leaf", "at", "pair", "t"), ["leaf", "at", "pair"])
                .select("leaf", F.xxhash64("pieces").alias("kind"), "at", "pair", "t"))
    distinct = (lines.where("first").select("doc_id", "leaf", F.xxhash64("pieces").alias("kind")).join(doubtful, ["leaf", "kind"])
                .groupBy("leaf", "at", "pair", "t", "doc_id").agg(F.lit(1).alias("one")).groupBy("leaf", "at", "pair", "t").agg(F.count("*").alias("n"))
                .where(_enough(F.col("n"), F.col("t"), rule, rows)))
    recurs = found.where(sure).select("leaf", "at", "pair").unionByName(distinct.select("leaf", "at", "pair"))
    own = (kinds.where(_enough(F.col("docs"), F.col("tokens"), rule, rows) & (F.col("low") < F.col("high")))
           .select("leaf", "pieces", F.col("first").alias("keeper")))
    by_head = members.join(recurs, ["leaf", "at", "pair"]).select("leaf", "pieces", "keeper")
    return by_head.unionByName(own).groupBy("leaf", "pieces").agg(F.min("keeper").alias("keeper"))


def recurring_lines(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Lines to drop, one row per doc_id and text: kw_id (doc_id, the least long for null), kw_text (hash of the text), kw_lines (numbers, from 0)."""
    lines = stored(parsed_lines(docs, rule), "lines")
    # a written table, so that the join reads two plain exchanges and a line that very many documents have is split over tasks
    found = stored(templates(lines, rule, docs.count()), "line-templates")
    drop = (lines.join(found, ["leaf", "pieces"])
            .where(F.col("keeper") != F.struct("doc_id", "line", "text_key")))
    return drop.groupBy(F.col("doc_id").alias("kw_id"), F.col("text_key").alias("kw_text")).agg(F.array_sort(F.collect_set("line")).alias("kw_lines"))


def drop_recurring_lines(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``docs`` (doc_id, text, and any other columns) without recurring lines, with n_lines_dropped added.

    Of a template's lines the first in the document with the least doc_id stays, so nothing is lost altogether; all others go, with their
    line ends. Rows stay, a document may end up empty. A null text stays null, a text without recurring lines is unchanged to the byte.
    Rows that share a doc_id are one document (a null id is one too): a line in both doesn't recur by that; each loses its own lines only. An empty
    table gives an empty result; a column named n_lines_dropped is replaced, ``n_chars``, where there is one, is renewed for changed texts.
    """
    doc_id, text_key = _row_key()
    rows = wrapped(docs, "text", doc_id.alias("kw_key"), text_key.alias("kw_text_key"))
    joined = rows.join(recurring_lines(docs, rule), (F.col("kw_key") == F.col("kw_id")) & (F.col("kw_text_key") == F.col("kw_text")), "left")
    kept = F.array_join(F.filter(F.split(F.col("text"), "\n", -1), lambda x, i: ~F.array_contains(F.col("kw_lines"), i)), "\n")
    edited = F.col("kw_lines").isNotNull() & F.col("text").isNotNull()
    new = {"text": F.when(edited, kept).otherwise(F.col("text")), "n_lines_dropped": F.when(edited, F.size("kw_lines")).otherwise(0).cast("long")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(edited, F.length(kept).cast(kind)).otherwise(F.col(ROW).getField("n_chars"))
    return unwrapped(joined, docs, **new)
