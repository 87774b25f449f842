"""Helpers of the operators: tables in the cluster's shared folder, folds, bounded worker caches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``; where it is unset (tests,
    local runs) a temporary folder of this machine is set for the session. On a cluster it must be set."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="keyweave-")
        spark.conf.set(CHECKPOINT_DIR, folder)
    return folder.rstrip("/")


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back: cuts the lineage and
    survives lost executors. Files stay until the shared folder is cleaned."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ROW = "kw_row"


def wrapped(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """``columns`` of ``docs``, and its whole rows as a struct, so that no column of it can clash with a working one."""
    return docs.select(*columns, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW))


def unwrapped(df: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The rows of ``wrapped``, with the columns of ``docs``, some of them changed."""
    return df.select(*[changed[c].alias(c) if c in changed else F.col(ROW).getField(c).alias(c) for c in docs.columns],
                     *[v.alias(c) for c, v in changed.items() if c not in docs.columns])


def crc_fold(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32(doc_id as text) mod ``modulus`` is ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(False))


def text_bytes(name: str = "text") -> Column:
    """Text as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def map_rows(df: DataFrame, make: Callable[[], Callable], schema: str) -> DataFrame:
    """``make()`` runs once a task and gives a function from an Arrow batch to rows (tuples)."""
    fields = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(fields)
        step = make()
        for batch in batches:
            rows = step(batch)
            if rows:
                yield table_batch(rows, target)

    return df.mapInArrow(run, schema)


def table_batch(rows: list, target: pa.Schema) -> pa.RecordBatch:
    """Arrow batch of a list of tuples."""
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), target)], schema=target)


def slices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices whose ``column`` (text or bytes) has at most ``size`` bytes, one row at least."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(batch):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def lower_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of the texts of a batch, A-Z lower-cased, cut at ASCII white space: the different words, the number of each
    word in order, and where each text begins (one more entry at the end)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    cuts = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy()
    empty = pc.index(coded.dictionary, "").as_py()
    if empty >= 0:  # before leading and after trailing white space
        full = codes != empty
        cuts = np.concatenate([[0], np.cumsum(full)])[cuts]
        codes = codes[full]
    return coded.dictionary, codes, cuts


def runs_by_key(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, from batches that are sorted by the keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(len(batch), dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        change[0] = bool(held) and any(held[-1].column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in keys)
        start = 0
        for at in np.flatnonzero(change).tolist():
            if at > start:
                held.append(batch.slice(start, at - start))
            if held:
                yield pa.Table.from_batches(held)
            held, start = [], at
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)
