"""Near-duplicate vectors by p-stable hashing of unit vectors and exact cosines.

1. Vectors with the same components are one class, compared once and counted as often as they occur.
2. Every class is hashed in several tables. A table's key joins ``floor((a . v + b) / WIDTH)`` of several Gaussian directions; how many
   directions and tables there are follows from the number of vectors (``plan``), so that a pair at the threshold is missed by all tables with
   chance ``MISS`` at most while unrelated pairs rarely meet.
3. Classes that share a key are compared exactly, in blocks of at most ``BLOCK`` by ``BLOCK``: a larger bucket is cut into blocks,
   dealt out pair by pair of blocks. A pair that meets in several tables counts in the first. A block hands on sums and a forest
   of its links, never its pairs, so what is exchanged is linear in the size of a bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyweave.llm.components import components
from keyweave.llm.shared import runs_by_key, stored, table_batch

WIDTH = 2.0
MISS = 1e-3
MEETINGS = 0.1
BLOCK = 1000


def _same_cell(distance: float) -> float:
    """Chance that two points at this distance fall in the same cell of one direction."""
    r = WIDTH / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(n: int, cosine: float) -> tuple[int, int]:
    """(directions a table, tables): a vector meets about ``MEETINGS`` orthogonal ones in a table, and a pair at ``cosine`` is missed
    by all tables with chance ``MISS``."""
    near, far = _same_cell(math.sqrt(2 - 2 * cosine)), _same_cell(math.sqrt(2))
    directions = max(1, math.ceil(math.log(max(n, 2) / MEETINGS) / -math.log(far)))
    return directions, math.ceil(math.log(1 / MISS) / -math.log1p(-near ** directions))


def _usable(vector) -> np.ndarray | None:
    if vector is None or any(x is None for x in vector):
        return None
    out = np.asarray(vector, dtype=np.float64)
    with np.errstate(over="ignore"):
        return out if len(out) and np.isfinite(out).all() and 0 < float(out @ out) < np.inf else None


_HASHED = pa.schema([("vec_id", pa.int64()), ("class", pa.binary()), ("vector", pa.binary())])


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for vec, vector in zip(batch.column("vec_id").to_pylist(), batch.column("vector").to_pylist()):
            own = None if vec is None else _usable(vector)
            raw = None if own is None else (own + 0.0).tobytes()  # minus zero as zero
            rows.append((vec, None if raw is None else xxhash.xxh3_128_digest(raw), raw))
        if rows:
            yield table_batch(rows, _HASHED)


def _keys(directions: int, tables: int, seed: int):
    schema = pa.schema([("rep", pa.int64()), ("size", pa.int64()), ("vector", pa.binary()), ("keys", pa.list_(pa.int32()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, tuple] = {}
        for batch in batches:
            rows = []
            for rep, size, raw in zip(*(batch.column(c).to_pylist() for c in ("rep", "size", "vector"))):
                vector = np.frombuffer(raw)
                dim = len(vector)
                if dim not in drawn:
                    rng = np.random.default_rng([seed, dim])
                    drawn[dim] = rng.normal(size=(dim, directions * tables)), rng.uniform(0, WIDTH, directions * tables)
                a, b = drawn[dim]
                cells = np.floor((vector / np.sqrt(vector @ vector) @ a + b) / WIDTH).astype(np.int32).reshape(tables, directions)
                rows.append((rep, size, raw, [xxhash.xxh32_intdigest(c.tobytes(), dim) - (1 << 31) for c in cells]))
            if rows:
                yield table_batch(rows, schema)

    return run


def _forest(rows: np.ndarray, cols: np.ndarray, n: int) -> np.ndarray:
    """Least member that each of n members is linked with, over the given links, directly or not."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, rows, root[cols])
        np.minimum.at(new, cols, root[rows])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(keys: list[str], cosine: float):
    schema = pa.schema([("rep", pa.int64()), ("n", pa.int64()), ("root", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for table in runs_by_key(batches, keys):
            if len(table) < 2:
                continue
            order = np.argsort(table.column("rep").to_numpy(), kind="stable")
            rep = table.column("rep").to_numpy()[order]
            size, block = table.column("size").to_numpy()[order], table.column("block").to_numpy()[order]
            at, i, j = (table.column(c)[0].as_py() for c in ("at", "i", "j"))
            raw = table.column("vector").to_pylist()
            dims = np.array([len(raw[k]) for k in order])
            if (dims != dims[0]).any():  # keys of vectors of other lengths may coincide
                parts = [np.flatnonzero(dims == d) for d in np.unique(dims)]
            else:
                parts = [np.arange(len(rep))]
            codes = np.array(table.column("keys").combine_chunks().flatten()).reshape(len(rep), -1)[order]
            for part in parts:
                x = np.frombuffer(b"".join(raw[order[k]] for k in part)).reshape(len(part), -1)
                norm = np.sqrt(np.einsum("ij,ij->i", x, x))
                linked = x @ x.T / norm[:, None] / norm >= cosine
                linked &= np.arange(len(part))[:, None] < np.arange(len(part))
                if i != j:
                    linked &= block[part][:, None] != block[part]
                r, c = np.nonzero(linked)
                if not len(r):
                    continue
                counts = np.zeros(len(part), dtype=np.int64)
                for k in range(0, len(r), 200_000):
                    a, b = r[k:k + 200_000], c[k:k + 200_000]
                    first = ~(codes[part[a], :at] == codes[part[b], :at]).any(axis=1)
                    np.add.at(counts, a[first], size[part[b[first]]])
                    np.add.at(counts, b[first], size[part[a[first]]])
                root = _forest(r, c, len(part))
                touched = np.flatnonzero((counts > 0) | (root != np.arange(len(part))))
                out += zip(rep[part[touched]].tolist(), counts[touched].tolist(), rep[part[root[touched]]].tolist())
            if len(out) > 20_000:
                yield table_batch(out, schema)
                out = []
        if out:
            yield table_batch(out, schema)

    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.95, id_column: str = "vec_id", vector_column: str = "embedding", seed: int = 5) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links (other vectors with at least this cosine, in double precision), component_id (least id
    reachable by links, itself included), kept (is it the row's own id).

    A vector that is null, empty, zero, or has null or non-finite components is linked with nothing, as is one without an id
    (component_id null, kept). Only vectors of equal length are compared. Repeated rows count as vectors of their own. All links
    confirmed are exact; a link at the threshold is missed with chance ``MISS``, a closer one much less likely. An empty table
    gives an empty result. Other columns are not read.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))
    hashed = stored(rows.mapInArrow(_read, "vec_id long, class binary, vector binary"), "vectors")
    classes = stored(hashed.where(F.col("class").isNotNull()).groupBy("class").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("size"), F.first("vector").alias("vector")), "vector-classes")
    directions, tables = plan(classes.count(), cosine)
    keyed = stored(classes.select("rep", "size", "vector").mapInArrow(_keys(directions, tables, seed), "rep long, size long, vector binary, keys array<int>"),
                   "vector-keys")
    entries = keyed.select("rep", F.posexplode("keys").alias("at", "key"))
    buckets = stored(entries.groupBy("at", "key").agg(F.count("*").alias("members")).where(F.col("members") > 1), "vector-buckets")
    n_blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep", "at"), n_blocks).cast("int")
    placed = (entries.join(buckets, ["at", "key"]).withColumn("block", own)
              .withColumn("other", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
              .select("rep", "at", "key", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))
    keys = ["at", "key", "i", "j"]
    tasks = stored(placed, "vector-places").join(keyed, "rep")
    found = stored(tasks.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
                   .mapInArrow(_compare(keys, cosine), "rep long, n long, root long"), "vector-links")
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    facts = (classes.select("class", "rep", "size").join(counts, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
             .select("class", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component")))
    out = hashed.select("vec_id", "class").join(facts, "class", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
