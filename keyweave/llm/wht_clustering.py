"""Lloyd clustering in whole numbers, with nearest centroids found by progressive search over Walsh-Hadamard coefficients.

Vectors and centroids are turned once by the unnormalised Walsh-Hadamard transform, which keeps whole numbers whole and multiplies every squared distance
by the number of components. Coefficients are compared from coarse to fine: sums of squared differences only grow, so a centroid whose sum
so far exceeds the full distance of another is strictly worse and is dropped; what stays is summed over all coefficients. Equal distances go to the centroid of
the smaller number, and no drop can touch a tie.

Vectors are written once with their coefficients. A round reads them and hands on, for each task, sums and counts of its clusters: its size
follows from the number of centroids, not of vectors. The transform is linear, so sums of coefficients give the sums of components back.

Numbers below ``NARROW`` are computed in 64 bits; tables that hold larger ones in Python's whole numbers, exactly and slowly.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyweave.llm.shared import stored

DIM = 64
SCALE = 1024
#: Components up to this size: 64 times a squared distance is below 64 * 64 * (2 * NARROW) ** 2 = 2 ** 62.
NARROW = 1 << 24
#: Coefficients summed in each step of the search.
STEPS = (0, 4, 8, 16, 32, DIM)
LIMB = 31


def hadamard(size: int = DIM) -> np.ndarray:
    """Walsh-Hadamard matrix with rows ordered from the fewest sign changes to the most."""
    h = np.ones((1, 1), dtype=np.int64)
    while len(h) < size:
        h = np.block([[h, h], [h, -h]])
    return h[np.argsort((np.diff(h, axis=1) != 0).sum(axis=1), kind="stable")]


def transformed(whole: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Coefficients of rows of whole numbers: exact in doubles while these are narrow."""
    if whole.dtype == object:
        return whole @ matrix.T.astype(object)
    return (whole.astype(np.float64) @ matrix.T.astype(np.float64)).astype(np.int64)


def nearest(coefficients: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each vector the number of its nearest centroid, the smaller one of equals, and their squared distance (both given by coefficients)."""
    n, k = len(coefficients), len(centroids)
    kind = coefficients.dtype
    sums = np.zeros((n, k), dtype=kind)
    rows, cols = (x.ravel() for x in np.indices((n, k)))
    least = None
    for low, high in zip(STEPS, STEPS[1:]):
        sums[rows, cols] += ((coefficients[rows, low:high] - centroids[cols, low:high]) ** 2).sum(axis=1)
        if high == DIM:
            break
        if least is None:  # the likeliest centroid is summed in full: its distance is what others must not exceed
            guess = sums.argmin(axis=1)
            least = ((coefficients - centroids[guess]) ** 2).sum(axis=1)
        keep = sums[rows, cols] <= least[rows]
        rows, cols = rows[keep], cols[keep]
    full = np.full((n, k), -1, dtype=kind)
    full[rows, cols] = sums[rows, cols]
    best = full[rows, cols].max(initial=0) + 1
    full[full < 0] = best
    chosen = full.argmin(axis=1)
    return chosen, full[np.arange(n), chosen] // DIM


def _whole(values: pa.Array) -> tuple[np.ndarray, int]:
    """floor(SCALE * x) of vectors of finite numbers, and the largest of them in size."""
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, DIM)
    with np.errstate(over="ignore"):
        scaled = np.floor(flat * SCALE)
    if (np.abs(scaled) <= NARROW).all():
        whole = scaled.astype(np.int64)
    else:
        # scaling by a power of two is exact but where it overflows, and there are no fractions
        whole = np.array([[math.floor(x * SCALE) if abs(x) < 2.0 ** 1000 else int(x) * SCALE for x in row] for row in flat.tolist()], dtype=object)
    return whole, int(np.abs(whole).max(initial=0))


def _limbs(whole: np.ndarray, count: int) -> np.ndarray:
    """Whole numbers as ``count`` parts of ``LIMB`` bits each, the last one with the sign, along a new last axis."""
    parts = [(whole >> (LIMB * i)) & ((1 << LIMB) - 1) for i in range(count - 1)] + [whole >> (LIMB * (count - 1))]
    return np.stack(parts, axis=-1).astype(np.int64)


def _joined(limbs: np.ndarray) -> np.ndarray:
    """Inverse of ``_limbs``, as Python's whole numbers if there is more than one part."""
    if limbs.shape[-1] == 1:
        return limbs[..., 0]
    return sum(limbs[..., i].astype(object) << (LIMB * i) for i in range(limbs.shape[-1]))


_ROWS = pa.schema([("vec_id", pa.int64()), ("coefficients", pa.binary()), ("size", pa.int32())])


def _coefficients(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable vectors as coefficients: 32-bit numbers where they are narrow, else limbs; ``size`` is the number of limbs, 0 for 32 bits."""
    matrix = hadamard()
    for batch in batches:
        whole, largest = _whole(batch.column("embedding"))
        if not len(whole):
            continue
        made = transformed(whole, matrix)
        if whole.dtype == object:
            size = -(-(largest.bit_length() + 8) // LIMB)
            rows = [r.astype("<i8").tobytes() for r in _limbs(made, size)]
        else:
            size, rows = 0, [r.tobytes() for r in made.astype("<i4")]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(rows, pa.binary()), pa.array([size] * len(rows), pa.int32())], schema=_ROWS)


def _read(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Stretches of rows of one size, and their coefficients."""
    sizes = batch.column("size").to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(sizes)]
    for start, stop in zip(cuts, cuts[1:]):
        part, size = batch.slice(start, stop - start), int(sizes[start])
        data = b"".join(part.column("coefficients").to_pylist())
        if size:
            yield part, _joined(np.frombuffer(data, dtype="<i8").reshape(len(part), DIM, size)).astype(object)
        else:
            yield part, np.frombuffer(data, dtype="<i4").reshape(len(part), DIM).astype(np.int64)


def _centred(coefficients: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``nearest``, in Python's whole numbers where either side isn't narrow."""
    narrow = centroids.dtype != object and coefficients.dtype != object
    return nearest(coefficients, centroids) if narrow else nearest(coefficients.astype(object), centroids.astype(object))


_SUMS = pa.schema([("cluster", pa.int32()), ("rows", pa.int64()), ("sums", pa.list_(pa.int64()))])


def _round(centroids: np.ndarray, limbs: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(centroids), dtype=np.int64)
        sums = np.zeros((len(centroids), DIM), dtype=object)
        for batch in batches:
            if not len(batch):
                continue
            for _, own in _read(batch):
                chosen, _ = _centred(own, centroids)
                for c in np.unique(chosen).tolist():
                    mine = own[chosen == c]
                    counts[c] += len(mine)
                    sums[c] += mine.sum(axis=0).astype(object)
        full = np.flatnonzero(counts)
        if len(full):
            parts = _limbs(sums[full], limbs).reshape(len(full), -1).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(counts[full]), pa.array(parts, _SUMS.field("sums").type)], schema=_SUMS)

    return run


_ASSIGNED = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])


def _assign(centroids: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            for part, own in _read(batch):
                chosen, distance = _centred(own, centroids)
                far = np.array(distance >= 1 << 63, dtype=bool)
                distance = np.where(far, 0, distance).astype(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(chosen, pa.int32()), pa.array(distance, mask=far)], schema=_ASSIGNED)

    return run


def _first_centroids(rows: DataFrame, k: int, seed: int) -> list[tuple[bytes, int]]:
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = rows.orderBy(order, "size", "coefficients").limit(k).select("coefficients", "size").collect()
    return [(bytes(r[0]), r[1]) for r in chosen]


def _means(rows: DataFrame, centroids: np.ndarray, limbs: int) -> np.ndarray:
    """Coefficients of the centroids after a round: the floor of the mean of their vectors; empty ones stay."""
    partial = rows.mapInArrow(_round(centroids, limbs), "cluster int, rows long, sums array<long>")
    total = (partial.select("cluster", "rows", F.posexplode("sums").alias("at", "part")).groupBy("cluster", "at")
             .agg(F.sum("rows").alias("rows"), F.sum(F.col("part").cast("decimal(38,0)")).alias("part")).collect())
    matrix, out = hadamard(), centroids.astype(object)
    for c in sorted({r["cluster"] for r in total}):
        own = {r["at"]: (int(r["part"]), r["rows"]) for r in total if r["cluster"] == c}
        sums = np.array([sum(own[i * limbs + j][0] << (LIMB * j) for j in range(limbs)) for i in range(DIM)], dtype=object)
        means = np.array([(x // DIM) // own[0][1] for x in matrix.T.astype(object) @ sums], dtype=object)
        out[c] = matrix.astype(object) @ means
    return out


def _narrowed(centroids: np.ndarray) -> np.ndarray:
    """As 64-bit numbers where the components, and so the distances to narrow vectors, are narrow."""
    components = [x // DIM for row in centroids for x in hadamard().T.astype(object) @ row]
    return centroids.astype(np.int64) if all(abs(x) <= NARROW for x in components) else centroids


def centroid_clusters(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3) -> DataFrame:
    """One row per usable vector (vec_id, embedding) of 64 components: vec_id, cluster, distance (squared, to its final centroid), cluster_inertia
    and inertia (distances summed over its cluster and over all), centroid (its components).

    Components are ``floor(1024 * x)``. A vector that is null, has another number of components, or holds a null or one that isn't finite, gives no
    row. Centroids start as the ``k`` vectors with the smallest SHA-256 of ``seed:vec_id`` in hexadecimal, all if there are fewer; rows that share an id are told apart by
    their numbers, a null id counts as an empty one. Rounds that change nothing end the rest early. A distance or sum of 2^63 or more, which
    a long can't hold, is null. An empty table gives an empty result; other columns of ``vectors`` are not read.
    """
    embedding = F.col("embedding")
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    usable = vectors.where(F.coalesce((F.size(embedding) == DIM) & finite, F.lit(False)))
    found = usable.select(F.col("vec_id").cast("long").alias("vec_id"), embedding.cast("array<double>").alias("embedding"))
    rows = stored(found.mapInArrow(_coefficients, "vec_id long, coefficients binary, size int"), "wht-vectors")
    first = _first_centroids(rows, k, seed)
    if not first:
        return _nothing(vectors.sparkSession)
    widest = rows.agg(F.max("size")).first()[0]
    # a task sums at most 2 ** 31 vectors: one part holds narrow sums, wide ones take two parts more
    limbs = 1 if widest == 0 else widest + 2
    centroids = _narrowed(np.array([[int(x) for x in _decoded(data, size)] for data, size in first], dtype=object))
    for _ in range(rounds):
        moved = _narrowed(_means(rows, centroids, limbs))
        if (moved == centroids).all():
            break
        centroids = moved
    assigned = stored(rows.mapInArrow(_assign(centroids), "vec_id long, cluster int, distance long"), "wht-assigned")
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertias = {r[0]: (r[1] if r[2] else None) for r in assigned.groupBy("cluster").agg(wide, F.count("distance") == F.count("*")).collect()}
    total = None if None in inertias.values() else sum(inertias.values())
    components = [[int(x) // DIM for x in hadamard().T.astype(object) @ row.astype(object)] for row in centroids]
    known = vectors.sparkSession.createDataFrame(
        [(c, _long(own), _long(total), [str(x) for x in components[c]]) for c, own in inertias.items()],
        "cluster int, cluster_inertia long, inertia long, centroid array<string>")
    return assigned.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def _decoded(data: bytes, size: int) -> np.ndarray:
    return _joined(np.frombuffer(data, dtype="<i8").reshape(DIM, size)) if size else np.frombuffer(data, dtype="<i4")


def _long(value) -> int | None:
    return None if value is None or value >= 1 << 63 else int(value)


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<string>")
