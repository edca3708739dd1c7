"""Centroid clustering in exact integers by a tournament of bisectors.

Components become integers (``floor(scale * x)``), so sums, means and comparisons have no rounding. Of centroids a < b, b is nearer
to x than a just if x lies beyond their bisecting plane: if ``2 * (b - a) . x > b . b - a . a``. Normals and
thresholds of all pairs of centroids are made once a round. A vector starts with centroid 0 and meets the others in turn:
each of the k - 1 sign tests drops one of two, and zero keeps the smaller number. Only the distance to the winner is computed.

A round is one pass: each task adds up its vectors by cluster and hands on a row per cluster and limb
(sums as limbs of 40 bits, so that any sum is exact), Spark adds the rows, and the driver gets k rows of the new means.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Components of a vector, the factor of its integers, clusters, rounds, and what stands before an id in the hash that picks the start.
DIMENSIONS, SCALE, CLUSTERS, ROUNDS, SALT = 64, 1024, 8, 10, "3:"
#: Up to this magnitude of all components, products and their sums stay below 2**63.
SMALL = 1 << 25
#: Vectors that are compared at once; bits of a limb.
ROWS, LIMB = 4096, 40
#: The largest long.
LONG = (1 << 63) - 1


def _integers(x: np.ndarray, small: bool) -> np.ndarray:
    return x.astype(np.int64) if small else np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)


def bisectors(centroids: list[list[int]], small: bool) -> tuple[np.ndarray, np.ndarray]:
    """Normals (k, k, d) and thresholds (k, k) of the pairs a < b: b is nearer to x just if normal . x > threshold."""
    c = np.array(centroids, np.int64 if small else object)
    squares = (c * c).sum(axis=1)
    return 2 * (c[None, :] - c[:, None]), squares[None, :] - squares[:, None]


def nearest(x: np.ndarray, normals: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """Number of the nearest centroid of each row of ``x``; of equally near ones, the smallest."""
    best = np.zeros(len(x), np.int64)
    for b in range(1, len(normals)):
        side = (normals[best, b] * x).sum(axis=1) - thresholds[best, b]
        best[side > 0] = b
    return best


def _assigned(batches: Iterator[pa.RecordBatch], centroids: list[list[int]], dimensions: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of the batches with their vectors as integers and the numbers of their centroids. Vectors beyond ``SMALL``
    go by Python's integers, the others by 64 bits."""
    if not centroids:
        return
    near = max((abs(v) for c in centroids for v in c), default=0) <= SMALL
    tests = {small: bisectors(centroids, small) for small in ({True, False} if near else {False})}
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            x = part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
            fits = np.abs(x).max(axis=1) <= SMALL if near else np.zeros(len(x), bool)
            for small in (True, False):
                rows = np.flatnonzero(fits == small)
                if len(rows):
                    values = _integers(x[rows], small)
                    yield part.take(pa.array(rows)), values, nearest(values, *tests[small])


def _limbs(v: int) -> list[int]:
    """``v`` as signed limbs of ``LIMB`` bits, lowest first."""
    sign, v, out = (-1 if v < 0 else 1), abs(v), []
    while v:
        out.append(sign * (v & (1 << LIMB) - 1))
        v >>= LIMB
    return out


def kept_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id and vector (``floor(scale * x)`` of each component, as whole doubles, which are exact at any size) of the vectors
    with just ``dimensions`` components, none null or not finite. Written to the shared folder, as each round reads it."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                column = part.column("vector")
                sizes = np.diff(column.offsets.to_numpy())
                whole = np.flatnonzero((sizes == dimensions) & ~column.is_null().to_numpy(zero_copy_only=False))
                part = part.take(pa.array(whole))
                # Null components become NaN.
                x = part.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimensions)
                with np.errstate(over="ignore", invalid="ignore"):
                    x = np.floor(scale * x)
                rows = np.flatnonzero(np.isfinite(x).all(axis=1))
                made = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * dimensions), pa.array(x[rows].ravel()))
                yield pa.RecordBatch.from_arrays([part.column("vec_id").take(pa.array(rows)), made], ["vec_id", "vector"])

    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return written(rows.mapInArrow(keep, f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, vector array<double>"))


def first_centroids(kept: DataFrame, *, clusters: int = CLUSTERS, salt: str = SALT) -> list[list[int]]:
    """The vectors with the smallest SHA-256 of ``salt`` and their id. Ids that repeat follow the order of their vectors; null ids
    come last. With fewer vectors than ``clusters``, there are as many centroids as vectors."""
    drawn = F.coalesce(F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256), F.lit("none"))
    rows = kept.select("vector", drawn.alias("drawn")).orderBy("drawn", "vector").limit(clusters).collect()
    return [[int(v) for v in r.vector] for r in rows]


def next_centroids(kept: DataFrame, centroids: list[list[int]], dimensions: int = DIMENSIONS) -> list[list[int]]:
    """Of each cluster the componentwise floor of its vectors' mean; an empty cluster keeps its centroid."""
    sums = [f"s{i}" for i in range(dimensions)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        count: dict[int, int] = {}
        for _, values, best in _assigned(batches, centroids, dimensions):
            for c in np.unique(best).tolist():
                own = values[best == c]
                total[c] = total.get(c, 0) + own.sum(axis=0).astype(object)
                count[c] = count.get(c, 0) + len(own)
        made = []
        for c, n in count.items():
            limbs = [_limbs(int(v)) for v in total[c]]
            for k in range(max(1, *map(len, limbs))):
                made.append((c, k, n if not k else 0, *(x[k] if k < len(x) else 0 for x in limbs)))
        columns = zip(*made, strict=True) if made else [[]] * (3 + dimensions)
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, [pa.int32(), pa.int32(), *[pa.int64()] * (1 + dimensions)], strict=True)], ["cluster", "limb", "n", *sums])

    parts = kept.select("vector").mapInArrow(add, "cluster int, limb int, n long, " + ", ".join(f"{s} long" for s in sums))
    # A row for each centroid and limb. Limbs of 40 bits of up to four million tasks add up within a long; more would be an error, not a wrong sum.
    found = parts.groupBy("cluster", "limb").agg(F.sum("n").alias("n"), *(F.try_sum(s).alias(s) for s in sums)).collect()
    out = []
    for c, before in enumerate(centroids):
        own = [r for r in found if r.cluster == c]
        n = sum(r.n for r in own)
        out.append([sum(int(r[s]) << LIMB * r.limb for r in own) // n for s in sums] if n else before)
    return out


def nearest_centroids(kept: DataFrame, centroids: list[list[int]], dimensions: int = DIMENSIONS) -> DataFrame:
    """vec_id, cluster and distance (squared; null beyond a long) of each kept vector."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, values, best in _assigned(batches, centroids, dimensions):
            away = values - np.array(centroids, values.dtype)[best]
            far = [d if d <= LONG else None for d in (away * away).sum(axis=1).tolist()]
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(best, pa.int32()), pa.array(far, pa.int64())], ["vec_id", "cluster", "distance"])

    return kept.mapInArrow(measure, f"vec_id {kept.schema['vec_id'].dataType.simpleString()}, cluster int, distance long")


def cluster_vectors(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE, clusters: int = CLUSTERS, rounds: int = ROUNDS, salt: str = SALT
) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance (squared, to its final centroid), cluster_inertia and inertia (distances summed
    over its cluster and over all) and centroid_sha256 (of the final centroid's components, joined by commas).

    Vectors of another length, null ones and those with a null or non-finite component (or one that ``scale`` takes beyond the
    doubles) have no row. Rows that repeat an id or a vector each count and have their row; ties go to the smaller centroid. A
    distance or an inertia beyond a long is null. No kept vectors, no rows. Other columns are not read.
    """
    kept = kept_vectors(vectors, id_col=id_col, vector_col=vector_col, dimensions=dimensions, scale=scale)
    centroids = first_centroids(kept, clusters=clusters, salt=salt)
    for _ in range(rounds):
        centroids = next_centroids(kept, centroids, dimensions)
    found = nearest_centroids(kept, centroids, dimensions)
    inertia = {r.cluster: r for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"), F.count_if(F.col("distance").isNull()).alias("unknown")).collect()}
    known = {c: int(r.total) if not r.unknown else LONG + 1 for c, r in inertia.items()}
    whole = sum(known.values())
    spark = vectors.sparkSession
    rows = [(c, known[c] if known[c] <= LONG else None, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c in sorted(known)]
    # At most a row for each centroid.
    of = spark.createDataFrame(rows, "cluster int, cluster_inertia long, centroid_sha256 string")
    return found.join(F.broadcast(of), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(whole if whole <= LONG else None).cast("long").alias("inertia"), "centroid_sha256")
