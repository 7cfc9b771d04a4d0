"""Exact integer k-means on vectors of 64 components by popcounts of bit planes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainfold.session import local_table, written

WIDTH = 64
SCALE = 256
#: Components from here on would make squared distances too large for 64 bits.
LARGEST = 1 << 27
#: Rows compared with all centroids at a time.
ROWS = 4096


def taken(vector: Column) -> Column:
    """Whether a vector has 64 components, none of them null or not finite."""
    x = vector.cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return F.coalesce((F.size(x) == WIDTH) & finite, F.lit(False))


def weights(planes: int) -> np.ndarray:
    """What a bit of each plane counts; the last one holds the sign."""
    powers = 1 << np.arange(planes, dtype=np.int64)
    powers[-1] = -powers[-1]
    return powers


def to_planes(integers: np.ndarray, planes: int) -> np.ndarray:
    """One u64 a plane for every row of 64 integers: bit i is that of component i."""
    bits = ((integers[:, None, :] >> np.arange(planes)[:, None]) & 1).astype(np.uint8)
    return np.packbits(bits, axis=2, bitorder="little").view("<u8")[:, :, 0]


def from_planes(planes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(planes), WIDTH), np.int64)
    for weight, plane in zip(weights(planes.shape[1]), planes.T):
        cells = np.ascontiguousarray(plane, "<u8").view(np.uint8).reshape(-1, 8)
        out += weight * np.unpackbits(cells, axis=1, bitorder="little")
    return out


def dots(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact dot products of all rows with all centroids, both as planes.

    A product of two bits is their AND, so a pair of planes adds its weight times the number of
    common bits. Pairs of equal weight are added up as small numbers first.
    """
    size = rows.shape[1]
    total = np.zeros((len(rows), len(centroids)), np.int64)
    weight = weights(size)
    for power in range(2 * size - 1):
        for sign in (1, -1):
            sums = None
            for a in range(max(0, power - size + 1), min(size, power + 1)):
                b = power - a
                if (weight[a] * weight[b] > 0) == (sign > 0):
                    common = np.bitwise_count(rows[:, a, None] & centroids[None, :, b])
                    sums = common.astype(np.uint16) if sums is None else sums + common
            if sums is not None:
                total += sums.astype(np.int64) * (sign << power)
    return total


def norms(rows: np.ndarray) -> np.ndarray:
    weight = weights(rows.shape[1])
    total = np.zeros(len(rows), np.int64)
    for a in range(rows.shape[1]):
        common = np.bitwise_count(rows[:, a, None] & rows).astype(np.int64)
        total += weight[a] * (common @ weight)
    return total


def pack(vectors: DataFrame, planes: int) -> DataFrame:
    """``vec_id, planes, norm`` of kept vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = batch.column("embedding").flatten().to_numpy().reshape(-1, WIDTH)
                rows = to_planes(np.floor(SCALE * cells).astype(np.int64), planes)
                listed = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel().view(np.int64)), planes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), listed.cast(pa.list_(pa.int64())), pa.array(norms(rows))],
                    ["vec_id", "planes", "norm"])

    return vectors.mapInArrow(run, "vec_id long, planes array<long>, norm long")


def _nearest(centroids: np.ndarray):
    own, size = norms(centroids), centroids.shape[1]

    def nearest(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Planes, clusters and distances, some rows at a time; the first of equally near ones."""
        every = batch.column("planes").flatten().to_numpy().view(np.uint64).reshape(-1, size)
        norm = batch.column("norm").to_numpy()
        for at in range(0, len(every), ROWS):
            rows = every[at : at + ROWS]
            distances = norm[at : at + ROWS, None] - 2 * dots(rows, centroids) + own
            cluster = distances.argmin(axis=1)
            yield rows, cluster, distances[np.arange(len(rows)), cluster]

    return nearest


def totals(packed: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``cluster, place, total``: sums of the 64 components of each cluster's rows, and at place 64 their number."""
    nearest, k = _nearest(centroids), len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, WIDTH + 1), np.int64)
        for batch in batches:
            for rows, cluster, _ in nearest(batch):
                member = np.zeros((k, len(rows)))
                member[cluster, np.arange(len(rows))] = 1
                # below 2 ** 53, so exact in floating point
                sums[:, :WIDTH] += (member @ from_planes(rows)).astype(np.int64)
                sums[:, WIDTH] += member.sum(axis=1).astype(np.int64)
        cluster, place = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster, pa.int32()), pa.array(place, pa.int32()), pa.array(sums[cluster, place])],
            ["cluster", "place", "total"])

    found = packed.select("planes", "norm").mapInArrow(run, "cluster int, place int, total long")
    return found.groupBy("cluster", "place").agg(F.sum("total").alias("total"))


def assign(packed: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance``."""
    nearest = _nearest(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for rows, cluster, distance in nearest(batch):
                ids = batch.column("vec_id").slice(at, len(rows))
                at += len(rows)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(cluster, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return packed.mapInArrow(run, "vec_id long, cluster int, distance long")


SEED_FIELDS = T.StructType([
    T.StructField("cluster", T.IntegerType()), T.StructField("cluster_inertia", T.LongType()),
    T.StructField("inertia", T.LongType()), T.StructField("centroid_sha256", T.StringType()),
])
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def clusters(vectors: DataFrame, k: int = 40, rounds: int = 5, seed: str = "2") -> DataFrame:
    """Integer k-means of ``vec_id, embedding``, exact in every step.

    Components become ``floor(256 * x)``. Centroids start as the ``k`` vectors with the least sha256
    of ``seed:vec_id`` (all vectors, if fewer), and each round replaces those that have vectors by
    the floor of their mean. Equal distances go to the smaller number.

    Vectors of another length, with null or non-finite components, or null themselves take no part.
    Every row is a vector, repeated ids included; equal hashes start in the order of their components,
    null ids last. No vectors give no rows. Components of 2 ** 27 and more raise an error, as their
    distances do not fit in 64 bits. Other columns are not read.
    """
    spark = vectors.sparkSession
    kept = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    kept = kept.where(taken(F.col("embedding")))
    least, most = kept.select(F.min(F.array_min("embedding")), F.max(F.array_max("embedding"))).first()
    if least is None:
        return spark.createDataFrame([], RESULT)
    low, high = np.floor(SCALE * least), np.floor(SCALE * most)
    if max(-low - 1, high) >= LARGEST:
        raise ValueError(f"components of {least} to {most} are too large for distances of 64 bits")
    planes = 1 + max(int(high).bit_length(), int(-low - 1).bit_length() if low < 0 else 0)

    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.sort(named.asc_nulls_last(), "embedding").limit(k).select("embedding").collect()
    centroids = np.floor(SCALE * np.array([row[0] for row in first])).astype(np.int64)
    packed = written(pack(kept, planes), "planes")
    for _ in range(rounds):
        sums = np.zeros((len(centroids), WIDTH + 1), np.int64)
        for row in totals(packed, to_planes(centroids, planes)).collect():
            sums[row["cluster"], row["place"]] = row["total"]
        full = sums[:, WIDTH] > 0
        centroids[full] = sums[full, :WIDTH] // sums[full, WIDTH:]

    assigned = written(assign(packed, to_planes(centroids, planes)), "assigned")
    inertia = dict(assigned.groupBy("cluster").agg(F.sum("distance")).collect())
    rows = [
        (c, inertia.get(c, 0), sum(inertia.values()), hashlib.sha256(",".join(map(str, own.tolist())).encode()).hexdigest())
        for c, own in enumerate(centroids)
    ]
    return assigned.join(local_table(spark, rows, SEED_FIELDS), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
