"""k-means with given or random first centroids, and k-means after a tail trim.

The model (k centroids) lives on the driver and enters each round as literals; the points
stay distributed. A round is one scan of the points: a narrow projection finds the nearest
centroid and a map-side aggregate leaves k rows per partition to shuffle. With many centroids
the points keep their cluster and a bound between rounds, which spares most distances.
"""

from __future__ import annotations

import random
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainfold.functions.numbers import LARGEST, all_finite, euclidean
from grainfold.operators.trim import trim_group_tail
from grainfold.session import local_table, written

Centroid = tuple[int, Sequence[float]]
Model = Sequence[Centroid]

# Tasks get the functions of this module by value, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Up to this many centroids the distances compile to one method the JVM still optimises;
# beyond it numpy is faster.
COMPILED_CENTROIDS = 16


def random_centroids(
    k: int, dimensions: int = 3, low: float = 0.0, high: float = 3.0, seed: int | None = None
) -> Model:
    """Centroids 1 to k, uniform in a cube."""
    draw = random.Random(seed)
    return [(i, [draw.uniform(low, high) for _ in range(dimensions)]) for i in range(1, k + 1)]


def centroids_from(clusters: DataFrame, features: Sequence[str]) -> Model:
    """The model stored in a k-row table."""
    rows = clusters.select("cluster_id", *features).orderBy("cluster_id").collect()
    return [(row[0], list(row[1:])) for row in rows]


def assign_nearest(points: DataFrame, features: Sequence[str], model: Model) -> DataFrame:
    """Add ``cluster_id`` and ``dist`` of the nearest centroid; the lowest id wins a tie.

    Points with a feature that is null, NaN or infinite have no nearest centroid and are dropped,
    whatever the number of centroids. Distances too large for a double are the largest double.
    """
    if not model:
        raise ValueError("at least one centroid is needed")
    model = sorted(model)
    points = points.where(all_finite(features))
    nearest = _nearest_compiled if len(model) <= COMPILED_CENTROIDS else _nearest_batched
    return nearest(points, features, model)


def _nearest_compiled(points: DataFrame, features: Sequence[str], model: Model) -> DataFrame:
    distances = {f"_d{i}": euclidean(features, c) for i, (_, c) in enumerate(model)}
    names = list(distances)
    least = F.least(*names) if len(names) > 1 else F.col(names[0])
    choice = F.lit(model[-1][0])
    for name, (cluster_id, _) in reversed(list(zip(names[:-1], model))):
        choice = F.when(F.col(name) == F.col("dist"), cluster_id).otherwise(choice)
    return (
        points.withColumns(distances)
        .withColumn("dist", least)
        .select(*points.columns, choice.cast("int").alias("cluster_id"), "dist")
    )


def _nearest_batched(points: DataFrame, features: Sequence[str], model: Model) -> DataFrame:
    ids = np.array([cluster_id for cluster_id, _ in model], dtype=np.int32)
    centres = np.array([c for _, c in model], dtype=np.float64)

    @F.pandas_udf("cluster_id int, dist double")
    def nearest(*columns: pd.Series) -> pd.DataFrame:
        best = np.full(len(columns[0]), np.inf)
        at = np.zeros(len(best), dtype=np.int64)
        values = [column.to_numpy() for column in columns]
        for i, centre in enumerate(centres):
            squares = sum((c - v) * (c - v) for c, v in zip(centre, values))
            dist = np.minimum(np.sqrt(squares), LARGEST)
            closer = dist < best
            best[closer], at[closer] = dist[closer], i
        return pd.DataFrame({"cluster_id": ids[at], "dist": best})

    return points.withColumn("_near", nearest(*features)).select(
        *points.columns, "_near.cluster_id", "_near.dist"
    )


def centres(
    assigned: DataFrame, features: Sequence[str], weight: Column | None = None
) -> DataFrame:
    """``cluster_id, n`` and the mean of every feature, for clusters that have points."""
    if weight is None:
        n, means = F.count(F.lit(1)), [F.avg(f).alias(f) for f in features]
    else:
        n = F.sum(weight)
        means = [(F.sum(F.col(f) * weight) / F.sum(weight)).alias(f) for f in features]
    return assigned.groupBy("cluster_id").agg(n.alias("n"), *means)


def kmeans(
    points: DataFrame, features: Sequence[str], model: Model, iterations: int = 10
) -> DataFrame:
    """``cluster_id, n, *features`` after exactly ``iterations`` rounds.

    A cluster that gets no point is gone for good; ids are not renumbered. ``n`` is the size
    at the last assignment, 0 without any round.
    """
    points = points.select(*features)
    if iterations > 1:
        points = written(points, "points")
    return _rounds(points, features, model, iterations)


def trimmed_kmeans(
    points: DataFrame,
    features: Sequence[str],
    model: Model,
    iterations: int = 10,
    keep: float = 0.9,
) -> DataFrame:
    """k-means from ``model`` on the points left by a per-cluster trim of the farthest ones."""
    points = written(points.select(*features), "points")
    nearest = assign_nearest(points, features, model)
    kept = trim_group_tail(nearest, "cluster_id", "dist", features, keep)
    kept = written(kept.select(*features, "copies"), "kept")
    return _rounds(kept, features, model, iterations, F.col("copies"))


#: A bound has to be beaten by this share, so that rounding never decides what is skipped.
MARGIN = 1e-9


def nearest_within_bounds(
    values: list[np.ndarray], at: np.ndarray, lower: np.ndarray, old: np.ndarray | None, centres: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid of each point, a lower bound of its distance to all others, distances taken.

    ``at`` and ``lower`` are those of the last round, whose centroids were ``old``; without ``old``
    nothing is known yet. By the triangle inequality a point stays if its centroid is nearer than
    half the way to any other one, or than its bound less the largest move of a centroid. For all
    others a centroid more than twice as far from the last one as the point is cannot be nearest.
    """
    points = np.stack(values, axis=1)
    taken = np.zeros(len(points), np.int32)
    with np.errstate(over="ignore", invalid="ignore"):
        between = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(axis=2))
        if old is None:
            at, lower, upper = np.zeros(len(points), np.int64), np.zeros(len(points)), np.full(len(points), np.inf)
        else:
            moves = np.sqrt(((centres - old) ** 2).sum(axis=1))
            lower = lower - moves.max()
            upper = _distances(points, centres[at])
            taken += 1
        half = np.where(np.eye(len(centres), dtype=bool), np.inf, between).min(axis=1) / 2
        open_rows = np.flatnonzero(~(upper * (1 + MARGIN) < np.maximum(lower, half[at])))
        at, lower = at.copy(), lower.copy()
        reach, own = 2 * upper[open_rows] * (1 + MARGIN), points[open_rows]
        best, second = np.full(len(open_rows), np.inf), np.full(len(open_rows), np.inf)
        place = np.zeros(len(open_rows), np.int64)
        for i, centre in enumerate(centres):
            away = between[at[open_rows], i]
            near = np.flatnonzero(~(away > reach))
            dist = _distances(own[near], centre)
            taken[open_rows[near]] += 1
            closer = dist < best[near]
            second[near] = np.minimum(second[near], np.where(closer, best[near], dist))
            best[near[closer]], place[near[closer]] = dist[closer], i
            # those left out are farther than the way there less the way to the last centroid
            far = np.flatnonzero(away > reach)
            second[far] = np.minimum(second[far], away[far] - upper[open_rows[far]])
        at[open_rows], lower[open_rows] = place, second * (1 - MARGIN)
    return at, lower, taken


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """As everywhere: squares added up feature by feature, at most the largest double."""
    gaps = centres - points
    squares = sum(gaps[:, i] * gaps[:, i] for i in range(points.shape[1]))
    return np.minimum(np.sqrt(squares), LARGEST)


def assign_within_bounds(
    points: DataFrame, features: Sequence[str], model: Model, before: Model | None = None
) -> DataFrame:
    """Points with ``cluster_id``, ``lower`` and ``taken``, as ``nearest_within_bounds`` has them.

    ``points`` come from an earlier call whose model was ``before``, or are new; those without a
    finite place are dropped.
    """
    ids = np.array([cluster_id for cluster_id, _ in model], np.int32)
    centres = np.array([c for _, c in model], np.float64)
    old = None
    if before is None:
        points = points.where(all_finite(features)).withColumns(
            {"cluster_id": F.lit(0), "lower": F.lit(0.0), "taken": F.lit(0)})
    else:
        places = dict(before)
        old = np.array([places[cluster_id] for cluster_id in ids.tolist()], np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            values = [columns[f].to_numpy(zero_copy_only=False).astype(np.float64) for f in features]
            at = np.searchsorted(ids, columns["cluster_id"].to_numpy())
            at, lower, taken = nearest_within_bounds(values, at, columns["lower"].to_numpy(), old, centres)
            columns |= {"cluster_id": pa.array(ids[at]), "lower": pa.array(lower), "taken": pa.array(taken)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return points.mapInArrow(run, points.schema)


def _rounds_within_bounds(
    points: DataFrame, features: Sequence[str], model: Model, iterations: int, weight: Column | None
) -> DataFrame:
    model, before = sorted(model), None
    for left in reversed(range(iterations)):
        points = assign_within_bounds(points, features, model, before)
        if not left:
            break
        points = written(points, "assigned")
        rows = sorted(centres(points, features, weight).collect())
        if not rows:
            break  # no points at all
        # a cluster without a point is gone, and no point refers to it
        model, before = [(row["cluster_id"], [row[f] for f in features]) for row in rows], model
    return centres(points, features, weight)


def _rounds(
    points: DataFrame,
    features: Sequence[str],
    model: Model,
    iterations: int,
    weight: Column | None = None,
) -> DataFrame:
    if iterations < 1:
        return _as_table(points, features, model)
    if len(model) > COMPILED_CENTROIDS and iterations > 1:
        return _rounds_within_bounds(points, features, model, iterations, weight)
    for _ in range(iterations - 1):
        rows = centres(assign_nearest(points, features, model), features, weight).collect()
        if not rows:
            break  # no points at all
        model = [(row["cluster_id"], [row[f] for f in features]) for row in rows]
    return centres(assign_nearest(points, features, model), features, weight)


def _as_table(points: DataFrame, features: Sequence[str], model: Model) -> DataFrame:
    schema = T.StructType(
        [T.StructField("cluster_id", T.IntegerType()), T.StructField("n", T.LongType())]
        + [T.StructField(f, T.DoubleType()) for f in features]
    )
    data = [(cluster_id, 0, *map(float, centre)) for cluster_id, centre in model]
    return local_table(points.sparkSession, data, schema)
