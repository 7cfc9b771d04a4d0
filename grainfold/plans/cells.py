"""Measurements per researcher and clusters of cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainfold.functions.numbers import Ranges, range_flag
from grainfold.operators.clustering import Model, kmeans, trimmed_kmeans
from grainfold.operators.folds import sum_by, sum_by_partner
from grainfold.operators.rows import explode_list, where_in_range

MARKERS = ["ly6c", "cd11b", "sca1"]

# fixed values: the counted range starts at 0, the clustered one at 1
COUNTED: Ranges = {"fsc_a": (0, 150000), "ssc_a": (0, 150000)}
CLUSTERED: Ranges = {"fsc_a": (1, 150000), "ssc_a": (1, 150000)}


def measurements_per_researcher(
    measurements: DataFrame, experiments: DataFrame, ranges: Ranges = COUNTED
) -> DataFrame:
    """``researcher, n``: valid measurements of all samples a researcher worked on.

    A researcher whose samples have no valid measurement stays, with 0.
    """
    valid = sum_by(measurements, ["sample"], range_flag(ranges), "n")
    listings = experiments.select("sample", "researchers")

    def expand(rows: DataFrame) -> DataFrame:
        return explode_list(rows, "researchers", ";", "researcher", trim=True)

    counts = sum_by_partner(valid, listings, "sample", "researcher", ["n"], expand)
    return counts.orderBy(F.desc("n"), "researcher")


def cell_clusters(
    cells: DataFrame, model: Model, iterations: int = 10, ranges: Ranges = CLUSTERED
) -> DataFrame:
    """``cluster_id, n, ly6c, cd11b, sca1``"""
    points = where_in_range(cells, ranges)
    return kmeans(points, MARKERS, model, iterations).orderBy("cluster_id")


def cell_clusters_trimmed(
    cells: DataFrame,
    model: Model,
    iterations: int = 10,
    ranges: Ranges = CLUSTERED,
    keep: float = 0.9,
) -> DataFrame:
    points = where_in_range(cells, ranges)
    return trimmed_kmeans(points, MARKERS, model, iterations, keep).orderBy("cluster_id")
