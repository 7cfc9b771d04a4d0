"""Top-n, over all rows and per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(rows: DataFrame, n: int, by: str, ties: str) -> DataFrame:
    """The ``n`` rows with the largest ``by``; ``ties`` ascending decides among equals.

    Spark keeps n rows per partition and merges those, so there is no full sort.
    """
    return rows.orderBy(F.desc(by), F.asc(ties)).limit(n)


def top_n_per_group(
    rows: DataFrame, group: str, by: str, ties: str, n: int, rank: str = "rank"
) -> DataFrame:
    """Rows ranked 1 to ``n`` in their group.

    The rank filter becomes a group limit ahead of the shuffle: no group sends more than n
    rows per partition, however large it is.
    """
    order = Window.partitionBy(group).orderBy(F.desc(by), F.asc(ties))
    return rows.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= n)


def pack_ranked(ranked: DataFrame, group: str, entry: Column, packed: str) -> DataFrame:
    """One row per group with its entries in rank order, joined by tabs.

    For the output of ``top_n_per_group`` only, which bounds the entries of a group.
    """
    entries = F.array_sort(F.collect_list(F.struct(F.col("rank"), entry.alias("entry"))))
    return ranked.groupBy(group).agg(F.array_join(entries.getField("entry"), "\t").alias(packed))
