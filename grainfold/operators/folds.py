"""Aggregates, and joins between sides that are aggregated first.

Rule of this module: a side that may hold many rows per join key is folded to one row per
key, or per key and partner, before it is shuffled for the join. The first half of the fold
runs where the rows are read, so a key that owns a third of a table reaches the join as a
few rows. No join here carries a broadcast hint: Spark broadcasts a side whose size it has
measured below ``spark.sql.autoBroadcastJoinThreshold`` and sorts and merges otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainfold.session import written


def count_by(rows: DataFrame, *keys: str, n: str = "n") -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))


def sum_by(rows: DataFrame, keys: Sequence[str], value: Column, total: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum(value).alias(total))


def count_by_lookup(facts: DataFrame, lookup: DataFrame, on: str, by: str) -> DataFrame:
    """Facts per ``by`` of the lookup row they point to; facts without one are dropped.

    Writes the lookup when called: its exact size decides whether it is broadcast, and then only
    facts with a lookup row are folded and shuffled. A lookup too large for that is merged, and
    Spark may split a key that owns many facts.
    """
    lookup = written(lookup.select(on, by), "lookup")
    return count_by(facts.select(on).join(lookup, on), by)


def sum_by_partner(
    totals: DataFrame,
    listings: DataFrame,
    on: str,
    by: str,
    values: Sequence[str],
    expand: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Sum ``values`` of one-row-per-key ``totals`` over the partners of each key.

    ``listings`` holds the keys with their partners in column ``by``, or in a packed column
    that ``expand`` turns into rows after the join, so that only packed rows are shuffled.
    A partner listed several times for a key counts as often as it is listed.
    """
    joined = totals.join(listings, on)
    if expand is not None:
        joined = expand(joined)
    return joined.groupBy(by).agg(
        *[F.sum(value).alias(value) for value in values]
    )


def mean_by_partner(
    facts: DataFrame,
    listings: DataFrame,
    on: str,
    by: str,
    value: str,
    mean: str,
    expand: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Mean of ``value`` over all pairs of a fact and a partner listed for its key."""
    totals = facts.groupBy(on).agg(
        F.sum(value).alias("_sum"), F.count(value).alias("_count")
    )
    sums = sum_by_partner(totals, listings, on, by, ["_sum", "_count"], expand)
    return sums.select(by, (F.col("_sum") / F.col("_count")).alias(mean))


def count_distinct(rows: DataFrame, column: str, n: str = "n") -> DataFrame:
    return rows.agg(F.countDistinct(column).alias(n))
