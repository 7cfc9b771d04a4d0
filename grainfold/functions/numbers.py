"""Numeric expressions: ranges, distances, thresholds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The largest double.
LARGEST = 1.7976931348623157e308

Ranges = Mapping[str, tuple[float, float]]


def all_in_range(ranges: Ranges) -> Column:
    """True when every column lies in its inclusive range."""
    return reduce(and_, (F.col(name).between(low, high) for name, (low, high) in ranges.items()))


def range_flag(ranges: Ranges) -> Column:
    """1 when every column lies in its range, else 0; the row stays."""
    return F.when(all_in_range(ranges), 1).otherwise(0)


def euclidean(features: Sequence[str], point: Sequence[float]) -> Column:
    """The distance, or the largest double where its square is beyond it."""
    gaps = [F.lit(float(value)) - F.col(name) for name, value in zip(features, point, strict=True)]
    return F.least(F.sqrt(reduce(add, (gap * gap for gap in gaps))), F.lit(LARGEST))


def all_finite(columns: Sequence[str]) -> Column:
    """True when no column is null, NaN or infinite."""
    return reduce(and_, (F.coalesce(F.abs(F.col(c)) <= LARGEST, F.lit(False)) for c in columns))


def kept_rows(share: float, n: Column) -> Column:
    """How many rows a tail trim keeps of ``n``: one more than the rounded-down share."""
    return F.least(n, F.floor(F.lit(float(share)) * n) + 1)


def support_threshold(support: float, n: int) -> int:
    """The rounded-down share of ``n`` baskets, at least one basket."""
    return max(1, int(support * n))
