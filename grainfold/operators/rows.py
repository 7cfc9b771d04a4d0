"""Row-wise operators: filters, flags, exploding, clean-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainfold.functions.numbers import Ranges, all_in_range, range_flag
from grainfold.functions.text import (
    after_first_comma,
    occurs_in,
    split_fields,
    trim_blanks,
    without_year,
)


def flag_in_range(rows: DataFrame, ranges: Ranges, flag: str = "valid") -> DataFrame:
    """Add a 0/1 column; rows out of range stay, with 0."""
    return rows.withColumn(flag, range_flag(ranges))


def where_in_range(rows: DataFrame, ranges: Ranges) -> DataFrame:
    return rows.where(all_in_range(ranges))


def where_at_least(rows: DataFrame, column: str, least: float) -> DataFrame:
    return rows.where(F.col(column) >= least)


def explode_list(
    rows: DataFrame, column: str, sep: str, item: str, trim: bool = False
) -> DataFrame:
    """One row per list entry, as ``item`` in place of ``column``; repeats stay."""
    exploded = rows.withColumn(item, F.explode(split_fields(F.col(column), sep)))
    if trim:
        exploded = exploded.withColumn(item, trim_blanks(F.col(item)))
    return exploded if item == column else exploded.drop(column)


def where_member(rows: DataFrame, column: str, members: Sequence[str]) -> DataFrame:
    return rows.where(F.col(column).isin(*members))


def strip_year(rows: DataFrame, tags: str = "tags", date: str = "date_taken") -> DataFrame:
    return rows.withColumn(tags, without_year(F.col(tags), F.col(date)))


def drop_self_tags(rows: DataFrame, tag: str = "tag", within: str = "locality") -> DataFrame:
    """Drop tags that only repeat a part of the name they belong to, and empty tags."""
    return rows.where(~occurs_in(F.col(tag), F.col(within)))


def locality_name(
    places: DataFrame,
    name: str = "place_name",
    type_: str = "place_type_id",
    whole: int = 7,
    inner: int = 22,
) -> DataFrame:
    """``place_id, locality`` for places of the two kept types.

    A ``whole`` place is named in full. An ``inner`` place lies in the locality named after
    its first comma; without a comma it is dropped. A place listed twice gets one name, so
    that no later join can multiply rows.
    """
    locality = F.when(F.col(type_) == whole, F.col(name)).when(
        F.col(type_) == inner, after_first_comma(F.col(name))
    )
    return (
        places.where(F.col(type_).isin(whole, inner))
        .select("place_id", locality.alias("locality"))
        .where(F.col("locality").isNotNull())
        .groupBy("place_id")
        .agg(F.min("locality").alias("locality"))
    )


def features_as(rows: DataFrame, columns: dict[str, Column | str]) -> DataFrame:
    """A feature vector: one double column per entry."""
    return rows.select(
        *[
            (F.col(source) if isinstance(source, str) else source).cast("double").alias(name)
            for name, source in columns.items()
        ]
    )
