"""Popularity of localities and the tags used there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainfold.functions.text import year_of
from grainfold.operators.folds import count_by, count_by_lookup
from grainfold.operators.ranking import pack_ranked, top_n, top_n_per_group
from grainfold.operators.rows import drop_self_tags, explode_list, locality_name, strip_year
from grainfold.session import written


def photos_per_locality(photos: DataFrame, places: DataFrame) -> DataFrame:
    """``locality, n_photos``"""
    counts = count_by_lookup(photos, locality_name(places), "place_id", "locality")
    return counts.withColumnRenamed("n", "n_photos")


def top_localities(counts: DataFrame, n: int = 50) -> DataFrame:
    return top_n(counts, n, "n_photos", "locality")


def _tag_counts(photos: DataFrame, localities: DataFrame) -> DataFrame:
    """``locality, tag, n`` of the photos taken in ``localities``.

    The lookup has one row per place. Spark broadcasts it if it is small; otherwise it is
    read from a written table straight into the sort-merge join, so that Spark may split a
    place with very many photos over several tasks.
    """
    photos = photos.select("place_id", "tags", year_of(F.col("date_taken")).alias("year"))
    tagged = strip_year(photos.join(localities, "place_id"), "tags", "year")
    tags = explode_list(tagged.select("locality", "tags"), "tags", " ", "tag")
    return count_by(drop_self_tags(tags), "locality", "tag")


def locality_tags(photos: DataFrame, places: DataFrame) -> DataFrame:
    """``locality, tag, n`` of all localities."""
    return _tag_counts(photos, written(locality_name(places), "localities"))


def merge_tag_counts(counts: DataFrame) -> DataFrame:
    """Sum the counts of tags listed several times for a locality."""
    return counts.groupBy("locality", "tag").agg(F.sum("n").alias("n"))


def _with_top_tags(top: DataFrame, counts: DataFrame, n_tags: int) -> DataFrame:
    ranked = top_n_per_group(counts, "locality", "n", "tag", n_tags)
    entry = F.concat("tag", F.lit(":"), F.col("n").cast("string"))
    packed = pack_ranked(ranked, "locality", entry, "tags")
    return (
        top.join(packed, "locality", "left")
        .select("locality", "n_photos", "tags")
        .orderBy("locality")
    )


def top_tags_per_locality(
    photos: DataFrame, places: DataFrame, top: DataFrame, n_tags: int = 10
) -> DataFrame:
    """``locality, n_photos, tags`` for the localities in ``top``, in name order.

    ``tags`` holds the most frequent tags as ``tag:n`` with tabs between, null without any.
    Only places in the top localities are joined to the photos.
    """
    top = written(top, "top")
    localities = locality_name(places).join(top.select("locality"), "locality", "left_semi")
    counts = _tag_counts(photos, written(localities, "localities"))
    return _with_top_tags(top, counts, n_tags)


def top_tags_from_counts(top: DataFrame, counts: DataFrame, n_tags: int = 10) -> DataFrame:
    """As ``top_tags_per_locality``, from tag counts that were stored before."""
    counts = counts.join(top.select("locality"), "locality", "left_semi")
    return _with_top_tags(top, merge_tag_counts(counts), n_tags)
