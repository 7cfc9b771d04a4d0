"""Ratings by genre and by movie."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainfold.operators.folds import count_by, mean_by_partner, sum_by_partner
from grainfold.operators.rows import explode_list


def genre_average_rating(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """``genre, avg_rating``"""
    listings = movies.select("movie_id", "genres")

    def expand(rows: DataFrame) -> DataFrame:
        return explode_list(rows, "genres", "|", "genre")

    return mean_by_partner(
        ratings, listings, "movie_id", "genre", "rating", "avg_rating", expand
    )


def most_rated_titles(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """``title, rating_count, label`` by falling count; ``label`` is ``title:count``."""
    counts = count_by(ratings, "movie_id", n="rating_count")
    titles = movies.select("movie_id", "title")
    totals = sum_by_partner(counts, titles, "movie_id", "title", ["rating_count"])
    label = F.concat_ws(":", "title", F.col("rating_count").cast("string"))
    return totals.withColumn("label", label).orderBy(F.desc("rating_count"), "title")
