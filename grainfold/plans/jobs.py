"""The eleven jobs from text files to text files.

A job without an output path prints its first 100 rows instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from grainfold.operators.clustering import centroids_from, random_centroids
from grainfold.plans import cells, genes, movies, photos
from grainfold.sources import readers, writers

Output = str | None


def _store(lines: DataFrame, output: Output, single_file: bool = False) -> None:
    if output is None:
        writers.preview(lines)
    else:
        writers.write_lines(lines, output, single_file)


def photos_per_locality(
    spark: SparkSession, photo_path: str, place_path: str, output: Output = None
) -> None:
    counts = photos.photos_per_locality(
        readers.read_photos(spark, photo_path), readers.read_places(spark, place_path)
    )
    _store(writers.key_value_lines(counts), output)


def top_localities(
    spark: SparkSession, count_path: str, output: Output = None, n: int = 50
) -> None:
    top = photos.top_localities(readers.read_key_counts(spark, count_path), n)
    _store(writers.key_value_lines(top), output, single_file=True)


def locality_tags(
    spark: SparkSession, photo_path: str, place_path: str, output: Output = None
) -> None:
    tags = photos.locality_tags(
        readers.read_photos(spark, photo_path),
        readers.read_places(spark, place_path, min_fields=6),
    )
    _store(writers.packed_tag_lines(tags), output)


def top_tags_per_locality(
    spark: SparkSession, photo_path: str, place_path: str, top_path: str,
    output: Output = None, n_tags: int = 10,
) -> None:
    """From photos and places directly, without stored tag counts."""
    tags = photos.top_tags_per_locality(
        readers.read_photos(spark, photo_path),
        readers.read_places(spark, place_path, min_fields=6),
        readers.read_key_counts(spark, top_path),
        n_tags,
    )
    _store(writers.key_value_lines(tags), output, single_file=True)


def top_tags_from_counts(
    spark: SparkSession, top_path: str, tag_path: str, output: Output = None, n_tags: int = 10
) -> None:
    tags = photos.top_tags_from_counts(
        readers.read_key_counts(spark, top_path), readers.read_tag_counts(spark, tag_path), n_tags
    )
    _store(writers.key_value_lines(tags), output, single_file=True)


def measurements_per_researcher(
    spark: SparkSession, measurement_path: str, experiment_path: str, output: Output = None
) -> None:
    counts = cells.measurements_per_researcher(
        readers.read_measurements(spark, measurement_path),
        readers.read_experiments(spark, experiment_path),
    )
    _store(writers.key_value_lines(counts), output, single_file=True)


def cell_clusters(
    spark: SparkSession, measurement_path: str, k: int, output: Output = None,
    iterations: int = 10, seed: int | None = None,
) -> None:
    clusters = cells.cell_clusters(
        readers.read_cells(spark, measurement_path), random_centroids(k, seed=seed), iterations
    )
    _store(writers.key_value_lines(clusters), output, single_file=True)


def cell_clusters_trimmed(
    spark: SparkSession, measurement_path: str, cluster_path: str, output: Output = None,
    iterations: int = 10,
) -> None:
    model = centroids_from(readers.read_clusters(spark, cluster_path), cells.MARKERS)
    clusters = cells.cell_clusters_trimmed(
        readers.read_cells(spark, measurement_path), model, iterations
    )
    _store(writers.key_value_lines(clusters), output, single_file=True)


def genre_average_rating(
    spark: SparkSession, rating_path: str, movie_path: str, output: Output = None
) -> None:
    averages = movies.genre_average_rating(
        readers.read_ratings(spark, rating_path), readers.read_movies(spark, movie_path)
    )
    if output is None:
        writers.preview(averages)
    else:
        writers.write_csv(averages, output)


def cancers_with_active_gene(
    spark: SparkSession, expression_path: str, patient_path: str, output: Output = None
) -> None:
    counts = genes.cancers_with_active_gene(
        readers.read_expression(spark, expression_path), readers.read_patients(spark, patient_path)
    )
    _store(writers.key_value_lines(counts), output, single_file=True)


def gene_itemsets(
    spark: SparkSession, expression_path: str, patient_path: str, output: Output = None,
    support: float = 0.3, max_size: int = 10,
) -> None:
    sets = genes.gene_itemsets(
        readers.read_expression(spark, expression_path),
        readers.read_patients(spark, patient_path),
        support,
        max_size,
    )
    _store(writers.itemset_lines(sets), output)


def gene_rules(
    spark: SparkSession, itemset_path: str, output: Output = None, confidence: float = 0.6,
    expression_path: str | None = None, patient_path: str | None = None,
) -> None:
    """With expression and patients, antecedents are counted anew."""
    pairs = None
    if expression_path is not None and patient_path is not None:
        pairs = genes.active_genes(
            readers.read_expression(spark, expression_path),
            readers.read_patients(spark, patient_path),
        )
    rules = genes.gene_rules(readers.read_itemsets(spark, itemset_path), confidence, pairs)
    _store(writers.rule_lines(rules), output)
