"""One entry per query and operator, on the given tables."""

from __future__ import annotations

import contextlib
import io
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainfold import __main__ as commands
from grainfold import tables
from grainfold.functions.numbers import Ranges, kept_rows, support_threshold
from grainfold.operators import clustering, folds, itemsets, ranking, rows, trim
from grainfold.plans import cells, genes, movies, photos
from grainfold.session import local_table, new_path, written
from grainfold.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]

COUNTED: Ranges = {"fsc_a": (0, 50000), "ssc_a": (0, 25)}
CLUSTERED: Ranges = {"fsc_a": (1000, 90000), "ssc_a": (1, 45)}
MODEL = [(1, [0.5, 0.5, 0.5]), (2, [1.5, 1.5, 1.5]), (3, [2.5, 2.5, 2.5])]
ROUNDS = 10
RANDOM = clustering.random_centroids(10, seed=7)
RANDOM_MANY = clustering.random_centroids(40, seed=11)
SEGMENTS = ["BUILDING", "MACHINERY", "HOUSEHOLD"]
URGENT = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
ITEMSETS = {"support": 0.01, "max_size": 10, "active": 5, "cancers": URGENT}
CONFIDENCE = 0.05


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def joined(items: str) -> Column:
    return F.array_join(F.col(items).cast("array<string>"), " ")


# --- the eleven queries -----------------------------------------------------------------


def photos_per_locality(spark, sf):
    return photos.photos_per_locality(tables.photos(spark, sf), tables.places(spark, sf))


def top_localities(spark, sf):
    return photos.top_localities(photos_per_locality(spark, sf))


def locality_tags(spark, sf):
    return photos.locality_tags(tables.photos(spark, sf), tables.places(spark, sf))


def top_tags_per_locality(spark, sf):
    return photos.top_tags_per_locality(
        tables.photos(spark, sf), tables.places(spark, sf), top_localities(spark, sf)
    )


def measurements_per_researcher(spark, sf):
    return cells.measurements_per_researcher(
        tables.cells(spark, sf), tables.experiments(spark, sf), COUNTED
    )


def cell_clusters(spark, sf):
    clusters = cells.cell_clusters(tables.cells(spark, sf), MODEL, ROUNDS, CLUSTERED)
    return rounded(clusters, *cells.MARKERS)


def cell_clusters_trimmed(spark, sf):
    clusters = cells.cell_clusters_trimmed(tables.cells(spark, sf), MODEL, ROUNDS, CLUSTERED)
    return rounded(clusters, *cells.MARKERS)


def genre_average_rating(spark, sf):
    averages = movies.genre_average_rating(tables.ratings(spark, sf), tables.movies(spark, sf))
    return rounded(averages, "avg_rating")


def cancers_with_active_gene(spark, sf):
    return genes.cancers_with_active_gene(
        tables.user_expression(spark, sf), tables.user_patients(spark, sf), "click", 30, SEGMENTS
    )


def _sets(spark, sf):
    return genes.gene_itemsets(
        tables.order_expression(spark, sf), tables.order_patients(spark, sf), **ITEMSETS
    )


def gene_itemsets(spark, sf):
    return _sets(spark, sf).select("support", joined("items").alias("items"))


def gene_rules(spark, sf):
    rules = genes.gene_rules(_sets(spark, sf), CONFIDENCE)
    return rounded(
        rules.select(
            joined("antecedent").alias("antecedent"),
            joined("consequent").alias("consequent"),
            "confidence",
        ),
        "confidence",
    )


# --- sources: derive text from the tables, write it, read it back ------------------------


def _text(lines: DataFrame, label: str) -> str:
    path = new_path(lines.sparkSession, label)
    writers.write_lines(lines, path)
    return path


def _tsv(df: DataFrame, *columns: Column, sep: str = "\t") -> DataFrame:
    filled = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return df.select(F.concat_ws(sep, *filled).alias("value"))


def scan_photos(spark, sf):
    """Returned items lack place and accuracy: short rows, which the reader drops."""
    source = tables.table(spark, sf, "lineitem")
    here = F.col("l_returnflag") != "R"
    lines = _tsv(
        source,
        F.col("l_orderkey"), F.col("l_suppkey"), F.concat_ws(" ", "l_returnflag", "l_linestatus"),
        F.date_format("l_shipdate", "yyyy-MM-dd"), F.when(here, F.col("l_partkey")),
        F.when(here, F.lit("16")),
    )
    read = readers.read_photos(spark, _text(lines, "photos"))
    return folds.count_by(read, "tags", "date_taken")


def _place_lines(spark, sf):
    places = tables.places(spark, sf)
    nothing = F.lit("x")
    kept = F.col("place_type_id") != 22
    return _tsv(
        places, F.col("place_id"), nothing, nothing, nothing, F.col("place_name"),
        F.when(kept, F.col("place_type_id").cast("string")).otherwise("no number"),
        F.when(F.col("place_type_id") != 7, F.lit("/url")),
    )


def scan_places(spark, sf):
    """Type 22 is garbled and dropped; type 7 lacks its last field and is kept at six."""
    read = readers.read_places(spark, _text(_place_lines(spark, sf), "places"), min_fields=6)
    return read.select("place_id", "place_name", F.col("place_type_id").alias("place_type_id"))


def min_fields(spark, sf):
    """As scan_places, but seven fields are needed: type 7 is dropped too."""
    read = readers.read_places(spark, _text(_place_lines(spark, sf), "places"))
    return folds.count_by(read, "place_type_id")


def scan_key_counts(spark, sf):
    path = _text(writers.key_value_lines(photos_per_locality(spark, sf)), "counts")
    return readers.read_key_counts(spark, path)


def scan_tag_counts(spark, sf):
    """Packed counts written and read, then ranked for the stored top localities."""
    counts = readers.read_tag_counts(
        spark, _text(writers.packed_tag_lines(locality_tags(spark, sf)), "tags")
    )
    return photos.top_tags_from_counts(top_localities(spark, sf), counts)


def scan_many(spark, sf):
    """Several inputs under one reader."""
    nations = tables.table(spark, sf, "nation")
    regions = tables.table(spark, sf, "region")
    paths = [
        _text(_tsv(nations, F.col("n_name"), F.col("n_regionkey")), "nations"),
        _text(_tsv(regions, F.col("r_name"), F.col("r_regionkey")), "regions"),
    ]
    return readers.read_key_counts(spark, paths, "name", "n")


def _measurement_lines(spark, sf):
    number = F.col("l_extendedprice").cast("int")
    lines = _tsv(
        tables.table(spark, sf, "lineitem"),
        F.col("l_orderkey"), number, F.col("l_quantity").cast("int"),
        *[F.lit("0")] * 3, F.col("l_discount"), F.col("l_tax"), *[F.lit("0")] * 3,
        F.col("l_quantity"), F.lit("more"), sep=",",
    )
    header = spark.range(1).select(F.lit("sample,FSC-A,SSC-A,more").alias("value"))
    return header.unionByName(lines)


def scan_measurements(spark, sf):
    read = readers.read_measurements(spark, _text(_measurement_lines(spark, sf), "measurements"))
    return read.groupBy("sample").agg(
        F.sum("fsc_a").alias("fsc_a"), F.sum("ssc_a").alias("ssc_a")
    )


def scan_cells(spark, sf):
    read = readers.read_cells(spark, _text(_measurement_lines(spark, sf), "cells"))
    sums = read.groupBy("ssc_a").agg(*[F.sum(m).alias(m) for m in cells.MARKERS])
    return rounded(sums, *cells.MARKERS)


def scan_experiments(spark, sf):
    """Finished orders have no researchers: dropped rows."""
    researchers = F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority"))
    lines = _tsv(
        tables.table(spark, sf, "orders"),
        F.col("o_orderkey"), *[F.lit("x")] * 6, researchers, sep=",",
    )
    header = spark.range(1).select(F.lit("sample,a,b,c,d,e,f,researchers").alias("value"))
    return readers.read_experiments(spark, _text(header.unionByName(lines), "experiments"))


def scan_clusters(spark, sf):
    """Maxima per supplier written as a cluster model and read back."""
    means = tables.table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.count("*").alias("n"), *[F.max(c) for c in ("l_quantity", "l_discount", "l_tax")]
    )
    lines = writers.key_value_lines(means)
    return readers.read_clusters(spark, _text(lines, "clusters"))


def scan_ratings(spark, sf):
    lines = _tsv(
        tables.table(spark, sf, "lineitem"),
        F.col("l_partkey"), F.col("l_orderkey"), F.col("l_quantity"), F.lit("0"), sep=",",
    )
    read = readers.read_ratings(spark, _text(lines, "ratings"))
    return read.groupBy("movie_id").agg(F.sum("rating").alias("rating"))


def scan_movies(spark, sf):
    source = tables.movies(spark, sf)
    quoted = F.concat(F.lit('"'), F.col("title"), F.lit(', The"'))
    lines = _tsv(source, F.col("movie_id"), quoted, F.col("genres"), sep=",")
    return readers.read_movies(spark, _text(lines, "movies"))


def scan_expression(spark, sf):
    """Event types are no gene numbers, so those lines fall out; order readings stay."""
    good = tables.order_expression(spark, sf)
    bad = tables.user_expression(spark, sf)
    columns = [F.col(c) for c in ("patientid", "geneid", "expression")]
    lines = _tsv(good, *columns, sep=",").unionByName(_tsv(bad, *columns, sep=","))
    read = readers.read_expression(spark, _text(lines, "expression"))
    return read.groupBy("geneid").agg(
        F.count("*").alias("n"), F.sum("expression").alias("expression")
    )


def scan_patients(spark, sf):
    lines = _tsv(
        tables.user_patients(spark, sf),
        F.col("id"), *[F.lit("x")] * 3, F.col("diseases"), F.lit("y"), sep=",",
    )
    return readers.read_patients(spark, _text(lines, "patients"))


def scan_itemsets(spark, sf):
    """Baskets written as lines of different width and read back."""
    baskets = itemsets.to_baskets(tables.order_expression(spark, sf), "patientid", "geneid")
    sized = baskets.select("items", F.size("items").alias("support"))
    read = readers.read_itemsets(spark, _text(writers.itemset_lines(sized), "itemsets"))
    return folds.count_by(read.select(joined("items").alias("items")), "items", n="support")


# --- sinks: write a result, read its lines -----------------------------------------------


def _lines_of(spark, path):
    return spark.read.text(path).select(F.col("value").alias("line"))


def write_key_values(spark, sf):
    return _lines_of(spark, _text(writers.key_value_lines(photos_per_locality(spark, sf)), "out"))


def write_single_file(spark, sf):
    """One sorted file; the line number shows that its order is the order of the result."""
    path = new_path(spark, "researchers")
    lines = writers.key_value_lines(measurements_per_researcher(spark, sf))
    writers.write_lines(lines, path, single_file=True)
    place = F.monotonically_increasing_id() + 1
    return _lines_of(spark, path).select(place.alias("place"), "line")


def write_itemsets(spark, sf):
    return _lines_of(spark, _text(writers.itemset_lines(_sets(spark, sf)), "out"))


def write_rules(spark, sf):
    """The confidence, cut off the line, is compared as a number."""
    rules = genes.gene_rules(_sets(spark, sf), CONFIDENCE)
    lines = _lines_of(spark, _text(writers.rule_lines(rules), "out"))
    return lines.select(
        F.substring_index("line", "\t", 2).alias("rule"),
        F.round(F.substring_index("line", "\t", -1).cast("double"), 6).alias("confidence"),
    )


def write_csv(spark, sf):
    path = new_path(spark, "averages")
    writers.write_csv(genre_average_rating(spark, sf), path)
    return spark.read.csv(path, schema="genre string, avg_rating double")


# --- jobs: from the command line to what they write or print -----------------------------


def job_output(spark, sf):
    """Photos per locality from text to text, named on the command line; malformed lines drop out."""
    kept = _tsv(
        tables.photos(spark, sf), F.lit("p"), F.lit("u"), F.col("tags"), F.col("date_taken"),
        F.col("place_id"), F.lit("16"),
    )
    short = kept.select(F.substring_index("value", "\t", 3).alias("value"))
    nothing = F.lit("x")
    places = _tsv(
        tables.places(spark, sf), F.col("place_id"), nothing, nothing, nothing, F.col("place_name"),
        F.col("place_type_id"), F.lit("/url"),
    )
    out = new_path(spark, "job")
    commands.run(spark, [
        "photos-per-locality", _text(kept.unionByName(short), "photos"), _text(places, "places"), "--output", out])
    return _lines_of(spark, out)


def job_preview(spark, sf):
    """A job without an output, asked for more localities than the 100 rows it prints."""
    counts = writers.key_value_lines(photos_per_locality(spark, sf))
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        commands.run(spark, ["top-localities", _text(counts, "counts"), "--n", "120"])
    lines = [line[1:-1].rstrip().replace("\\t", "\t") for line in printed.getvalue().splitlines() if line.startswith("|")]
    numbered = list(enumerate(lines))[1:]  # the first is the column's name
    return local_table(spark, numbered, T.StructType([
        T.StructField("place", T.IntegerType()), T.StructField("line", T.StringType())]))


# --- projections and filters -------------------------------------------------------------


def locality_name(spark, sf):
    return rows.locality_name(tables.places(spark, sf))


def flag_in_range(spark, sf):
    """Valid measurements per sample, samples with none kept."""
    flagged = rows.flag_in_range(tables.cells(spark, sf), COUNTED)
    return folds.sum_by(flagged, ["sample"], F.col("valid"), "n")


def where_in_range(spark, sf):
    return folds.count_by(rows.where_in_range(tables.cells(spark, sf), CLUSTERED), "sample")


def where_at_least(spark, sf):
    """Readings of one gene with a high expression, per patient."""
    readings = tables.order_expression(spark, sf).where(F.col("geneid") == 4)
    return folds.count_by(rows.where_at_least(readings, "expression", 25), "patientid")


def where_member(spark, sf):
    return genes.cancer_patients(tables.user_patients(spark, sf), SEGMENTS)


def explode_list(spark, sf):
    exploded = rows.explode_list(
        tables.experiments(spark, sf), "researchers", ";", "researcher", trim=True
    )
    return folds.count_by(exploded, "researcher")


def strip_year(spark, sf):
    stripped = rows.strip_year(tables.photos(spark, sf))
    return folds.count_by(stripped, "place_id", "tags")


def drop_self_tags(spark, sf):
    """Tokens of the order priority that are no part of the customer's segment name."""
    orders = tables.table(spark, sf, "orders").join(
        tables.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    tokens = rows.explode_list(
        orders.select(F.col("c_mktsegment").alias("locality"),
                      F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("tags")),
        "tags", " ", "tag",
    )
    return folds.count_by(rows.drop_self_tags(tokens), "locality", "tag")


def feature_vector(spark, sf):
    columns = {"x": "ly6c", "y": "cd11b", "z": F.col("sca1")}
    vector = rows.features_as(tables.cells(spark, sf), columns)
    return rounded(vector.agg(*[F.avg(c).alias(c) for c in columns]), *columns)


# --- joins and aggregates ----------------------------------------------------------------


def count_by_lookup(spark, sf):
    """Orders per market segment of the customer."""
    lookup = tables.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment"
    )
    return folds.count_by_lookup(
        tables.table(spark, sf, "orders"), lookup, "o_custkey", "c_mktsegment"
    )


def sum_by_partner(spark, sf):
    """Line items per order priority, by a fold on either side of the join."""
    per_order = folds.count_by(tables.cells(spark, sf), "sample")
    partners = tables.experiments(spark, sf).withColumnRenamed("researchers", "team")
    return folds.sum_by_partner(per_order, partners, "sample", "team", ["n"])


def count_distinct(spark, sf):
    return folds.count_distinct(tables.order_expression(spark, sf), "patientid")


def distinct_items(spark, sf):
    return tables.order_expression(spark, sf).select("geneid").distinct()


def to_baskets(spark, sf):
    baskets = itemsets.to_baskets(tables.order_expression(spark, sf), "patientid", "geneid")
    return baskets.select("patientid", joined("items").alias("items"))


def min_support(spark, sf):
    """Items in enough baskets, with the threshold rounded down."""
    pairs = tables.order_expression(spark, sf).select("patientid", "geneid").distinct()
    least = support_threshold(0.3, pairs.select("patientid").distinct().count())
    return rows.where_at_least(folds.count_by(pairs, "geneid"), "n", least)


def most_rated_titles(spark, sf):
    return movies.most_rated_titles(tables.ratings(spark, sf), tables.movies(spark, sf))


# --- ranking and trimming ----------------------------------------------------------------


def top_n_per_group(spark, sf):
    """The ten suppliers with most line items, per line status."""
    counts = folds.count_by(tables.table(spark, sf, "lineitem"), "l_linestatus", "l_suppkey")
    return ranking.top_n_per_group(counts, "l_linestatus", "n", "l_suppkey", 10)


def first_rows(spark, sf):
    orders = tables.table(spark, sf, "orders")
    return ranking.top_n(orders, 100, "o_totalprice", "o_orderkey").select(
        "o_orderkey", "o_totalprice"
    )


def kept_per_group(spark, sf):
    """How many rows a trim keeps, for every sample size."""
    sizes = folds.count_by(tables.cells(spark, sf), "sample")
    return folds.count_by(sizes.select("n"), "n", n="samples").withColumn(
        "kept", kept_rows(0.9, F.col("n"))
    )


def trim_group_tail(spark, sf):
    """Cheapest line items per quantity; equal rows are folded with their number."""
    items = tables.table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("flag"), "l_quantity", "l_discount", "l_tax"
    )
    kept = trim.trim_group_tail(
        written(items, "items"), "flag", "l_quantity", ["l_discount", "l_tax"],
        keep=0.7, buckets=256, rank_rows=1000,
    )
    keys = ["flag", "l_quantity", "l_discount", "l_tax"]
    return kept.groupBy(*keys).agg(F.sum("copies").alias("copies"))


# --- clustering --------------------------------------------------------------------------


def assign_nearest(spark, sf):
    points = rows.where_in_range(tables.cells(spark, sf), CLUSTERED)
    near = clustering.assign_nearest(points, cells.MARKERS, MODEL)
    sums = near.groupBy("cluster_id").agg(
        F.count("*").alias("n"), F.avg("dist").alias("dist"), F.max("dist").alias("farthest")
    )
    return rounded(sums, "dist", "farthest")


def assign_nearest_of_many(spark, sf):
    """More centroids than are compiled, so distances are taken batch by batch."""
    model = [(i, [0.1 * i, 0.07 * i, 3.0 - 0.1 * i]) for i in range(1, 31)]
    near = clustering.assign_nearest(tables.cells(spark, sf), cells.MARKERS, model)
    return folds.count_by(near, "cluster_id")


def centres(spark, sf):
    """One round: a mean per cluster."""
    points = rows.where_in_range(tables.cells(spark, sf), CLUSTERED)
    near = clustering.assign_nearest(points, cells.MARKERS, MODEL)
    return rounded(clustering.centres(near, cells.MARKERS), *cells.MARKERS)


def random_clusters(spark, sf):
    """Seeded random first centroids."""
    points = rows.where_in_range(tables.cells(spark, sf), CLUSTERED)
    clusters = clustering.kmeans(points, cells.MARKERS, RANDOM, 3)
    return rounded(clusters, *cells.MARKERS)


def many_clusters(spark, sf):
    """More centroids than are compiled, over rounds that keep bounds between them."""
    points = rows.where_in_range(tables.cells(spark, sf), CLUSTERED)
    clusters = rounded(clustering.kmeans(points, cells.MARKERS, RANDOM_MANY, 4), *cells.MARKERS)
    return clusters.withColumns({c: F.round(c, 4) for c in cells.MARKERS})


# --- itemsets ----------------------------------------------------------------------------


def frequent_pairs(spark, sf):
    """Pairs of suppliers in one order in 5,000, out of as many as there are pairs of suppliers."""
    items = tables.table(spark, sf, "lineitem")
    sets = itemsets.frequent_itemsets(items, "l_orderkey", "l_suppkey", 0.0002, 2)
    return sets.where(F.size("items") == 2).select(joined("items").alias("items"), "support")


def basket_fragments(spark, sf):
    """Parts bought by a customer, about five to a fragment: fragments and the items in them."""
    pairs = tables.table(spark, sf, "orders").join(
        tables.table(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")
    )
    parts = itemsets.basket_fragments(pairs, "o_custkey", "l_partkey", 5)
    return parts.groupBy("o_custkey").agg(
        F.sum(F.size("items")).alias("n"), F.max(F.size("items") > 0).alias("filled"),
        (F.countDistinct("fragment") == F.count(F.lit(1))).alias("numbered"),
    )


def frequent_itemsets(spark, sf):
    """Sets of part types bought together."""
    pairs = tables.table(spark, sf, "lineitem").join(
        tables.table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    sets = itemsets.frequent_itemsets(pairs, "l_orderkey", "p_type", 0.001)
    return sets.select(joined("items").alias("items"), "support")


def count_sets(spark, sf):
    """In how many of all orders the sets of the urgent orders occur."""
    counts = itemsets.count_sets(
        _sets(spark, sf), tables.order_expression(spark, sf), "patientid", "geneid"
    )
    return counts.select(joined("items").alias("items"), "support")


def recounted_rules(spark, sf):
    """Rules of the sets of urgent orders, with antecedents counted in all orders."""
    pairs = tables.order_expression(spark, sf)
    rules = genes.gene_rules(_sets(spark, sf), CONFIDENCE, pairs)
    return rounded(
        rules.select(joined("antecedent").alias("antecedent"),
                     joined("consequent").alias("consequent"), "confidence"),
        "confidence",
    )


def proper_subsets(spark, sf):
    """Of how many frequent sets a set is a proper part."""
    subsets = _sets(spark, sf).select(F.explode(itemsets.proper_subsets(F.col("items"))).alias("items"))
    return folds.count_by(subsets.select(joined("items").alias("items")), "items")


def association_rules(spark, sf):
    """All rules between part types, without a bound on the confidence."""
    pairs = tables.table(spark, sf, "lineitem").join(
        tables.table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    sets = written(itemsets.frequent_itemsets(pairs, "l_orderkey", "p_type", 0.001), "sets")
    rules = itemsets.association_rules(sets, 0.0)
    return rounded(
        rules.select(joined("antecedent").alias("antecedent"),
                     joined("consequent").alias("consequent"), "confidence"),
        "confidence",
    )


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        photos_per_locality, top_localities, locality_tags, top_tags_per_locality,
        measurements_per_researcher, cell_clusters, cell_clusters_trimmed,
        genre_average_rating, cancers_with_active_gene, gene_itemsets, gene_rules,
        scan_photos, scan_places, min_fields, scan_key_counts, scan_tag_counts, scan_many,
        scan_measurements, scan_cells, scan_experiments, scan_clusters, scan_ratings,
        scan_movies, scan_expression, scan_patients, scan_itemsets,
        write_key_values, write_single_file, write_itemsets, write_rules, write_csv,
        job_output, job_preview,
        locality_name, flag_in_range, where_in_range, where_at_least, where_member,
        explode_list, strip_year, drop_self_tags, feature_vector,
        count_by_lookup, sum_by_partner, count_distinct, distinct_items, to_baskets,
        min_support, most_rated_titles, top_n_per_group, first_rows, kept_per_group,
        trim_group_tail, assign_nearest, assign_nearest_of_many, centres, random_clusters,
        many_clusters, frequent_pairs, basket_fragments, frequent_itemsets, count_sets, recounted_rules, proper_subsets, association_rules,
    )
}
