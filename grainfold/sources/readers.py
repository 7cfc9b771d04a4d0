"""Readers: text in, typed DataFrames out.

Rows whose numbers do not parse are dropped, or raise with ``strict=True``. Files with a
fixed layout go through the CSV source, which parses only the columns a query needs; files
with lines of different width go through the text source.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainfold.functions.numbers import all_finite
from grainfold.functions.text import field_count, split_fields

Path = str | list[str]
Layout = dict[str, str]

# fixed values: column names and types by position
PHOTO: Layout = {
    "photo_id": "string", "owner": "string", "tags": "string",
    "date_taken": "string", "place_id": "string", "accuracy": "string",
}
PLACE: Layout = {
    "place_id": "string", "woeid": "string", "longitude": "string", "latitude": "string",
    "place_name": "string", "place_type_id": "int", "place_url": "string",
}
KEY_COUNT: Layout = {"key": "string", "n": "bigint"}
MEASUREMENT: Layout = {
    "sample": "string", "fsc_a": "int", "ssc_a": "int", "cd48": "string", "ly6g": "string",
    "cd117": "string", "sca1": "double", "cd11b": "double", "cd150": "string",
    "unnamed_9": "string", "unnamed_10": "string", "ly6c": "double",
}
EXPERIMENT: Layout = {
    "sample": "string", "date": "string", "experiment": "string", "day": "string",
    "subject": "string", "kind": "string", "instrument": "string", "researchers": "string",
}
CLUSTER: Layout = {
    "cluster_id": "int", "n": "bigint", "ly6c": "double", "cd11b": "double", "sca1": "double",
}
RATING: Layout = {
    "movie_id": "string", "user_id": "string", "rating": "double", "timestamp": "string",
}
EXPRESSION: Layout = {"patientid": "string", "geneid": "int", "expression": "double"}
PATIENT: Layout = {
    "id": "string", "age": "string", "gender": "string", "postcode": "string",
    "diseases": "string", "drug_response": "string",
}


def _typed(
    rows: DataFrame, texts: Iterable[tuple[str, Column, str]], strict: bool
) -> DataFrame:
    """Select ``(name, text, type)`` columns; number columns must parse."""
    columns, numbers = [], []
    for name, text, type_ in texts:
        if type_ != "string":
            text = text.cast(type_) if strict else text.try_cast(type_)
            numbers.append(F.col(name).isNotNull())
        columns.append(text.alias(name))
    typed = rows.select(*columns)
    return typed.where(reduce(and_, numbers)) if numbers else typed


def _csv(
    spark: SparkSession,
    path: Path,
    sep: str,
    layout: Layout,
    need: Sequence[str],
    strict: bool,
    header: str | None = None,
    min_fields: int = 0,
) -> DataFrame:
    """Columns ``need`` of an unquoted CSV; lines with ``header`` in front are dropped.

    With ``min_fields`` a line needs that many fields, not counting empty ones at the end:
    some field from there on is not empty.
    """
    texts = ", ".join(f"{name} string" for name in layout)
    rows = spark.read.csv(path, schema=texts, sep=sep, quote="")
    if header is not None:
        first = next(iter(layout))
        rows = rows.where(F.coalesce(F.col(first), F.lit("")) != header)
    if min_fields:
        rows = rows.where(F.coalesce(*list(layout)[min_fields - 1 :]).isNotNull())
    return _typed(rows, [(name, F.col(name), layout[name]) for name in need], strict)


def read_photos(spark: SparkSession, path: Path) -> DataFrame:
    """Photos with at least five fields; missing texts are empty."""
    return _csv(spark, path, "\t", PHOTO, list(PHOTO), strict=False, min_fields=5).fillna("")


def read_places(
    spark: SparkSession, path: Path, min_fields: int = 7, strict: bool = False
) -> DataFrame:
    """Places with at least ``min_fields`` fields; missing texts are empty."""
    rows = _csv(spark, path, "\t", PLACE, list(PLACE), strict, min_fields=min_fields)
    return rows.fillna("")


def read_key_counts(
    spark: SparkSession, path: Path, key: str = "locality", n: str = "n_photos",
    strict: bool = False,
) -> DataFrame:
    rows = _csv(spark, path, "\t", KEY_COUNT, list(KEY_COUNT), strict)
    return rows.withColumnsRenamed({"key": key, "n": n})


def read_tag_counts(spark: SparkSession, path: Path, strict: bool = False) -> DataFrame:
    """``locality, tag, n`` from lines ``locality<tab>tag:n,tag:n,``; tags may hold colons."""
    line = split_fields(F.col("value"), "\t")
    packed = spark.read.text(path).select(
        F.get(line, F.lit(0)).alias("locality"), F.get(line, F.lit(1)).alias("packed")
    )
    entries = packed.select("locality", F.explode(split_fields(F.col("packed"), ",")).alias("e"))
    count = F.substring_index("e", ":", -1)
    tag = F.substr("e", F.lit(1), F.length("e") - F.length(count) - 1)
    entries = entries.where(F.instr("e", ":") > 0)
    return _typed(
        entries,
        [("locality", F.col("locality"), "string"), ("tag", tag, "string"), ("n", count, "bigint")],
        strict,
    )


def read_measurements(spark: SparkSession, path: Path, strict: bool = False) -> DataFrame:
    """The columns the cell queries share: sample and the two scatter channels."""
    need = ["sample", "fsc_a", "ssc_a"]
    return _csv(spark, path, ",", MEASUREMENT, need, strict, header="sample")


def read_cells(spark: SparkSession, path: Path, strict: bool = False) -> DataFrame:
    """Scatter channels and the three markers that are clustered.

    Rows with a marker that is NaN or infinite are dropped.
    """
    need = ["sample", "fsc_a", "ssc_a", "ly6c", "cd11b", "sca1"]
    cells = _csv(spark, path, ",", MEASUREMENT, need, strict, header="sample")
    return cells.where(all_finite(["ly6c", "cd11b", "sca1"]))


def read_experiments(spark: SparkSession, path: Path) -> DataFrame:
    """Rows without researchers are dropped."""
    rows = _csv(spark, path, ",", EXPERIMENT, ["sample", "researchers"], False, header="sample")
    return rows.where(F.col("researchers").isNotNull())


def read_clusters(spark: SparkSession, path: Path, strict: bool = False) -> DataFrame:
    return _csv(spark, path, "\t", CLUSTER, list(CLUSTER), strict)


def read_ratings(
    spark: SparkSession, path: Path, strict: bool = False, header: str | None = None
) -> DataFrame:
    return _csv(spark, path, ",", RATING, ["movie_id", "rating"], strict, header)


def read_movies(spark: SparkSession, path: Path) -> DataFrame:
    """``movie_id, title, genres``; titles may hold commas, genres follow the last one."""
    lines = spark.read.text(path).where(field_count(F.col("value"), ",") >= 3)
    return lines.select(split_fields(F.col("value"), ",").alias("f")).select(
        F.get("f", F.lit(0)).alias("movie_id"),
        F.array_join(F.slice("f", F.lit(2), F.size("f") - 2), ",").alias("title"),
        F.element_at("f", -1).alias("genres"),
    )


def read_expression(spark: SparkSession, path: Path, strict: bool = False) -> DataFrame:
    return _csv(spark, path, ",", EXPRESSION, list(EXPRESSION), strict, header="patientid")


def read_patients(spark: SparkSession, path: Path) -> DataFrame:
    rows = _csv(spark, path, ",", PATIENT, ["id", "diseases"], strict=False)
    return rows.where(F.col("diseases").isNotNull())


def read_itemsets(spark: SparkSession, path: Path, strict: bool = False) -> DataFrame:
    """``items, support`` from lines ``support<tab>item<tab>item...``."""
    lines = spark.read.text(path).where(field_count(F.col("value"), "\t") >= 2)
    fields = lines.select(split_fields(F.col("value"), "\t").alias("f"))
    items = F.slice("f", F.lit(2), F.size("f") - 1)
    if strict:
        numbers = items.cast("array<int>")
    else:
        numbers = F.transform(items, lambda item: item.try_cast("int"))
    support = F.get("f", F.lit(0))
    rows = _typed(
        fields, [("items", numbers, "array<int>"), ("support", support, "bigint")], strict
    )
    return rows.where(~F.exists("items", lambda item: item.isNull()))
