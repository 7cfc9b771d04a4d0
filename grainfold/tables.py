"""The given Parquet tables in the shapes the queries expect (see TESTDATA.md).

Every function takes a session and a table folder and returns a lazy projection, so column
pruning and filters reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# fixed values: the columns of the given tables; reading them needs no look into the files
COLUMNS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def places(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as places; sizes 7 and 22 act as the kept place types."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("place_id"),
        F.concat_ws(", ", "p_name", "p_brand", "p_type").alias("place_name"),
        F.col("p_size").alias("place_type_id"),
    )


def photos(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as photos of the part they order, tagged from their other columns."""
    year = F.year("l_shipdate").cast("string")
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("place_id"),
        F.concat_ws(
            " ",
            "l_returnflag",
            year,
            F.concat(F.lit("y"), year),
            "l_linestatus",
            F.concat(F.lit("q"), F.col("l_quantity").cast("int").cast("string")),
            F.concat(F.lit("Supplier"), F.col("l_suppkey").cast("string")),
            "l_linestatus",
        ).alias("tags"),
        F.col("l_shipdate").cast("date").cast("string").alias("date_taken"),
    )


def cells(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as measurements of the sample (order) they belong to."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("sample"),
        F.col("l_extendedprice").alias("fsc_a"),
        F.col("l_quantity").alias("ssc_a"),
        (F.col("l_extendedprice") / 35000).alias("ly6c"),
        (F.col("l_quantity") / 17).alias("cd11b"),
        (F.col("l_discount") * 30).alias("sca1"),
    )


def experiments(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("sample"),
        F.concat_ws("; ", "o_orderpriority", "o_orderstatus").alias("researchers"),
    )


def movies(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("movie_id"),
        F.col("p_name").alias("title"),
        F.concat_ws("|", "p_type", "p_brand").alias("genres"),
    )


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("movie_id"), F.col("l_quantity").alias("rating")
    )


def user_expression(spark: SparkSession, folder: str) -> DataFrame:
    """Events as expression readings: the user is the patient, the event type the gene."""
    return table(spark, folder, "events").select(
        F.col("user_id").alias("patientid"),
        F.col("event_type").alias("geneid"),
        F.col("value").alias("expression"),
    )


def user_patients(spark: SparkSession, folder: str) -> DataFrame:
    nation = F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"))
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.concat_ws(" ", "c_mktsegment", nation).alias("diseases")
    )


def order_expression(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as expression readings: the order is the patient, the discount the gene."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("patientid"),
        F.round(F.col("l_discount") * 100).cast("int").alias("geneid"),
        F.col("l_quantity").alias("expression"),
    )


def order_patients(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("diseases")
    )
