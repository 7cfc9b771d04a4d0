"""Sessions for local runs and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def local_session(cores: int | str = "*", **settings: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("grainfold")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="grainfold-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own;
    on a cluster a machine-local folder would lose tables with the machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = _own_folder()
    return folder.rstrip("/")


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/grainfold/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{_application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result has no lineage, outlives lost executors, scans columns only as far as
    they are needed, and has a measured size from which Spark decides on broadcasts.
    """
    return written_at(df, new_path(df.sparkSession, label))


def written_at(df: DataFrame, path: str) -> DataFrame:
    """The same at a path of the caller, for tasks that read its files themselves."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession) -> None:
    """Delete the tables this application has written for itself.

    For the end of a job, after its result is stored: DataFrames that still read from them
    do not work any more.
    """
    drop_path(spark, _application_folder(spark))


def drop_path(spark: SparkSession, folder: str) -> None:
    """Delete what ``written_at`` has written there, when nothing reads from it any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: StructType) -> DataFrame:
    """A small table from rows on the driver.

    Coming from Arrow, it is part of the plan and its exact size is known, so that Spark
    broadcasts it; rows given as Python tuples would count as a table of unknown size, and
    the other side of a join would be shuffled.
    """
    columns = {field.name: [row[i] for row in rows] for i, field in enumerate(schema)}
    return spark.createDataFrame(pa.table(columns), schema)
