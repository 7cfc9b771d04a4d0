"""Writers: DataFrames out as text lines."""

from __future__ import annotations

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainfold.session import written


def key_value_lines(rows: DataFrame, *columns: str) -> DataFrame:
    """Values joined by tabs; a null value leaves out its tab too."""
    columns = columns or tuple(rows.columns)
    return rows.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in columns]).alias("value"))


def packed_tag_lines(tag_counts: DataFrame, tags_per_line: int = 1000) -> DataFrame:
    """``locality<tab>tag:n,tag:n,``, one line per locality if it has few tags.

    A reader adds up the lines of a locality, so the tags of a popular one are spread by
    their hash over as many lines as keep each at about ``tags_per_line``.
    """
    tag_counts = written(tag_counts, "tags")
    sizes = tag_counts.groupBy("locality").agg(F.count(F.lit(1)).alias("size"))
    lines = F.ceil(F.col("size") / tags_per_line)
    several = sizes.where(F.col("size") > tags_per_line).select("locality", lines.alias("lines"))
    spread = tag_counts.join(written(several, "lines"), "locality", "left")
    line = F.pmod(F.xxhash64("tag"), F.coalesce("lines", F.lit(1))).alias("line")
    entry = F.concat("tag", F.lit(":"), F.col("n").cast("string"), F.lit(","))
    packed = spread.groupBy("locality", line).agg(
        F.array_join(F.array_sort(F.collect_list(entry)), "").alias("packed")
    )
    return packed.select(F.concat_ws("\t", "locality", "packed").alias("value"))


def itemset_lines(itemsets: DataFrame) -> DataFrame:
    return itemsets.select(
        F.concat_ws("\t", F.col("support").cast("string"), F.col("items").cast("array<string>"))
        .alias("value")
    )


def rule_lines(rules: DataFrame) -> DataFrame:
    """``a1 a2 <tab>c1 <tab>confidence``, every item followed by a blank."""

    def blank_after(items: str):
        return F.concat(F.array_join(F.col(items).cast("array<string>"), " "), F.lit(" "))

    return rules.select(
        F.concat_ws(
            "\t",
            blank_after("antecedent"),
            blank_after("consequent"),
            F.col("confidence").cast("string"),
        ).alias("value")
    )


def _join_parts(spark: SparkSession, path: str) -> None:
    """Make one file of the part files of a folder, in their order, on its file system.

    Stores that can concatenate files do so without moving data; for others the bytes are
    streamed through a buffer.
    """
    hadoop = spark._jvm.org.apache.hadoop
    folder = hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [status.getPath() for status in store.listStatus(folder)]
    parts = sorted((p for p in found if p.getName().startswith("part-")), key=lambda p: (len(p.getName()), p.getName()))
    if len(parts) < 2:
        return
    try:
        others = spark.sparkContext._gateway.new_array(hadoop.fs.Path, len(parts) - 1)
        for i, part in enumerate(parts[1:]):
            others[i] = part
        store.concat(parts[0], others)
    except UnsupportedOperationException:
        joined = hadoop.fs.Path(folder, "_joined")
        whole = store.create(joined)
        for part in parts:
            source = store.open(part)
            hadoop.io.IOUtils.copyBytes(source, whole, 1 << 20, False)
            source.close()
        whole.close()
        for part in parts:
            store.delete(part, False)
        store.rename(joined, parts[0])


def write_lines(lines: DataFrame, path: str, single_file: bool = False) -> None:
    """Text lines; as one file they are written in parallel and joined in the order of the partitions.

    So a sorted table gives one sorted file, and no task sees more than its partition.
    """
    lines.write.text(path)
    if single_file:
        _join_parts(lines.sparkSession, path)


def write_csv(rows: DataFrame, path: str, single_file: bool = False) -> None:
    rows.write.csv(path)
    if single_file:
        _join_parts(rows.sparkSession, path)


def preview(rows: DataFrame, n: int = 100) -> None:
    """Print the first rows, for jobs without an output path."""
    rows.show(n, truncate=False)
