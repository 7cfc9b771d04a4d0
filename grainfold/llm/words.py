"""Column expressions and small helpers that several operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same for texts that have not been lowered.
NOT_ALNUM_CASED = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Hand texts to Python in batches of few documents, unless the session sets a size itself.

    Spark's default of 10,000 rows is meant for numbers; as many texts are held by the JVM, by
    Arrow and by the Python worker at a time.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, rows)


#: Characters beyond ASCII that ``lower`` might change: all but those known to have no lower case.
CASED = r"[^\x00-\x7F\p{Ll}\p{Lo}\p{Nd}\p{P}\p{Z}\p{Sm}\p{Sc}]"


def lowered(text: Column) -> Column:
    """A-Z to lower case; all other letters stay.

    ``translate`` is several times slower than ``lower`` and only needed where ``lower`` would go further.
    """
    plain = (F.octet_length(text) == F.char_length(text)) | ~text.rlike(CASED)
    every = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(plain, F.lower(text)).otherwise(every)


def words(text: Column, breaks: str = SPACES) -> Column:
    """The words of the lowered text; none for null."""
    split = F.array_remove(F.split(lowered(text), breaks), "")
    return F.coalesce(split, F.array().cast("array<string>"))


def word_count(text: Column, breaks: str = SPACES) -> Column:
    """Number of ``words``, without lowering the text; 0 for null. ``breaks`` must treat both cases alike."""
    split = F.split(text, breaks)
    # only the first and the last piece can be empty; a text without a break is one piece, both first and last
    edges = (split[0] == "").cast("int") + ((F.size(split) > 1) & (F.element_at(split, -1) == "")).cast("int")
    return F.coalesce(F.size(split) - edges, F.lit(0))


def fold(doc_id: str) -> Column:
    """crc32 of the id as text, modulo 5; null ids fall in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5, F.lit(0))
