"""A corpus through five stages: toxicity, near-duplicates, decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on all documents that its predecessor kept, and
returns a table that is written as Parquet and read again for the next. All stages but the
last return the columns of ``documents``. Documents pass in whatever way their columns are
null, empty or repeated, as the operators say; an empty table gives empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainfold.llm import decontaminate, minhash, packing, pii, toxicity
from grainfold.llm.words import table
from grainfold.session import written

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity is below ``toxicity.REJECT``."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest id, and one row of it.

    Documents without an id are in no group and stay. Several texts under one id are documents of their own.
    """
    named = docs.where("doc_id is not null").withColumn(
        "_digest", F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit("")))
    texts = named.select("doc_id", "_digest").distinct()
    several = not texts.groupBy("doc_id").count().where("count > 1").isEmpty()
    if several:
        # numbers in the order of the ids stand for them
        numbers = written(texts.sort("doc_id", "_digest").withColumn("_key", F.monotonically_increasing_id()), "numbers")
        named = written(named.join(numbers, ["doc_id", "_digest"]), "numbered")
        compared = named.select(F.col("_key").alias("doc_id"), "text")
    else:
        named, compared = named.withColumn("_key", F.col("doc_id")), docs
    kept = minhash.near_duplicates(compared).where("kept and doc_id is not null").select(F.col("doc_id").alias("_key")).distinct()
    named = named.join(kept, "_key", "left_semi").dropDuplicates(["_key"]).select(*docs.columns)
    return named.unionByName(docs.where("doc_id is null"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.without_hits(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind."""
    return pii.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its token ids and its place in a sequence."""
    return packing.pack_documents(docs, TOKENIZER, keep_ids=True)


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: No SQL expresses a fitted model; the tests hold the stages against plain versions of them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
