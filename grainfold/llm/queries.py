"""One query per operator, on the given tables in full."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainfold.llm import (
    alignment, ann, bitplanes, chat, decontaminate, katz, language, minhash, packing, pii, records, suffixes,
    toxicity,
)
from grainfold.llm.words import fold, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def op1_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return ann.search(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"), TOKENIZER)


def op3_language(spark: SparkSession, sf: str) -> DataFrame:
    return language.languages(table(spark, sf, "documents"), fold("doc_id"))


def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.graded(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op5_katz(spark: SparkSession, sf: str) -> DataFrame:
    return katz.scores(table(spark, sf, "documents"), fold("doc_id") != 1)


def op6_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf, "documents"))


def op7_repeats(spark: SparkSession, sf: str) -> DataFrame:
    return suffixes.without_repeats(table(spark, sf, "documents")).drop("kept")


def op8_chat(spark: SparkSession, sf: str) -> DataFrame:
    return chat.conversations(table(spark, sf, "conversations"))


def op9_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.hit_report(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op10_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.span_report(table(spark, sf, "documents"))


def op11_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.aligned(table(spark, sf, "documents"), TOKENIZER, PIECES)


def op12_bitplanes(spark: SparkSession, sf: str) -> DataFrame:
    return bitplanes.clusters(table(spark, sf, "embeddings"))


def op13_records(spark: SparkSession, sf: str) -> DataFrame:
    return records.record_report(records.stored_documents(table(spark, sf, "documents"), WORDS, end=2))


QUERIES = {
    "op1_nearest": op1_nearest,
    "op2_packing": op2_packing,
    "op3_language": op3_language,
    "op4_toxicity": op4_toxicity,
    "op5_katz": op5_katz,
    "op6_minhash": op6_minhash,
    "op7_repeats": op7_repeats,
    "op8_chat": op8_chat,
    "op9_decontamination": op9_decontamination,
    "op10_pii": op10_pii,
    "op11_alignment": op11_alignment,
    "op12_bitplanes": op12_bitplanes,
    "op13_records": op13_records,
}
