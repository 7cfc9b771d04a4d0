"""Cancers with an active gene, and itemsets and rules of active genes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainfold.operators.folds import count_by, sum_by_partner
from grainfold.operators.itemsets import (
    association_rules,
    frequent_itemsets,
    set_counter,
)
from grainfold.operators.rows import explode_list, where_at_least, where_member
from grainfold.session import written

# fixed values: the cancers looked for, the gene, and the expression of an active gene
CANCERS = ["breast-cancer", "prostate-cancer", "pancreatic-cancer", "leukemia", "lymphoma"]
GENE = 42
ACTIVE = 1250000


def cancer_patients(patients: DataFrame, cancers: Sequence[str] = CANCERS) -> DataFrame:
    """``id, disease``, one row per listed cancer."""
    diseases = explode_list(patients.select("id", "diseases"), "diseases", " ", "disease")
    return where_member(diseases, "disease", cancers)


def cancers_with_active_gene(
    expression: DataFrame,
    patients: DataFrame,
    gene: int | str = GENE,
    active: float = ACTIVE,
    cancers: Sequence[str] = CANCERS,
) -> DataFrame:
    """``disease, n``: active readings of the gene among patients with each cancer."""
    readings = where_at_least(expression.where(F.col("geneid") == gene), "expression", active)
    per_patient = count_by(readings, "patientid")
    listed = cancer_patients(patients, cancers).withColumnRenamed("id", "patientid")
    counts = sum_by_partner(per_patient, listed, "patientid", "disease", ["n"])
    return counts.orderBy(F.desc("n"), "disease")


def active_genes(
    expression: DataFrame,
    patients: DataFrame,
    active: float = ACTIVE,
    cancers: Sequence[str] = CANCERS,
) -> DataFrame:
    """``patientid, geneid``: the distinct active genes of each cancer patient."""
    readings = where_at_least(expression, "expression", active).select("patientid", "geneid")
    ill = cancer_patients(patients, cancers).select(F.col("id").alias("patientid")).distinct()
    return readings.distinct().join(ill, "patientid", "left_semi")


def gene_itemsets(
    expression: DataFrame,
    patients: DataFrame,
    support: float = 0.3,
    max_size: int = 10,
    active: float = ACTIVE,
    cancers: Sequence[str] = CANCERS,
) -> DataFrame:
    """``support, items`` by falling support"""
    pairs = active_genes(expression, patients, active, cancers)
    sets = frequent_itemsets(pairs, "patientid", "geneid", support, max_size)
    return sets.select("support", "items").orderBy(F.desc("support"), "items")


def gene_rules(
    itemsets: DataFrame, confidence: float = 0.6, pairs: DataFrame | None = None
) -> DataFrame:
    """``antecedent, consequent, confidence`` by falling confidence

    With ``pairs``, as from ``active_genes``, antecedents are counted over the patients, so
    that ``itemsets`` may be any selection of sets; without, they are looked up in it.
    """
    itemsets = written(itemsets, "itemsets")
    supports = None if pairs is None else set_counter(pairs, "patientid", "geneid")
    rules = association_rules(itemsets, confidence, supports)
    return rules.orderBy(F.desc("confidence"), "antecedent", "consequent")
