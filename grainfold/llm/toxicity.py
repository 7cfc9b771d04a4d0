"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

One weight vector is shared by all thresholds: P(grade <= k) = sigmoid(threshold_k - w . x) with
increasing thresholds. The model is fitted on a bounded sample of labelled documents and then
applied to every whole text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from grainfold.llm.words import small_batches
from grainfold.session import written

#: Labelled documents that the model is fitted on, at most about so many of each class.
SAMPLE = 4_000
#: Features kept: those of the strongest association with the label.
FEATURES = 512
LEAST_DOCS = 4
LEAST_G = 20.0
PREFIXES = (4, 5, 6)
GRADES = 4
REJECT = 0.3
STEPS = 400
PENALTY = 1e-4

WORD = regex.compile(r"\p{L}+")


def terms(text: str) -> Counter:
    """Occurrences of the words of a text, in lower case, and of their beginnings (marked *)."""
    counts = Counter(WORD.findall(text.lower()))
    for word, n in list(counts.items()):
        for size in PREFIXES:
            if len(word) > size:
                counts[word[:size] + "*"] += n
    return counts


@dataclass
class Model:
    """Thresholds and the weight of each term. Without terms everything has severity 0."""

    weights: dict[str, float]
    thresholds: np.ndarray

    def severity(self, texts: list[str]) -> np.ndarray:
        """P(grade >= k) for k = 1 .. per row; their sum is the expected grade."""
        if not len(self.thresholds):
            return np.zeros((len(texts), 1))
        known = self.weights
        scores = np.array([
            sum(known[t] * np.log1p(n) for t, n in terms(text).items() if t in known) for text in texts
        ])
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -60, 60)))


def _sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """(doc_id, text, toxic): about ``per_class`` labelled documents of each class.

    A document of several labels is toxic if one of them says so. Whether a document is taken
    depends on the hash of its id only.
    """
    flags = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
    flags = written(flags.agg(F.max(F.col("toxic").cast("int")).alias("toxic")), "flags")
    sizes = {r.toxic: r["count"] for r in flags.groupBy("toxic").count().collect()}
    share = F.lit(0.0)
    for flag, n in sizes.items():
        share = F.when(F.col("toxic") == flag, min(1.0, per_class / n)).otherwise(share)
    # written, so that its size is known and the texts are not shuffled for a few thousand ids
    chosen = written(flags.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000), "chosen")
    own = docs.where("text is not null").select(F.col("doc_id").cast("long"), "text")
    return own.join(chosen, "doc_id").select("doc_id", "text", "toxic")


def _sparse(sample: DataFrame) -> DataFrame:
    """One row per document and term, of long documents too: whole texts are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                docs, texts, flags = (c.to_pylist() for c in whole.slice(at, 256).columns)
                found = [terms(text) for text in texts]
                sizes = [len(f) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.array(docs, np.int64), sizes)),
                     pa.array(np.repeat(np.array(flags, np.int32), sizes)),
                     pa.array([t for f in found for t in f], pa.string()),
                     pa.array([n for f in found for n in f.values()], pa.int64())],
                    ["doc_id", "toxic", "term", "n"],
                )

    return sample.mapInArrow(run, "doc_id long, toxic int, term string, n long")


def _associated(sparse: DataFrame, sizes: dict[int, int], features: int) -> list[tuple[str, int]]:
    """The terms most associated with the label by the G statistic, and their direction."""
    toxic, clean = float(sizes.get(1, 0)), float(sizes.get(0, 0))
    total = toxic + clean
    held = sparse.groupBy("term").agg(
        F.sum((F.col("toxic") == 1).cast("double")).alias("a"), F.sum((F.col("toxic") == 0).cast("double")).alias("b")
    ).where(F.col("a") + F.col("b") >= LEAST_DOCS)

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    a, b = F.col("a"), F.col("b")
    all_of = a + b
    g = 2 * (
        part(a, all_of * toxic / total) + part(b, all_of * clean / total)
        + part(toxic - a, (total - all_of) * toxic / total) + part(clean - b, (total - all_of) * clean / total)
    )
    way = F.when(a * clean > b * toxic, 1).otherwise(-1)
    best = held.select("term", g.alias("g"), way.alias("way")).where(F.col("g") > LEAST_G).orderBy(F.desc("g"), "term")
    return [(r.term, r.way) for r in best.limit(features).collect()]


def ordinal_fit(x: np.ndarray, grades: np.ndarray, n_grades: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and increasing thresholds of the largest penalised likelihood, by Adam.

    Thresholds are the first one plus positive steps, so that they stay ordered.
    """
    n, m = x.shape
    weight = 1 / n
    params = np.concatenate([np.zeros(m), [1.0], np.zeros(n_grades - 2)])
    first, second = np.zeros_like(params), np.zeros_like(params)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    for step in range(1, STEPS + 1):
        gaps = np.exp(params[m + 1 :])
        thresholds = params[m] + np.concatenate([[0.0], np.cumsum(gaps)])
        edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
        score = (x @ params[:m].astype(x.dtype)).astype(float)
        upper, lower = sigmoid(edges[grades + 1] - score), sigmoid(edges[grades] - score)
        upper[grades == n_grades - 1], lower[grades == 0] = 1.0, 0.0
        likely = np.maximum(upper - lower, 1e-9)
        up, low = upper * (1 - upper) / likely * weight, lower * (1 - lower) / likely * weight
        grad_score = up - low
        grad_edge = np.zeros(n_grades - 1)
        np.add.at(grad_edge, np.minimum(grades, n_grades - 2), np.where(grades < n_grades - 1, -up, 0))
        np.add.at(grad_edge, np.maximum(grades - 1, 0), np.where(grades > 0, low, 0))
        after = np.cumsum(grad_edge[::-1])[::-1]
        grad = np.concatenate([grad_score.astype(x.dtype) @ x + PENALTY * params[:m], [after[0]], after[1:] * gaps])
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        params -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    thresholds = params[m] + np.concatenate([[0.0], np.cumsum(np.exp(params[m + 1 :]))])
    return params[:m], thresholds


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE, features: int = FEATURES) -> Model:
    """Fit on at most about ``per_class`` documents of each class. Runs jobs.

    Clean documents have grade 0. Toxic ones are graded 1 to 3 by how many occurrences of toxic terms they hold,
    cut at the terciles of the sample. Without labelled documents of both classes the model finds
    nothing toxic.
    """
    small_batches(docs.sparkSession)
    sample = written(_sample(docs, labels, per_class), "sample")
    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model({}, np.zeros(0))
    sparse = _sparse(sample)
    chosen = _associated(sparse, sizes, features)
    if not chosen:
        return Model({}, np.zeros(0))
    column = {term: k for k, (term, _) in enumerate(chosen)}
    known = list(column)
    own = sparse.where(F.col("term").isin(known))
    # at most 2 * per_class rows of at most ``features`` numbers
    counts = own.groupBy("doc_id").agg(F.collect_list(F.struct("term", "n")).alias("terms"))
    rows = sample.select("doc_id", "toxic").distinct().join(counts, "doc_id", "left").orderBy("doc_id").collect()
    x = np.zeros((len(rows), len(known)), np.float32)
    for i, row in enumerate(rows):
        for term, n in row.terms or []:
            x[i, column[term]] = np.log1p(n)
    toxic = np.array([r.toxic for r in rows])
    bad = np.array([way for _, way in chosen]) > 0
    amount = np.expm1(x[:, bad]).sum(axis=1)
    cuts = np.quantile(amount[toxic == 1], [1 / 3, 2 / 3])
    grades = np.where(toxic == 1, 1 + (amount[:, None] > cuts).sum(axis=1), 0)
    weights, thresholds = ordinal_fit(x, grades, GRADES)
    return Model({t: float(w) for t, w in zip(known, weights)}, thresholds)


def with_severity(docs: DataFrame, model: Model) -> DataFrame:
    """Add p_toxic (grade 1 at least) and severity (expected grade, 0 to 3) to every row.

    Whole texts are scored; null and empty ones have severity 0. Rows are independent: repeated
    rows and null ids need no care. Columns of these two names are replaced.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("p_toxic", "severity")
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                texts = batch.column(at).to_pylist()
                above = model.severity([t or "" for t in texts])
                above[[not t for t in texts]] = 0.0
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(above[:, 0]), pa.array(above.sum(axis=1))],
                    [*batch.schema.names, "p_toxic", "severity"],
                )

    schema = StructType([*docs.schema, StructField("p_toxic", DoubleType()), StructField("severity", DoubleType())])
    return docs.mapInArrow(run, schema)


def graded(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, p_toxic, severity and rejected of every document. Runs jobs when called."""
    own = docs.select(F.col("doc_id").cast("long"), "text")
    scored = with_severity(own, fit(docs, labels)).drop("text")
    return scored.withColumn("rejected", F.col("severity") >= REJECT)


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents of severity ``REJECT`` or more; all columns stay."""
    scored = with_severity(docs, fit(docs, labels))
    return scored.where(F.col("severity") < REJECT).select(*docs.columns)
