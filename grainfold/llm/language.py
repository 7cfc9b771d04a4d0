"""Language of a text in two steps: the family, then pairwise linear SVMs within it.

All models are linear in hashed character n-gram frequencies and are trained on a bounded sample of
labelled documents. A text gets the best-scored family (one SVM against the rest each) and, within
a family of several languages, the language that wins most one-versus-one SVMs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainfold.llm.words import small_batches
from grainfold.session import written

#: Documents of each language that the models are trained on, at most about so many.
SAMPLE = 1_000
BITS = 12
EPOCHS = 12
PENALTY = 1e-4

#: Families of ISO 639-1 codes. Other values form a family of their own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy lb af".split(),
    "romance": "fr es it pt ro ca gl oc".split(),
    "slavic": "ru uk be pl cs sk bg sr hr sl mk".split(),
    "turkic": "tr az kk uz tk ky".split(),
    "indic": "hi bn pa mr gu ur ne".split(),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}


def ngrams(text: str) -> np.ndarray:
    """Frequencies of the hashed 1- to 3-byte runs of the lower-cased text, as a unit vector."""
    size = 1 << BITS
    raw = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    counts = np.zeros(size, np.float32)
    # long texts in blocks: memory stays bounded, and every run counts once
    for at in range(0, len(raw), 1 << 20):
        codes = raw[at : at + (1 << 20) + 2].astype(np.uint32)
        n = min(1 << 20, len(raw) - at)
        run = np.zeros(len(codes), np.uint32)
        for k in range(3):
            run = run[: len(codes) - k] * np.uint32(257) + codes[k:] + np.uint32(1)
            slots = (run[:n] * np.uint32(2654435761) + np.uint32(k * 977)) >> np.uint32(32 - BITS)
            counts += np.bincount(slots, minlength=size)
    counts = np.sqrt(counts)
    return counts / max(float(np.linalg.norm(counts)), 1e-9)


def svm(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Weights and, last, the bias of a linear SVM with squared hinge loss, by gradient steps.

    Both sides weigh the same however many rows they have.
    """
    y = np.where(positive, 1.0, -1.0).astype(np.float32)
    share = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum())).astype(np.float32)
    w, bias, speed, pace = np.zeros(x.shape[1], np.float32), 0.0, np.zeros(x.shape[1], np.float32), 0.0
    for _ in range(EPOCHS * 10):
        slack = np.maximum(0, 1 - y * (x @ w + bias))
        pull = share * y * slack
        speed = 0.9 * speed + (pull @ x - PENALTY * w)
        pace = 0.9 * pace + float(pull.sum())
        w, bias = w + 0.5 * speed, bias + 0.5 * pace
    return np.append(w, bias).astype(np.float32)


@dataclass
class LanguageModel:
    """Families with their languages, a scorer per family, and one per pair within a family."""

    families: list[list[str]]
    of_family: np.ndarray
    pairs: dict[tuple[str, str], np.ndarray]

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        scores = self.of_family[:, :-1] @ x + self.of_family[:, -1]
        best = int(np.argmax(scores))
        sure = 1 / (1 + np.exp(-4 * float(scores[best]))) if len(scores) > 1 else 1.0
        names = self.families[best]
        wins = dict.fromkeys(names, 0)
        margins = dict.fromkeys(names, 0.0)
        for a, b in itertools.combinations(names, 2):
            w = self.pairs[a, b]
            margin = float(w[:-1] @ x + w[-1])
            wins[a if margin >= 0 else b] += 1
            margins[a] += margin
            margins[b] -= margin
        name = max(names, key=lambda n: (wins[n], margins[n], n))
        if len(names) > 1:
            sure *= 1 / (1 + np.exp(-4 * margins[name] / (len(names) - 1)))
        return name, float(min(1.0, max(0.0, sure)))


def train(docs: DataFrame, learnable: Column, per_language: int = SAMPLE) -> LanguageModel | None:
    """Train on about ``per_language`` documents of each language, chosen by a hash of their ids.

    ``learnable`` says which rows may be learned from; those without text or lang never are. None
    if nothing is left to learn from. Runs jobs.
    """
    rows = docs.where(learnable).where("text is not null and lang is not null")
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return None
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col("lang") == name, min(1.0, per_language / n)).otherwise(share)
    chosen = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                vectors = [ngrams(t).astype(np.float16).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(vectors, pa.binary())], ["lang", "x"])

    table = written(chosen.select("lang", "text").mapInArrow(run, "lang string, x binary"), "sample")
    # at most about per_language vectors of 2 ** BITS half floats for each language
    sample = table.collect()
    names = sorted({r.lang for r in sample})
    if not names:
        return None
    x = np.array([np.frombuffer(r.x, np.float16) for r in sample]).astype(np.float32)
    y = np.array([r.lang for r in sample])
    groups: dict[str, list[str]] = {}
    for name in names:
        groups.setdefault(FAMILY_OF.get(name.lower().split("-")[0], name), []).append(name)
    families = list(groups.values())
    of_family = np.array([svm(x, np.isin(y, own)) for own in families])
    pairs = {}
    for own in families:
        for a, b in itertools.combinations(own, 2):
            both = (y == a) | (y == b)
            pairs[a, b] = svm(x[both], y[both] == a)
    return LanguageModel(families, of_family, pairs)


def with_language(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """Add lang_pred and score (0 to 1) to (doc_id, held_out, text), without the text.

    ``und`` with score 0 where the text is null, empty or has no letters, or nothing could be learned.
    Only the whole text is looked at, so repeated rows and null ids need no care.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                found = [
                    model.predict(ngrams(t)) if ok and model else ("und", 0.0)
                    for t, ok in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
                ]
                names, scores = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = docs.select("doc_id", "held_out", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def languages(docs: DataFrame, fold: Column) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; rows of fold 0 are not learned from."""
    small_batches(docs.sparkSession)
    model = train(docs, fold != 0)
    return with_language(docs.select(F.col("doc_id").cast("long"), (fold == 0).alias("held_out"), "text"), model)
