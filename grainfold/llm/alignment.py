"""Alignment of the tokens of two tokenizers over the same bytes, and corpus-wide counts of linked ids."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainfold.llm.tokens import (
    LINE, Numbered, Ragged, UnitIds, flat, one_thread, simple_first, slices, split_units, sums,
)
from grainfold.llm.words import small_batches
from grainfold.session import written


class Pieces:
    """Ids of units by a piece tokenizer that puts a space in front, and the bytes of its ids."""

    SPACE = "▁"

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(re.search(f"[^{self.SPACE}]{self.SPACE}", name) for name in names):
            raise ValueError(f"{path} has pieces that go across spaces")
        self.bytes = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(i)
            else b"" if self.model.is_control(i) or self.model.is_unknown(i)
            else name.replace(self.SPACE, " ").encode()
            for i, name in enumerate(names)
        ]
        self.byte_ids = np.array([self.model.is_byte(i) for i in range(len(names))])
        self.starts = np.array([name[:1] == self.SPACE for name in names])
        self.space = self.model.piece_to_id(self.SPACE)

    def _simple(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lines = [" ".join(units[at : at + LINE]) for at in range(0, len(units), LINE)]
        ids, _ = flat(self.model.encode(lines, num_threads=1))
        starts = np.flatnonzero(self.starts[ids])
        return ids, np.diff(starts, append=len(ids))

    def _alone(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # an empty text gets no space in front, so a lone space is looked up
        return flat([own or [self.space] for own in self.model.encode(units, num_threads=1)])

    def of_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return simple_first(units, self._simple, self._alone)


def same_bytes(a: UnitIds, b: Pieces) -> np.ndarray:
    """For each id of ``a`` that of ``b`` with the same bytes, -1 without one; pieces go before single-byte ids."""
    of = {own: i for i, own in enumerate(b.bytes) if own and b.byte_ids[i]}
    of.update((own, i) for i, own in enumerate(b.bytes) if own and not b.byte_ids[i])
    return np.array([of.get(own, -1) if own else -1 for own in a.bytes], np.int64)


class Aligner:
    """Tokens, groups and links of units: runs of a space and the text behind it.

    Both tokenizers cut between units, so what holds of a text is put together from its units, and
    every distinct unit is aligned once.
    """

    def __init__(self, path_a: str, path_b: str):
        one_thread()
        self.a, self.b = UnitIds(path_a, special_as_text=True), Pieces(path_b)
        self.same = same_bytes(self.a, self.b)
        self.width = len(self.b.bytes)
        self.length_a = np.fromiter(map(len, self.a.bytes), np.int64)
        self.length_b = np.fromiter(map(len, self.b.bytes), np.int64)
        self.units = Numbered(self._learn, self._forget)

    def _forget(self) -> None:
        self.counts = Ragged(np.int64)  # per unit: fit, n_a, n_b, n_groups, n_links
        self.links = Ragged(np.int64)
        self.groups: list[pa.Array] = []

    def _learn(self, units: list[str]) -> None:
        ids_a, size_a = self.a.of_units(units)
        ids_b, size_b = self.b.of_units(units)
        raw = [b" " + unit.encode() for unit in units]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        fit = (sums(self.length_a[ids_a], size_a) == size) & (sums(self.length_b[ids_b], size_b) == size)
        fit &= _same(self.a.bytes, ids_a, size_a, raw, fit) & _same(self.b.bytes, ids_b, size_b, raw, fit)
        ids_a, ids_b = ids_a[np.repeat(fit, size_a)], ids_b[np.repeat(fit, size_b)]
        # places where tokens end, over all units in a row
        ends_a, ends_b = np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b])
        common, every = np.intersect1d(ends_a, ends_b, True), np.union1d(ends_a, ends_b)
        unit_ends = np.cumsum(np.where(fit, size, 0))
        # between two neighbouring ends lies the overlap of one token of either side
        links = ids_a[np.searchsorted(ends_a, every)].astype(np.int64) * self.width + ids_b[np.searchsorted(ends_b, every)]

        def per_unit(ends: np.ndarray) -> np.ndarray:
            return np.diff(np.searchsorted(ends, unit_ends, "right"), prepend=0)

        numbers = [fit.astype(np.int64), *(per_unit(ends) for ends in (ends_a, ends_b, common, every))]
        self.counts.extend(np.stack(numbers, 1).ravel(), np.full(len(units), 5))
        self.links.extend(links, numbers[4])
        groups = pc.binary_join_element_wise(
            _joined(ids_a, np.searchsorted(ends_a, common, "right")), _joined(ids_b, np.searchsorted(ends_b, common, "right")), "|")
        bounds = np.searchsorted(common, unit_ends, "right")
        self.groups.append(pc.binary_join(_lists(groups, bounds), ";"))

    def align(self, texts: pa.Array) -> dict[str, np.ndarray | pa.Array]:
        """Numbers of each text, its distinct links with their numbers, and its groups as text."""
        pieces = split_units(texts)
        unit = self.units.numbers(pieces.flatten())
        size = pc.list_value_length(pieces).to_numpy().astype(np.int64)
        counts = self.counts.values[: 5 * self.counts.lists].reshape(-1, 5)
        fit = sums(1 - counts[unit, 0], size) == 0
        fit &= pc.binary_length(texts).to_numpy() > 0
        row = np.repeat(np.arange(len(texts)), size)
        whole = fit[row]
        out = {"fit": fit}
        for i, name in enumerate(("n_a", "n_b", "n_groups", "n_links"), 1):
            out[name] = np.where(fit, sums(counts[unit, i], size), 0)
        several = len(counts)
        pairs, times = np.unique(row[whole] * several + unit[whole], return_counts=True)
        codes, sizes = self.links.take(pairs % several)
        span = len(self.a.bytes) * self.width
        keys, back = np.unique(np.repeat(pairs // several, sizes) * span + codes, return_inverse=True)
        out["row"], out["code"] = keys // span, keys % span
        out["times"] = np.bincount(back, np.repeat(times, sizes), len(keys)).astype(np.int64)
        if len(self.groups) > 1:
            self.groups = [pa.concat_arrays(self.groups)]
        listed = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), self.groups[0].take(pa.array(unit)))
        out["groups"] = pc.binary_join(listed, ";")
        return out


def _same(bytes_of: list[bytes], ids: np.ndarray, size: np.ndarray, raw: list[bytes], fit: np.ndarray) -> np.ndarray:
    """For units whose lengths fit, whether the bytes of their tokens are the unit's."""
    chosen = ids[np.repeat(fit, size)]
    if b"".join(map(bytes_of.__getitem__, chosen.tolist())) == b"".join(u for u, f in zip(raw, fit) if f):
        return np.ones(len(raw), bool)
    ends = np.cumsum(size)
    return np.array([
        bool(f) and b"".join(map(bytes_of.__getitem__, ids[end - n : end].tolist())) == unit
        for f, end, n, unit in zip(fit, ends, size, raw)
    ], bool)


def _lists(values: pa.Array, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), values)


def _joined(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pc.binary_join(_lists(pc.cast(pa.array(ids.astype(np.int64)), pa.string()), ends), ",")


@cache
def _aligner(path_a: str, path_b: str) -> Aligner:
    """One for all tasks of a Python worker."""
    return Aligner(path_a, path_b)


# --- corpus -------------------------------------------------------------------------------

LINKED = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "own array<int>, own_times array<int>, pairs array<long>, pair_times array<int>, "
    "block_pairs array<long>, block_docs array<int>"
)
SUMMED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _rows_to_lists(row: np.ndarray, values: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    return _lists(pa.array(values, kind), np.searchsorted(row, np.arange(n), "right"))


def linked(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Documents with their distinct links, those of ids with the same bytes apart from all others.

    Documents come in blocks; the first of a block also carries the block's distinct other links
    with the number of documents that hold each.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, block = _aligner(path_a, path_b), TaskContext.get().partitionId() << 36
        for batch in batches:
            for start, texts in slices(batch.column("text")):
                n, found = len(texts), aligner.align(texts)
                row, code, times = found["row"], found["code"], found["times"]
                own = aligner.same[code // aligner.width] == code % aligner.width
                pairs, holders = np.unique(code[~own], return_counts=True)
                first = pa.array([0] + [len(pairs)] * n, pa.int32())
                texts_of = zip(found["groups"].to_pylist(), found["fit"])
                digests = [hashlib.sha256(g.encode()).hexdigest() if f else "" for g, f in texts_of]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, block)), batch.column("doc_id").slice(start, n),
                    *(pa.array(found[name]) for name in ("n_a", "n_b", "n_groups", "n_links")), pa.array(digests, pa.string()),
                    _rows_to_lists(row[own], code[own] // aligner.width, n, pa.int32()),
                    _rows_to_lists(row[own], times[own], n, pa.int32()),
                    _rows_to_lists(row[~own], code[~own], n, pa.int64()),
                    _rows_to_lists(row[~own], times[~own], n, pa.int32()),
                    pa.ListArray.from_arrays(first, pa.array(pairs, pa.int64())),
                    pa.ListArray.from_arrays(first, pa.array(holders, pa.int32())),
                ], [part.split()[0] for part in LINKED.split(", ")])
                block += 1

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, LINKED)


def own_counts(rows: DataFrame, size: int) -> DataFrame:
    """``a, n``: documents that hold an id of the first tokenizer linked with its twin.

    Every task counts in one vector as long as the vocabulary.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["a", "n"])

    return rows.select("own").mapInArrow(run, "a int, n long").groupBy("a").agg(F.sum("n").alias("n"))


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Tokens, groups and links of every text under two tokenizers, and how common its links are.

    The first tokenizer sees a space and the text, the second one puts the space itself. Places where
    tokens of both end cut a text into groups; tokens that share bytes are linked. The count of a pair
    of ids is the number of documents that hold it linked. ``n_best`` are the links whose pair has the
    highest count of its first id, ties included; ``count_sum`` adds up the counts of all links.

    Links of ids with the same bytes are counted in vectors as long as the vocabulary; only the
    others are shuffled, distinct within a block of documents. Null and empty texts, and those whose
    bytes either tokenizer changes, have no tokens: zeros and an empty ``groups_sha256``. Every row is
    a document, whatever its id; other columns are not read.
    """
    aligner = _aligner(path_a, path_b)
    size, width = len(aligner.a.bytes), aligner.width
    rows = written(linked(docs, path_a, path_b), "linked")

    zipped = F.explode(F.arrays_zip("block_pairs", "block_docs")).alias("z")
    blocks = rows.where(F.size("block_pairs") > 0).select("block", zipped)
    blocks = blocks.select("block", F.col("z.block_pairs").alias("pair"), F.col("z.block_docs").cast("long").alias("n"))
    counts = written(blocks.groupBy("pair").agg(F.sum("n").alias("n")), "pair_counts")

    own = np.zeros(size, np.int64)
    for a, n in own_counts(rows, size).collect():  # as many rows as the vocabulary has, at most
        own[a] = n
    best = own.copy()
    for a, n in counts.groupBy(F.expr(f"pair div {width}").alias("a")).agg(F.max("n")).collect():
        best[a] = max(best[a], n)

    def summed(key, documents: pa.Table, pairs: pa.Table) -> pa.Table:
        order = np.argsort(pairs["pair"].to_numpy())
        known, n = pairs["pair"].to_numpy()[order], pairs["n"].to_numpy()[order]
        n_best, count_sum = np.zeros(len(documents), np.int64), np.zeros(len(documents), np.int64)

        def add(names: tuple[str, str], look_up) -> None:
            values, times = (documents[name].combine_chunks() for name in names)
            length = pc.list_value_length(values).to_numpy().astype(np.int64)
            a, count = look_up(values.flatten().to_numpy())
            times = times.flatten().to_numpy().astype(np.int64)
            n_best[:] += sums(np.where(count == best[a], times, 0), length)
            count_sum[:] += sums(count * times, length)

        add(("own", "own_times"), lambda a: (a, own[a]))
        if len(known):
            add(("pairs", "pair_times"), lambda code: (code // width, n[np.searchsorted(known, code)]))
        names = [part.split()[0] for part in SUMMED.split(", ")]
        extra = {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}
        return pa.table({name: extra[name] if name in extra else documents[name] for name in names})

    back = blocks.select(F.col("block").alias("of"), "pair").join(counts, "pair").select("of", "pair", "n")
    documents = rows.drop("block_pairs", "block_docs")
    return documents.groupBy("block").cogroup(back.groupBy("of")).applyInArrow(summed, SUMMED)
