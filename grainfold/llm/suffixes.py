"""Removal of byte strings that occur more than once, from samples of suffixes.

The difference-cover scheme sorts a sample of positions, names them, and derives the rest from the
names. Residues modulo 3 would make a row of two thirds of all bytes, several times over, so the
sample here is a cover chosen by content: of every string of ``LENGTH`` bytes the start of
its least ``GRAM``-byte run. Equal strings have equal samples, and about one in seventy positions is one.

1. Neighbouring strings with the same sample form a unit. Units are named by the hash of all their bytes,
   and equal names mean that all strings of the units are equal, pair by pair.
2. Samples of one unit name need nothing more. Where a sample meets several names, one unit of each name is
   cut into pieces of eight strings, which are named in the same way by the bytes that all eight cover.
3. Only where such a core meets several pieces the strings are compared one by one: these remaining suffixes become rows.
4. Strings with an equal elsewhere are merged to spans, and what they cover is removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grainfold.llm.minhash import ODD, mix64
from grainfold.llm.words import small_batches
from grainfold.session import written

LENGTH = 200
GRAM = 64
#: Strings of a text handled at a time; a text of more is handled in blocks.
BLOCK = (1 << 23) - 1024
#: Strings of a unit compared as one, as long as their cores are unlike.
PIECE = 8
#: Bits, at most, of a map of the rows whose texts are looked at again.
ROW_BITS = 1 << 27


def _run_hashes(raw: np.ndarray, sizes: list[int]) -> dict[int, np.ndarray]:
    """Hashes of the runs of each size from every position, by doubling."""
    powers = {1: mix64(raw.astype(np.uint64) + np.uint64(0x51ED2701))}
    size = 1
    while size * 2 <= max(sizes):
        low = powers[size]
        powers[size * 2] = mix64(low[:-size] * ODD + low[size:]) if len(low) > size else low[:0]
        size *= 2
    out = {}
    for wanted in sizes:
        size = 1 << (wanted.bit_length() - 1)
        n = max(0, len(raw) - wanted + 1)
        own = powers[size][:n]
        if size < wanted:
            # a run is known by its first and its last ``size`` bytes, which overlap
            own = mix64(own * ODD + powers[size][wanted - size : wanted - size + n])
        out[wanted] = own
    return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    size, low = 1, values
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    return np.minimum(low[: len(low) - (width - size)], low[width - size :]) if size < width else low


def blocks(raw: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    for at in range(0, max(0, len(raw) - length + 1), BLOCK):
        yield at, raw[at : at + BLOCK + length - 1]


def text_units(raw: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> list[np.ndarray]:
    """Units of a text: first and last start, place of the sample, its hash, and the name."""
    parts = []
    for at, block in blocks(raw, length):
        runs = _run_hashes(block, [gram, length])
        grams, whole = runs[gram], runs[length]
        place = np.arange(len(grams), dtype=np.uint64)
        bits = np.uint64(23)
        order = _least((grams >> bits << bits) | place, length - gram + 1)
        sample = (order & np.uint64((1 << 23) - 1)).astype(np.int64)
        first = np.flatnonzero(np.append(True, sample[1:] != sample[:-1]))
        last = np.append(first[1:], len(sample)) - 1
        own = sample[first]
        # a unit spans fewer than ``length`` strings: the first and the last cover all its bytes
        name = mix64(whole[first] * ODD + mix64(whole[last] + (last - first).astype(np.uint64)))
        parts.append([first + at, last + at, own + at, grams[own].view(np.int64), name.view(np.int64)])
    return [np.concatenate(p) for p in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 5


def _raw(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8"), np.uint8)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), text.alias("text"), F.xxhash64(doc_id, text).alias("row"))


def units(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(row, place, gram, name): the units of every text; ``_placed`` takes their places apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                found = [text_units(_raw(t), length, gram) for t in batch.column(1).to_pylist()]
                owner = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
                first, last, sample, grams, names = (np.concatenate(c) for c in zip(*found))
                place = (first << 32) | ((last - first) << 16) | (sample - first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(owner), *map(pa.array, (place, grams, names))], ["row", "place", "gram", "name"]
                )

    return docs.select("row", "text").mapInArrow(run, "row long, place long, gram long, name long")


def _placed(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last start of units, and the place of their samples."""
    first = place >> 32
    return first, first + ((place >> 16) & 0xFFFF), first + (place & 0xFFFF)


def text_pieces(raw: np.ndarray, place: np.ndarray, gram: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """Units cut into pieces of up to ``PIECE`` strings, at fixed distances from the sample.

    All strings of a piece cover its core. ``at`` is where that starts; string ``j`` of a piece, ``low`` to ``high``, starts
    ``j`` bytes before, and is known by the core, ``j`` bytes before it and ``PIECE - 1 - j`` after it. Returns unit,
    at, low, high, the core's hash, and the bytes before and after as integers, the nearest byte the lowest.
    """
    size = length - PIECE + 1
    cores = [_run_hashes(block, [size])[size] for _, block in blocks(raw, size)]
    cores = np.concatenate(cores) if cores else np.zeros(0, np.uint64)
    first, last, sample = _placed(place)
    least, most = (sample - last) // PIECE, (sample - first) // PIECE
    number = most - least + 1
    unit = np.repeat(np.arange(len(place)), number)
    k = least[unit] + np.arange(len(unit)) - np.repeat(np.cumsum(number) - number, number)
    at = sample[unit] - PIECE * k
    low = np.maximum((sample - last)[unit] - PIECE * k, 0)
    high = np.minimum((sample - first)[unit] - PIECE * k, PIECE - 1)
    core = mix64(mix64(gram.view(np.uint64)[unit] + k.astype(np.uint64)) * ODD + cores[at])
    before, after = np.zeros(len(unit), np.int64), np.zeros(len(unit), np.int64)
    for i in range(PIECE - 1):
        before |= np.where(i < high, raw[np.maximum(at - 1 - i, 0)], 0).astype(np.int64) << (8 * i)
        after |= np.where(i < PIECE - 1 - low, raw[np.minimum(at + size + i, len(raw) - 1)], 0).astype(np.int64) << (8 * i)
    return [unit, at, low, high, core.view(np.int64), before, after]


def _pieces(texts: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(whole.num_rows):
                row = whole.slice(k, 1)
                own = row.column(2).flatten()
                place, gram, single = (own.field(i) for i in range(3))
                unit, at, low, high, *rest = text_pieces(
                    _raw(row.column(1)[0].as_py()), place.to_numpy(), gram.to_numpy(), length)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(row.column(0)[0], len(unit)), *(pa.array(x.astype(np.int32)) for x in (at, low, high)),
                     *map(pa.array, rest), single.take(pa.array(unit))],
                    ["row", "at", "low", "high", "core", "before", "after", "single"],
                )

    kinds = "row long, at int, low int, high int, core long, before long, after long, single boolean"
    return texts.mapInArrow(run, kinds)


def _only(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """``texts`` without most of those whose ``row`` is not in ``rows``, so that few texts are shuffled for a join.

    A bit map of the rows, of ``ROW_BITS`` bits at most, visits the driver; with more rows all texts stay.
    """
    n = rows.count()
    if 4 * n > ROW_BITS:
        return texts
    bits = 1 << max(10, min((32 * n).bit_length(), ROW_BITS.bit_length() - 1))
    found = rows.select(F.pmod("row", F.lit(bits)).alias("bit")).distinct().toArrow().column(0).to_numpy()
    there = np.zeros(bits // 8, np.uint8)
    np.bitwise_or.at(there, found >> 3, (1 << (found & 7)).astype(np.uint8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = batch.column("row").to_numpy() & (bits - 1)
            yield batch.filter(pa.array((there[bit >> 3] >> (bit & 7) & 1).astype(bool)))

    return texts.mapInArrow(run, texts.schema)


def repeated_starts(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(row, first, last): runs of starts whose ``length`` bytes also start elsewhere."""
    small_batches(docs.sparkSession)
    keyed = _keyed(docs)
    named, sampled = Window.partitionBy("gram", "name"), Window.partitionBy("gram")
    one = F.struct("row", "place")
    # dealt by the sample once, which serves both windows
    table = units(keyed, length, gram).repartition("gram")
    table = table.withColumns({"n": F.count("*").over(named), "stands": F.min(one).over(named) == one})
    # one unit of each name stands for all of them where a sample meets several names
    table = table.withColumn("unclear", F.col("stands") & (F.count("*").over(sampled) > F.col("n")))
    live = table.where("n > 1 or unclear").select(
        "row", "place", F.when(F.col("unclear"), F.col("gram")).alias("gram"), (F.col("n") == 1).alias("single"))
    live = written(live, "units")
    first = F.shiftright("place", 32)
    shared = live.where("not single").select(
        "row", first.alias("first"), (first + F.shiftright("place", 16).bitwiseAND(0xFFFF)).alias("last"))

    unclear = live.where("gram is not null").groupBy("row").agg(
        F.collect_list(F.struct("place", "gram", "single")).alias("units"))
    unclear = written(unclear, "unclear")
    # rows equal in id and text give the same units: one of them is enough
    texts = _only(keyed.select("row", "text"), unclear).join(unclear, "row").dropDuplicates(["row"])
    alike = Window.partitionBy("core", "low", "high", "before", "after")
    one = F.struct("row", "at")
    pieces = _pieces(texts.select("row", "text", "units"), length).repartition("core")
    pieces = pieces.withColumns({"n": F.count("*").over(alike), "stands": F.min(one).over(alike) == one})
    pieces = pieces.withColumn("unclear", F.col("stands") & (F.count("*").over(Window.partitionBy("core")) > F.col("n")))
    # a piece met twice is repeated as a whole; of cores that meet several pieces the strings are compared
    none, whole = F.array().cast("array<int>"), F.lit(-1)
    strings = pieces.withColumn("j", F.explode(F.concat(
        F.when(F.col("single") & (F.col("n") > 1), F.array(whole)).otherwise(none),
        F.when(F.col("unclear"), F.sequence("low", "high")).otherwise(none))))
    strings = strings.withColumns({
        "before": F.expr("before & (shiftleft(1L, 8 * greatest(j, 0)) - 1)"),
        "after": F.expr(f"after & (shiftleft(1L, 8 * ({PIECE - 1} - greatest(j, 0))) - 1)")})
    again = F.count("*").over(Window.partitionBy("core", "j", "before", "after"))
    strings = strings.withColumn("again", again).where("j = -1 or (single and n = 1 and again > 1)")
    strings = strings.select(
        "row", F.expr("cast(at - if(j = -1, high, j) as long)").alias("first"),
        F.expr("cast(at - if(j = -1, low, j) as long)").alias("last"))
    return shared.unionByName(strings)


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes) and kept_sha256.

    A byte of the UTF-8 text goes if a string of ``length`` bytes that covers it also starts anywhere
    else, in the same document too; what counts is the input, and matches never cross documents.
    Null text is empty; shorter texts lose nothing. Repeated rows are documents of their own, so that they lose all they share;
    rows without an id are treated like others, and other columns are not read. Runs jobs when called.
    """
    spans = repeated_starts(docs, length, gram).groupBy("row").agg(
        F.collect_set(F.shiftleft("first", 16).bitwiseOR(F.col("last") - F.col("first"))).alias("starts")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                batch = whole.slice(at, 128)
                starts = batch.column(2)
                out = [remove(_raw(t), starts[k].values.to_numpy() if starts[k].is_valid else np.zeros(0, np.int64), length)
                       for k, t in enumerate(batch.column(1).to_pylist())]
                n_bytes, n_removed, n_spans, kept = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                     pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary()),
                     pa.array([hashlib.sha256(k).hexdigest() for k in kept])],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
                )

    rows = _keyed(docs).join(spans, "row", "left").select("doc_id", "text", "starts")
    return rows.mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    )


def remove(raw: np.ndarray, starts: np.ndarray, length: int) -> tuple[int, int, int, bytes]:
    """Bytes, removed bytes, maximal removed runs, and what is left; ``starts``: 65,536 times the first of a run, plus its others."""
    edge = np.zeros(len(raw) + 1, np.int64)
    np.add.at(edge, starts >> 16, 1)
    np.add.at(edge, (starts >> 16) + (starts & 0xFFFF) + length, -1)
    gone = np.cumsum(edge[:-1]) > 0
    n_spans = int((gone & ~np.append(False, gone[:-1])[: len(gone)]).sum())
    return len(raw), int(gone.sum()), n_spans, raw[~gone].tobytes()
