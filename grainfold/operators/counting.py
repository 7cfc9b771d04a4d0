"""Counting of pairs and of given sets over baskets, task by task, in numpy.

Baskets are kept as blocks: rows of ``sizes`` and ``held``, the numbers of their items one
basket after the other, ascending within a basket. Sets are kept as Parquet files in the shared
folder, where every task reads them file by file; neither passes the driver.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainfold.session import new_path, written_at

# Tasks get the functions of this module by value, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Entries of a block of baskets; one longer basket is a block of its own.
BLOCK = 1_000_000
#: Entries that a task counts at a time.
CHUNK = 2_000_000
#: Words of 64 rows in the bitmaps of a chunk.
WORDS = 2_000_000
#: Pairs of a chunk that are listed at a time.
PAIRS = 4_000_000
#: A chunk with no more pairs reports all of them, whatever their share.
REPORTED = 100_000
#: Given sets per file.
SETS = 250_000


# --- blocks of baskets --------------------------------------------------------------------


def basket_blocks(held: DataFrame, least_items: int) -> DataFrame:
    """Blocks of baskets from rows ``basket, at``; baskets of fewer items are left out.

    Rows are sorted by basket within partitions and packed as they stream by, so no basket is
    ever one value of a row before it is packed.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, items, entries = [], [], 0
        for own_sizes, own_items in _whole_baskets(batches, least_items):
            sizes.append(own_sizes)
            items.append(own_items)
            entries += len(own_items)
            if entries >= BLOCK:
                yield _block(sizes, items)
                sizes, items, entries = [], [], 0
        if entries:
            yield _block(sizes, items)

    rows = held.select("basket", "at").repartition("basket").sortWithinPartitions("basket", "at")
    # one number per basket is all that Python needs
    rows = rows.select(F.xxhash64("basket").alias("basket"), "at")
    return rows.mapInArrow(pack, "sizes array<int>, held array<long>")


def _block(sizes: list[np.ndarray], items: list[np.ndarray]) -> pa.RecordBatch:
    lists = []
    for parts, kind in ((sizes, pa.int32()), (items, pa.int64())):
        values = np.concatenate(parts)
        lists.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind)))
    return pa.RecordBatch.from_arrays(lists, ["sizes", "held"])


def _whole_baskets(batches: Iterator[pa.RecordBatch], least_items: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sizes and items of the baskets that end in each batch.

    Baskets are told apart by their hash, and where that is equal by items that start anew, as they
    ascend within a basket. Rows are sorted by the basket itself, so only neighbours would have to agree.
    """
    open_basket, open_items = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def cut(basket: np.ndarray, items: np.ndarray, whole: bool):
        starts = np.flatnonzero((np.diff(basket, prepend=~basket[:1]) != 0) | (np.diff(items, prepend=items[:1]) < 0))
        sizes = np.diff(starts, append=len(basket))
        last = len(basket) if whole else int(starts[-1])
        sizes = sizes if whole else sizes[:-1]
        kept = sizes >= least_items
        return (sizes[kept], items[:last][np.repeat(kept, sizes)]), (basket[last:], items[last:])

    for batch in batches:
        if batch.num_rows:
            basket = np.concatenate([open_basket, batch.column(0).to_numpy()])
            items = np.concatenate([open_items, batch.column(1).to_numpy()])
            done, (open_basket, open_items) = cut(basket, items, False)
            yield done
    if len(open_basket):
        yield cut(open_basket, open_items, True)[0]


class Chunk:
    """Baskets in memory, their items numbered from 0 in ascending order."""

    def __init__(self, sizes: np.ndarray, items: np.ndarray):
        self.sizes = sizes
        self.items, self.local = np.unique(items, return_inverse=True)
        self.row = np.repeat(np.arange(len(sizes)), sizes)

    def bitmaps(self) -> Iterator[np.ndarray]:
        """Per item a bitmap of the baskets that hold it, for some baskets at a time."""
        step = 64 * max(1, WORDS // max(1, len(self.items)))
        ends = np.cumsum(self.sizes)
        for start in range(0, len(self.sizes), step):
            stop = min(start + step, len(self.sizes))
            own = slice(ends[start - 1] if start else 0, ends[stop - 1])
            words = (stop - start + 63) // 64
            bits = np.zeros(len(self.items) * words, np.uint64)
            row = (self.row[own] - start).astype(np.uint64)
            np.bitwise_or.at(bits, self.local[own] * words + (row >> np.uint64(6)).astype(np.int64), np.uint64(1) << (row & np.uint64(63)))
            yield bits.reshape(-1, words)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    sizes, items, entries = [], [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            one = batch.slice(i, 1)
            sizes.append(one.column("sizes").flatten().to_numpy().astype(np.int64))
            items.append(one.column("held").flatten().to_numpy())
            entries += len(items[-1])
            if entries >= CHUNK:
                chunk = Chunk(np.concatenate(sizes), np.concatenate(items))
                sizes, items, entries = [], [], 0
                yield chunk
                del chunk  # not kept while the next one is made
    if entries:
        yield Chunk(np.concatenate(sizes), np.concatenate(items))


# --- pairs --------------------------------------------------------------------------------


def pairs_by_bitmaps(chunk: Chunk) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """First items, second items and counts of all pairs of a chunk, some first items at a time."""
    width = len(chunk.items)
    step = max(1, PAIRS // (8 * max(1, width)))
    for start in range(0, width, step):
        total = np.zeros((min(step, width - start), width), np.int64)
        for bits in chunk.bitmaps():
            for i in range(len(total)):
                total[i, start + i + 1 :] += np.bitwise_count(bits[start + i] & bits[start + i + 1 :]).sum(axis=1, dtype=np.int64)
        x, y = np.nonzero(total)
        yield x + start, y, total[x, y]


def pairs_by_lists(chunk: Chunk) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The same from the pairs of every basket, for chunks of many items and short baskets."""
    ends = np.repeat(np.cumsum(chunk.sizes), chunk.sizes)
    later = ends - 1 - np.arange(len(chunk.local))
    width = len(chunk.items)
    total = np.cumsum(np.bincount(chunk.local, later, width))
    start = 0
    while start < width:
        base = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, base + PAIRS, "right")))
        left = np.flatnonzero((chunk.local >= start) & (chunk.local < stop) & (later > 0))
        times = later[left]
        before = np.cumsum(times) - times
        right = np.repeat(left + 1 - before, times) + np.arange(int(times.sum()))
        codes, counts = np.unique(np.repeat(chunk.local[left], times) * width + chunk.local[right], return_counts=True)
        yield codes // width, codes % width, counts
        start = stop


def pairs_in(chunk: Chunk) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    listed = float((chunk.sizes * (chunk.sizes - 1.0)).sum()) / 2
    anded = len(chunk.items) ** 2 / 2 * (len(chunk.sizes) / 64 + 1)
    return pairs_by_lists(chunk) if 40 * listed < anded else pairs_by_bitmaps(chunk)


def share(least: int, rows: int, baskets: int) -> int:
    """What a set of ``least`` of all baskets reaches in one chunk of ``rows`` at least."""
    return max(1, -(-least * rows // baskets))


def promising_pairs(blocks: DataFrame, least: int, baskets: int) -> DataFrame:
    """``x, y, n, missed``: counts of pairs by chunk where they reach their share of ``least``.

    A pair in enough baskets reaches its share in one chunk or more. Where it does not, up to
    ``missed`` of its baskets stay uncounted; that is none in chunks of few items, which report
    every pair. Every chunk also gives one row without a pair.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            few = len(chunk.items) ** 2 <= 2 * REPORTED
            bound = 1 if few else share(least, len(chunk.sizes), baskets)
            yield _pair_rows(None, None, np.zeros(1, np.int64), bound)
            for x, y, n in pairs_in(chunk):
                kept = n >= bound
                for at in range(0, int(kept.sum()), 1_000_000):
                    some = np.flatnonzero(kept)[at : at + 1_000_000]
                    yield _pair_rows(chunk.items[x[some]], chunk.items[y[some]], n[some], bound)

    return blocks.mapInArrow(run, "x long, y long, n long, missed long")


def _pair_rows(x: np.ndarray | None, y: np.ndarray | None, n: np.ndarray, bound: int) -> pa.RecordBatch:
    nothing = pa.nulls(len(n), pa.int64())
    columns = [nothing if c is None else pa.array(c, pa.int64()) for c in (x, y)]
    columns += [pa.array(n, pa.int64()), pa.array(np.full(len(n), bound - 1), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["x", "y", "n", "missed"])


# --- given sets ---------------------------------------------------------------------------


def counted(blocks: DataFrame, sets: DataFrame) -> DataFrame:
    """``positions, n`` and the other columns of ``sets``: in how many baskets each occurs, if in any.

    ``positions`` are distinct. The sets are written once, many to a file, neighbours together if
    there are several files. One scan of the blocks counts them; every task reads the files itself.
    """
    path = new_path(sets.sparkSession, "sets")
    sets = written_at(sets, path)
    if (files := 1 + sets.count() // SETS) > 1:
        path = new_path(sets.sparkSession, "sets")
        sets = written_at(sets.repartitionByRange(files, "positions"), path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            for own in set_files(path):
                yield from _count_rows(own, count_chunk(chunk, own))

    found = blocks.mapInArrow(run, "positions array<long>, n long")
    return found.groupBy("positions").agg(F.sum("n").alias("n")).join(sets, "positions")


def _count_rows(sets: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    seen = np.flatnonzero(n)
    for at in range(0, len(seen), 100_000):
        some = seen[at : at + 100_000]
        own = sets[some]
        offsets = pa.array(np.append(0, np.cumsum((own >= 0).sum(axis=1))), pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array(own[own >= 0]))
        yield pa.RecordBatch.from_arrays([lists, pa.array(n[some])], ["positions", "n"])


def set_files(path: str) -> Iterator[np.ndarray]:
    """Sets as sorted rows of a matrix, shorter ones filled up with -1; some of one file at a time."""
    path = path.replace("s3a://", "s3://", 1)
    store, folder = fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)
    names = [info.path for info in store.get_file_info(fs.FileSelector(folder)) if info.path.endswith(".parquet")]
    held, rows = [], 0
    for name in sorted(names):
        with store.open_input_file(name) as file:
            for batch in pq.ParquetFile(file).iter_batches(SETS, columns=["positions"]):
                held.append(batch.column(0))
                rows += len(batch)
                if rows >= SETS:
                    yield _matrix(held)
                    held, rows = [], 0
    if rows:
        yield _matrix(held)


def _matrix(lists: list[pa.ListArray]) -> np.ndarray:
    lists = pa.concat_arrays(lists)
    sizes = np.diff(lists.offsets.to_numpy())
    matrix = np.full((len(lists), max(1, sizes.max())), -1, np.int64)
    matrix[np.arange(matrix.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy()
    return matrix[np.lexsort(matrix.T[::-1])]


def walk(bits: np.ndarray, sets: np.ndarray, counts: np.ndarray) -> int:
    """Add to ``counts`` how many rows hold each of ``sets``; the number of prefixes looked at.

    ``sets`` are sorted rows of item numbers, so those with a common prefix are neighbours and
    make a tree. The bitmap of a prefix is taken once for all of them, and nothing below a prefix
    that no row holds is looked at.
    """
    depth_of, nodes = sets.shape[1], 0
    stack = [(0, len(sets), 0, None)]
    while stack:
        start, stop, depth, mask = stack.pop()
        nodes += 1
        if sets[start, depth] < 0:  # a set that ends here sorts first
            ended = int(np.searchsorted(sets[start:stop, depth], 0)) + start
            counts[start:ended] += 0 if mask is None else int(np.bitwise_count(mask).sum())
            start = ended
            if start == stop:
                continue
        if depth == depth_of - 1:
            step = max(1, 4_000_000 // bits.shape[1])
            for at in range(start, stop, step):
                to = min(at + step, stop)
                own = bits[sets[at:to, depth]]
                own = own if mask is None else own & mask
                counts[at:to] += np.bitwise_count(own).sum(axis=1, dtype=np.int64)
            continue
        column = sets[start:stop, depth]
        cuts = np.flatnonzero(np.diff(column, prepend=-2))
        for at, to in zip(cuts, np.append(cuts[1:], len(column))):
            own = bits[column[at]] if mask is None else mask & bits[column[at]]
            if own.any():
                stack.append((start + at, start + to, depth + 1, own))
            else:
                nodes += 1
    return nodes


def count_chunk(chunk: Chunk, sets: np.ndarray) -> np.ndarray:
    """In how many baskets of a chunk each set occurs."""
    at = np.searchsorted(chunk.items, sets)
    known = (sets < 0) | (chunk.items[np.minimum(at, len(chunk.items) - 1)] == sets)
    here = np.flatnonzero(known.all(axis=1))
    out = np.zeros(len(sets), np.int64)
    if len(here):
        local, counts = np.where(sets[here] < 0, -1, at[here]), np.zeros(len(here), np.int64)
        for bits in chunk.bitmaps():
            walk(bits, local, counts)
        out[here] = counts
    return out
