"""Best-fit packing of tokenized documents into training sequences by bin completion."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainfold.llm.tokens import slices, unit_ids
from grainfold.llm.words import small_batches
from grainfold.session import written

LIMIT = 2048
GROUP = 20_000
NODES = 4_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, row long"


# --- tokens -------------------------------------------------------------------------------


def cut(total: int, limit: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``total`` tokens: full ones behind a shorter first."""
    if total <= limit:
        return [(0, total)]
    first = total % limit or limit
    return [(0, first), *((s, limit) for s in range(first, total, limit))]


def token_pieces(docs: DataFrame, tokenizer: str, limit: int = LIMIT, keep_ids: bool = False) -> DataFrame:
    """Documents as pieces of at most ``limit`` tokens, each document ended by id 0.

    One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, the ids.
    Null text counts as empty, which is the one id 0. Rows are independent, so repeated rows
    and null or repeated ids give pieces of their own; other columns are not read.
    ``row`` numbers the pieces uniquely.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = unit_ids(tokenizer)
        row = TaskContext.get().partitionId() << 36
        names = [part.split()[0] for part in PIECES.split(", ")] + ["ids"] * keep_ids
        for batch in batches:
            for at, texts in slices(batch.column("text")):
                values, sizes = units.ids(texts)
                doc_ends = np.cumsum(sizes + 1)
                ids = np.zeros(int(doc_ends[-1]), "<u4")  # the last id of each document stays 0
                ids[np.arange(len(values)) + np.repeat(np.arange(len(sizes)), sizes)] = values
                pieces = [cut(n, limit) for n in (sizes + 1).tolist()]
                count = np.fromiter(map(len, pieces), np.int64, len(pieces))
                start, length = np.array([p for own in pieces for p in own], np.int64).T
                ends = np.cumsum(length)
                raw = memoryview(ids).cast("B")
                crc = [zlib.crc32(raw[4 * (end - n) : 4 * end]) for end, n in zip(ends.tolist(), length.tolist())]
                doc = batch.column("doc_id").slice(at, len(texts)).take(pa.array(np.repeat(np.arange(len(texts)), count)))
                place = np.arange(len(length)) - np.repeat(np.cumsum(count) - count, count)
                columns = [doc, pa.array(place, pa.int32()), *map(pa.array, (start, length)), pa.array(crc, pa.int64()),
                           pa.array(np.arange(row, row + len(length)))]
                if keep_ids:
                    offsets = pa.array(np.append(0, ends), pa.int32())
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.view(np.int32))))
                row += len(length)
                yield pa.RecordBatch.from_arrays(columns, names)

    small_batches(docs.sparkSession)
    schema = PIECES + (", ids array<int>" if keep_ids else "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, schema)


# --- packing ------------------------------------------------------------------------------


class Sizes:
    """How many items of each size are left, and the largest size that fits a gap."""

    def __init__(self, sizes: np.ndarray, limit: int):
        self.left = np.bincount(sizes, minlength=limit + 1)
        self.below = np.maximum.accumulate(np.where(self.left > 0, np.arange(limit + 1), 0))

    def take(self, size: int) -> None:
        self.left[size] -= 1
        if not self.left[size]:
            # ``below`` never falls, so that runs of it end where a search says
            self.below[size : np.searchsorted(self.below, size, "right")] = self.below[size - 1]

    def give(self, size: int) -> None:
        self.left[size] += 1
        if self.left[size] == 1:
            self.below[size : np.searchsorted(self.below, size)] = size

    def largest(self) -> int:
        return int(self.below[-1])


def _best_pair(sizes: Sizes, gap: int) -> tuple[int, int]:
    """Two sizes that fill the gap best, the larger one as large as can be; (0, 0) if none."""
    a = np.flatnonzero(sizes.left[: gap + 1])
    b = np.minimum(sizes.below[gap - a], a)
    b = np.where((b == a) & (sizes.left[a] < 2), sizes.below[np.maximum(a - 1, 0)], b)
    b = np.where(a + b > gap, 0, b)
    fill = np.where(b > 0, a + b, 0)
    if not len(a) or not fill.max():
        return 0, 0
    k = len(a) - 1 - int(np.argmax(fill[::-1]))
    return int(a[k]), int(b[k])


def _full(sizes: Sizes, gap: int) -> tuple[int, ...] | None:
    """A quick way to fill the gap without waste, if there is one: one item, a pair, or the largest
    sizes that fit with the best pair behind them."""
    taken: list[int] = []
    rest = gap
    found = None
    while found is None and (size := int(sizes.below[rest])):
        pair = (size,) if size == rest else _best_pair(sizes, rest)
        if sum(pair) == rest:
            found = (*taken, *pair)
        else:
            sizes.take(size)
            taken.append(size)
            rest -= size
    for size in taken:
        sizes.give(size)
    return found


def _dominated(own: tuple[int, ...], slack: int, others: int) -> bool:
    """Whether one of the ``others`` (bits by size) could take the place of items of ``own`` and leave less waste,
    or of several with the same sum: the items it replaces then fit wherever it would have gone."""
    sums, several = 1, 0
    for size in own:
        several |= (sums & ~1) << size
        sums |= sums << size
    # sums raised by 0 to slack - 1, and then by one more
    reach, width = sums, 1
    while width < slack:
        step = min(width, slack - width)
        reach |= reach << step
        width += step
    return bool(others & (several | (reach << 1 if slack else 0)))


def fillings(values: list[int], counts: list[int], gap: int) -> Iterator[tuple[int, ...] | None]:
    """All undominated ways to fill the gap, least waste first; None in place of each dominated one.

    ``values`` are the sizes left, in rising order, and ``counts`` how many items there are of each. Sums that
    can be reached are kept as bits, so only ways that end are followed.
    """
    reach = [1]
    for value, count in zip(values, counts):
        sums, left, step = reach[-1], min(count, gap // value), 1
        while left:
            step = min(step, left)
            sums |= sums << step * value
            left -= step
            step *= 2
        reach.append(sums & ((2 << gap) - 1))

    def ways(k: int, rest: int) -> Iterator[tuple[int, ...]]:
        """The ways to make ``rest`` of the first ``k`` sizes, the largest first."""
        if not rest:
            yield ()
        while rest and reach[k] >> rest & 1:
            k -= 1
            for n in range(min(counts[k], rest // values[k]), 0, -1):
                if reach[k] >> (rest - n * values[k]) & 1:
                    for way in ways(k, rest - n * values[k]):
                        yield (values[k],) * n + way

    present = sum(1 << v for v in values)
    many = dict(zip(values, counts))
    for total in range(gap, -1, -1):
        if reach[-1] >> total & 1:
            for own in ways(len(values), total):
                used = sum(1 << v for v in set(own) if own.count(v) == many[v])
                yield None if _dominated(own, gap - total, present & ~used) else own


def best_fit(sizes: np.ndarray, limit: int) -> list[list[int]]:
    """Best-fit decreasing: the incumbent."""
    open_bins: list[list[list[int]]] = [[] for _ in range(limit + 1)]
    room = Sizes(np.zeros(0, np.int64), limit)
    bins = []
    smallest = np.arange(limit, -1, -1)
    for size in np.sort(sizes)[::-1].tolist():
        # mirrored: the largest limit - gap that is at most limit - size is the tightest gap
        gap = int(smallest[room.below[limit - size]])
        if room.left[limit - gap] and gap >= size:
            own = open_bins[gap].pop()
            room.take(limit - gap)
        else:
            gap, own = limit, []
            bins.append(own)
        own.append(size)
        if gap > size:
            open_bins[gap - size].append(own)
            room.give(limit - gap + size)
    return bins


def bin_completion(sizes: np.ndarray, limit: int = LIMIT, nodes: int = NODES) -> list[list[int]]:
    """Items as bins of at most ``limit``, as few as found.

    Depth-first branch and bound: the largest item left gets each of the undominated
    fillings in turn, least waste first, and a branch ends when its waste makes a better count than the
    incumbent's impossible. It ends at the lower bound, or after ``nodes`` steps beyond one
    full descent, with the best solution so far; else that is a least one. Dominated fillings count as steps.
    """
    best = best_fit(sizes, limit)
    total = int(sizes.sum())
    bound = -(-total // limit)
    if len(best) <= bound:
        return best
    left = Sizes(sizes, limit)
    steps = nodes + len(best)
    bins: list[tuple[int, ...]] = []
    stack = [_branches(left, limit)]
    waste = 0
    while stack and steps:
        steps -= 1
        own = next(stack[-1], ())
        if own is None:
            continue
        # the next ones waste as much or more
        if not own or waste + limit - sum(own) > (len(best) - 1) * limit - total:
            stack.pop()
            if bins:
                last = bins.pop()
                waste -= limit - sum(last)
                for size in last:
                    left.give(size)
            continue
        for size in own:
            left.take(size)
        bins.append(own)
        waste += limit - sum(own)
        if not left.largest():
            best = [list(b) for b in bins]
            if len(best) <= bound:
                break
            last = bins.pop()
            waste -= limit - sum(last)
            for size in last:
                left.give(size)
        else:
            stack.append(_branches(left, limit))
    return best


def _branches(left: Sizes, limit: int) -> Iterator[tuple[int, ...] | None]:
    """The largest item with each filling of its bin; None for a dominated one. ``left`` is as it was at each step."""
    size = left.largest()

    def every() -> Iterator[tuple[int, ...] | None]:
        values = np.flatnonzero(left.left[: limit - size + 1])
        counts = left.left[values] - (values == size)
        kept = counts > 0
        return fillings(values[kept].tolist(), counts[kept].tolist(), limit - size)

    left.take(size)
    first = _full(left, limit - size) if size < limit else ()
    left.give(size)
    if first is None:
        # made anew when it is needed again, so that a deep stack holds little
        first = next((w for w in every() if w is not None))
    yield (size, *first)
    seen = sorted(first)
    for way in every():
        if way is None or sorted(way) != seen:
            yield None if way is None else (size, *way)


def pack(pieces: DataFrame, limit: int = LIMIT, group: int = GROUP) -> DataFrame:
    """Add sequence_id and offset to a written table of pieces.

    The pieces are dealt by their unique ``row`` into groups of about ``group``, however many
    documents or lengths are equal, and each group is packed in a task of its own; a group
    loses less than one sequence against a packing of all. Only lengths go there; ids, if there
    are any, meet their places in a join.
    """
    groups = max(1, -(-pieces.count() // group))

    def run(table: pa.Table) -> pa.Table:
        lengths = table["length"].to_numpy()
        by_size: dict[int, list[int]] = {}
        for i in np.argsort(-lengths, kind="stable")[::-1].tolist():
            by_size.setdefault(int(lengths[i]), []).append(i)
        sequence = np.zeros(len(lengths), np.int64)
        offset = np.zeros(len(lengths), np.int64)
        base = table["part"][0].as_py() << 32
        for number, own in enumerate(bin_completion(lengths, limit)):
            at = 0
            for size in own:
                i = by_size[size].pop()
                sequence[i], offset[i] = base + number, at
                at += size
        return pa.table({"row": table["row"], "sequence_id": sequence, "offset": offset})

    part = F.pmod(F.xxhash64("row"), F.lit(groups)).alias("part")
    dealt = pieces.select(part, "row", "length").groupBy("part")
    places = dealt.applyInArrow(run, "row long, sequence_id long, offset long")
    return pieces.join(places, "row").drop("row")


def pack_documents(docs: DataFrame, tokenizer: str, limit: int = LIMIT, keep_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack documents: one row per piece with its place in a sequence.

    Runs jobs when called: the pieces are written before they are packed. An empty table
    gives an empty result.
    """
    return pack(written(token_pieces(docs, tokenizer, limit, keep_ids), "pieces"), limit)
