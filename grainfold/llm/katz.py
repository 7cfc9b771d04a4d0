"""Katz backoff: Good-Turing discounted bigram and word counts, exactly normalised.

P(w | h) = d(c) * c(h w) / c'(h) where h w was seen, else a(h) * P(w); the words' own
distribution is discounted in the same way and leaves the rest to one unknown word. a(h) is what is left of h, divided
by what the unseen words have in P. The order is 2: nearly every longer run of a corpus like this occurs
once, which Good-Turing discounts to nothing, and its table would be as large as the corpus.

Texts are kept in blocks of about two million words, as numbers of the block's own list of words. Words are counted and numbered
by joins of these lists. A block's distinct bigrams then go to their parts once, as two numbers and counts;
a part counts its bigrams and sends the counts back in the order in which they came. A part has all
bigrams of a word that comes first, or, if that word is frequent, an even share of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainfold.llm.words import small_batches, words
from grainfold.session import drop_path, new_path, written, written_at

#: Counts above this are not discounted.
TRUSTED = 5
START, END = -1, -2
#: Words of a block, and of the texts whose bigrams one part counts, about.
BLOCK, PART = 1 << 21, 1 << 21


def discounts(counted: dict[int, int]) -> dict[int, float]:
    """Katz' discount ratio of each count up to ``TRUSTED``, from the counts of counts.

    Where these are too few or uneven for Good-Turing to give a ratio within (0, 1), the ratio of absolute
    discounting takes its place.
    """
    n = {r: counted.get(r, 0) for r in range(1, TRUSTED + 2)}
    ratios = {}
    tail = (TRUSTED + 1) * n[TRUSTED + 1] / n[1] if n[1] else 1.0
    absolute = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    for r in range(1, TRUSTED + 1):
        good = ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail) if n[r] and tail < 1 else 0.0
        ratios[r] = good if 0 < good < 1 else 1 - absolute / r
    return ratios


def _discounted(count: np.ndarray, ratios: dict[int, float]) -> np.ndarray:
    return count * np.array([1.0, *(ratios[r] for r in range(1, TRUSTED + 1)), 1.0])[np.minimum(count, TRUSTED + 1)]


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers, compressed byte by byte of their places: first all lowest bytes, then all second ones."""
    planes = np.ascontiguousarray(values, "<i8").view(np.uint8).reshape(-1, 8).T
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:8], "little")
    planes = np.frombuffer(pa.decompress(packed[8:], 8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view("<i8").reshape(n).astype(np.int64, copy=False)


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the tables written meanwhile are complete, not when the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


BLOCKS = (
    "doc_ids array<long>, learn array<boolean>, sizes array<int>, words array<long>, times array<long>, ids binary"
)


def _block(docs: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One row: documents, distinct words (START last), how often they are learned from, and every word's place among them.

    Frequent words come first. A text ends with END; START counts the texts learned from.
    """
    doc_ids, learn, texts = (pa.concat_arrays([d.column(i) for d in docs]) for i in range(3))
    sizes = np.diff(texts.offsets.to_numpy()) + 1
    word = np.full(sizes.sum(), END, np.int64)
    inner = np.ones(len(word), bool)
    inner[np.cumsum(sizes) - 1] = False
    word[inner] = texts.flatten().to_numpy()
    distinct, place, counts = np.unique(word, return_inverse=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    place = rank[place]
    learned = learn.to_numpy(zero_copy_only=False).astype(bool)
    times = np.bincount(place[np.repeat(learned, sizes)], minlength=len(order))
    columns = [doc_ids, pa.array(learned), pa.array(sizes, pa.int32()),
               pa.array(np.append(distinct[order], START)), pa.array(np.append(times, learned.sum()), pa.int64())]
    lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns]
    names = [part.split()[0] for part in BLOCKS.split(", ")]
    return pa.RecordBatch.from_arrays([*lists, pa.array([_packed(place)], pa.binary())], names)


def _blocks(docs: DataFrame) -> DataFrame:
    """Blocks of (doc_id, learn, hashes of words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            ends = np.cumsum(np.diff(batch.column(2).offsets.to_numpy()) + 1)
            at, before = 0, 0
            while at < batch.num_rows:
                stop = max(at + 1, int(np.searchsorted(ends, before + BLOCK - n, "right")))
                held.append(batch.slice(at, stop - at))
                n += ends[stop - 1] - before
                at, before = stop, ends[stop - 1]
                if n >= BLOCK or at < batch.num_rows:
                    yield _block(held)
                    held, n = [], 0
        if held:
            yield _block(held)

    return docs.mapInArrow(run, BLOCKS)


class _Pairs:
    """The distinct bigrams of a block, by the places of their words, and those of known words by part."""

    def __init__(self, block: dict, words: pa.Table, parts: int, frequent: int):
        place, sizes = _unpacked(block["ids"]), np.array(block["sizes"], np.int64)
        self.sizes, self.learn = sizes, np.array(block["learn"], bool)
        n = block["n_words"]
        own, at = words["pos"].to_numpy(), {}
        for name in ("id", "c1"):
            at[name] = np.full(n, -1) if name == "id" else np.zeros(n, np.int64)
            at[name][own] = words[name].to_numpy()
        self.c1, ids = at["c1"], at["id"]
        history = np.empty_like(place)
        history[1:] = place[:-1]
        history[np.cumsum(sizes) - sizes] = n - 1
        code, self.pair = np.unique(history * n + place, return_inverse=True)
        self.h, self.w = np.divmod(code, n)
        known = np.flatnonzero((ids[self.h] >= 0) & (ids[self.w] >= 0))
        h, w = ids[self.h[known]], ids[self.w[known]]
        part = (h + np.where(self.c1[self.h[known]] > frequent, w, 0)) % parts
        order = np.lexsort((w, h, part))
        #: Sent bigrams, in the order in which they are sent.
        self.sent, self.sent_h, self.sent_w, part = known[order], h[order], w[order], part[order]
        self.parts, self.starts = np.unique(part, return_index=True)

    def messages(self) -> Iterator[tuple[int, list[bytes]]]:
        """Part; first words and the numbers of bigrams that begin with them, second words, their counts, and times learned."""
        times = np.bincount(self.pair[np.repeat(self.learn, self.sizes)], minlength=len(self.h))[self.sent]
        c1 = self.c1[self.w[self.sent]]
        for part, start, stop in zip(self.parts, self.starts, np.append(self.starts[1:], len(self.sent))):
            h = self.sent_h[start:stop]
            first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            arrays = (np.diff(h[first], prepend=0), np.diff(np.append(first, len(h))), self.sent_w[start:stop],
                      c1[start:stop], times[start:stop])
            yield int(part), [_packed(x) for x in arrays]


MESSAGES = "of long, part int, heads binary, lengths binary, w binary, c1 binary, times binary"
SUMS = [f"n{r}" for r in range(1, TRUSTED + 2)]
PARTS = f"of long, part int, counts binary, h array<long>, {', '.join(f'{s} array<long>' for s in SUMS)}, ph array<double>"


def _bigrams(blocks: DataFrame, located: DataFrame, parts: int, frequent: int) -> DataFrame:
    """The bigrams of every block for every part: ``MESSAGES``."""

    def run(key, block: pa.Table, words: pa.Table) -> pa.Table:
        rows = [(part, *own) for part, own in _Pairs(block.to_pylist()[0], words, parts, frequent).messages()]
        columns = list(zip(*rows)) or [()] * 6
        kinds = [pa.int32(), *[pa.binary()] * 5]
        arrays = [pa.array([key[0].as_py()] * len(rows), pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds))]
        return pa.table(arrays, [part.split()[0] for part in MESSAGES.split(", ")])

    return blocks.groupBy("block").cogroup(located.groupBy("of")).applyInArrow(run, MESSAGES)


def _counted(messages: DataFrame, ratios: dict[int, float], whole: int) -> DataFrame:
    """Counts of the bigrams of every message, and sums over the distinct ones by first word: ``PARTS``.

    These sums are the numbers of bigrams that occur once, twice ..., and the share of their second words.
    """

    def run(sent: pa.Table) -> pa.Table:
        heads, lengths, w, c1, times = (
            [_unpacked(x) for x in sent[name].to_pylist()] for name in ("heads", "lengths", "w", "c1", "times")
        )
        ends = np.cumsum([len(x) for x in w])
        first, lengths = np.concatenate([np.cumsum(x) for x in heads]), np.concatenate(lengths)
        w, c1, times = np.concatenate(w), np.concatenate(c1), np.concatenate(times)
        h, local = np.unique(first, return_inverse=True)
        width = int(w.max()) + 1
        code = np.repeat(local, lengths) * width + w
        order = np.argsort(code, kind="stable")
        code = code[order]
        at = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        c2 = np.add.reduceat(times[order], at)
        counts = np.empty_like(code)
        counts[order] = np.repeat(c2, np.diff(np.append(at, len(code))))
        learned = c2 > 0
        own, c2, share = code[at][learned] // width, c2[learned], _discounted(c1[order][at][learned], ratios) / whole
        kept = np.flatnonzero(np.bincount(own, minlength=len(h)))
        sums = [np.bincount(own[c2 == r], minlength=len(h))[kept] for r in range(1, TRUSTED + 2)]
        columns = [h[kept], *sums, np.bincount(own, share, len(h))[kept]]
        offsets = pa.array([0] + [len(kept)] * len(sent), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(c)) for c in columns]
        back = pa.array([_packed(x) for x in np.split(counts, ends[:-1])], pa.binary())
        names = [part.split()[0] for part in PARTS.split(", ")]
        return pa.table([sent["of"], sent["part"], back, *lists], names)

    return messages.groupBy("part").applyInArrow(run, PARTS)


SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def scores(docs: DataFrame, learn: Column) -> DataFrame:
    """Per document: held_out, n_tokens, n_known, train_tokens, base_score and score (log10).

    Rows where ``learn`` holds are learned from; all are scored, whole. Null text is empty and
    has one token, its end. Every row is a document, whatever its id, and counts in the statistics.
    Runs jobs when called; an empty table gives an empty result, and with nothing to learn from all words are unknown.
    """
    spark = docs.sparkSession
    small_batches(spark)
    at = {label: new_path(spark, label) for label in ("words", "located", "histories")}
    hashes = F.transform(words(F.col("text")), lambda w: F.xxhash64(w))
    rows = docs.select(F.col("doc_id").cast("long"), learn.alias("learn"), hashes)
    with _shuffles_dropped(spark):
        blocks = _blocks(rows).withColumn("block", F.monotonically_increasing_id()).withColumn("n_words", F.size("words"))
        blocks = written(blocks, "blocks")
        lists = blocks.select("block", F.posexplode(F.arrays_zip("words", "times")).alias("pos", "own"))
        counts = lists.groupBy(F.col("own.words").alias("w")).agg(F.sum("own.times").alias("c1")).where("c1 > 0")
        numbered = written_at(counts.withColumn("place", F.monotonically_increasing_id()), at["words"])

        of_words = numbered.where(F.col("w") != START)
        total, kinds = of_words.agg(F.coalesce(F.sum("c1"), F.lit(0)), F.count("*")).first()
        few = of_words.where(F.col("c1") <= TRUSTED + 1).groupBy("c1").agg(F.count("*").alias("n")).collect()
        few = {r.c1: r.n for r in few}
        ratios = discounts(few)
        discounted = sum(r * (1 - ratios[r]) * few.get(r, 0) for r in ratios)
        # if no word was discounted, one count more is reserved for the unknown one
        whole = total if discounted > 0 else total + 1
        unknown = (discounted if discounted > 0 else 1) / whole

        # numbers from 0 without large gaps: the row within its partition, then the partition
        dealt = numbered.agg(F.coalesce(F.max(F.shiftright("place", 33)), F.lit(0)) + 1).first()[0]
        row = F.col("place").bitwiseAND((1 << 33) - 1)
        ids = numbered.select("w", "c1", (row * dealt + F.shiftright("place", 33)).alias("id"))
        located = lists.select(F.col("block").alias("of"), "pos", F.col("own.words").alias("w")).join(ids, "w")
        located = written_at(located.select("of", "pos", "id", "c1"), at["located"])
        drop_path(spark, at["words"])

        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // PART)
        frequent = total // (4 * parts)
        texts = blocks.select("block", "n_words", "learn", "sizes", "ids")
        counted = written(_counted(_bigrams(texts, located, parts, frequent), ratios, whole), "bigrams")
        sums = counted.where("h is not null").select(F.explode(F.arrays_zip("h", *SUMS, "ph")).alias("s")).select("s.*")
        sums = sums.groupBy("h").agg(*(F.sum(s).alias(s) for s in [*SUMS, "ph"]))
        histories = written_at(sums, at["histories"])

        few = histories.agg(*(F.coalesce(F.sum(s), F.lit(0)) for s in SUMS)).first()
        pair_ratios = discounts(dict(enumerate(few, 1)))
        # what discounts take from a history; one whose words are all trusted reserves one count,
        # so that unseen words stay possible
        taken = sum((F.col(f"n{r}") * (r * (1 - ratio)) for r, ratio in pair_ratios.items()), F.lit(0.0))
        full = (taken <= 1e-9).alias("full")
        left = (F.when(taken > 1e-9, taken).otherwise(1.0) / F.greatest(1 - F.col("ph"), F.lit(1e-300))).alias("left")
        of_history = histories.select(F.col("h").alias("id"), full, left)
        answers = written(located.join(of_history, "id", "left"), "answers")
        for label in ("located", "histories"):
            drop_path(spark, at[label])

    def run(key, block: pa.Table, answers: pa.Table) -> pa.Table:
        block, replied = block.to_pylist()[0], answers["counts"].is_valid()
        words, counts = answers.filter(answers["id"].is_valid()), answers.filter(replied)
        own = _Pairs(block, words, parts, frequent)
        order = np.argsort(counts["part"].to_numpy())
        c2 = np.zeros(len(own.h), np.int64)
        replies = counts["counts"].to_pylist()
        if replies:
            c2[own.sent] = np.concatenate([_unpacked(replies[i]) for i in order])
        # every word learned from is followed by one, END at last; unknown words and END are no histories
        of, back, history = own.c1.astype(float), np.ones(len(own.c1)), words.filter(words["left"].is_valid())
        at = history["pos"].to_numpy()
        of[at] += history["full"].to_numpy()
        back[at] = history["left"].to_numpy() / of[at]
        p = np.where(own.c1 > 0, _discounted(own.c1, ratios) / whole, unknown)
        base = np.log10((own.c1 + 0.5) / (total + 0.5 * (kinds + 1)))[own.w]
        logp = np.log10(back)[own.h] + np.log10(p)[own.w]
        seen = np.flatnonzero(c2)
        logp[seen] = np.log10(_discounted(c2[seen], pair_ratios) / of[own.h[seen]])
        doc = np.repeat(np.arange(len(own.sizes)), own.sizes)
        summed = [np.bincount(doc, x[own.pair], len(own.sizes)) for x in (own.c1[own.w] > 0, base, logp)]
        return pa.table([
            pa.array(block["doc_ids"], pa.int64()), pa.array(~own.learn), pa.array(own.sizes),
            pa.array(summed[0].astype(np.int64)), pa.array(np.full(len(own.sizes), total)), pa.array(summed[1]),
            pa.array(summed[2]),
        ], [part.split()[0] for part in SCORES.split(", ")])

    answers = answers.unionByName(counted.select("of", "part", "counts"), allowMissingColumns=True)
    texts = blocks.select("block", "n_words", "doc_ids", "learn", "sizes", "ids")
    return texts.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(run, SCORES)
