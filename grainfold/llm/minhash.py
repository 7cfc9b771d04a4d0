"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Two permutations of the 2**32 hash values are enough: the first scatters the shingles, and
the second, shifted circularly by k, gives coordinate k of the signature. Bands of the
signature make buckets; candidates of a bucket are confirmed on full shingle sets.

A bucket of m documents is never turned into its m * m pairs. Every member is compared with a
leader first, links merge documents into components, and only pairs of different components are
left. Where these are still many, the members are dealt anew by the rare shingles that two
similar sets must share.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grainfold.llm.components import components
from grainfold.llm.words import small_batches, words
from grainfold.session import written

SHINGLE = 5
SIMILAR = 75  # in hundredths
BANDS = 32
ROWS = 4
#: Agreeing coordinates of two signatures, below which a pair is not verified: more than five
#: standard deviations under the expectation at a similarity of 0.75.
AGREEING = 0.53
#: A bucket whose open pairs are at most so many times its members is compared in full.
LIGHT = 8
LEADERS = 512
#: A crowded bucket may have more leaders in a round, as long as they make no more pairs.
PAIRED = 4_000_000
BLOCK = 1024

ODD = np.uint64(0x9E3779B97F4A7C15)


# --- in numpy: shingles and signatures ----------------------------------------------------


def mix64(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit values (fixed constants of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute32(x: np.ndarray) -> np.ndarray:
    """A permutation of 32-bit values, in place (fixed constants of murmur3)."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def shingle_sets(values: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """Per document the sorted distinct hashes of its shingles, from the hashes of its words."""
    values = values.astype(np.uint64, copy=False)
    n = max(0, len(values) - size + 1)
    rolled = np.zeros(n, np.uint64)
    for k in range(size):
        rolled = (rolled + values[k : k + n]) * ODD
        rolled ^= rolled >> np.uint64(29)
    rolled = mix64(rolled)
    sets = []
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if end - start >= size:
            sets.append(np.unique(rolled[start : end - size + 1]))
        elif end > start:
            whole = hashlib.blake2b(values[start:end].tobytes(), digest_size=8).digest()
            sets.append(np.frombuffer(whole, np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One row of ``coordinates`` 32-bit minima per set; empty sets have the largest value."""
    signed = np.full((len(sets), coordinates), np.uint32(0xFFFFFFFF))
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    full = np.flatnonzero(sizes)
    if not len(full):
        return signed
    hashed = np.concatenate([sets[i] for i in full])
    scattered = permute32((hashed ^ (hashed >> np.uint64(32))).astype(np.uint32))
    owner = np.repeat(full, sizes[full])
    shifts = np.arange(coordinates, dtype=np.uint32)
    for at in range(0, len(scattered), BLOCK):
        owners = owner[at : at + BLOCK]
        block = permute32(scattered[at : at + BLOCK, None] + shifts)
        first = np.flatnonzero(np.append(True, owners[1:] != owners[:-1]))
        least = np.minimum.reduceat(block, first, axis=0)
        signed[owners[first]] = np.minimum(signed[owners[first]], least)
    return signed


def band_keys(signed: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(signed), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
    parts = signed.reshape(len(signed), bands, rows)
    for k in range(rows):
        keys = mix64(keys * ODD + parts[:, :, k])
    return keys


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Small batches: what numpy makes of one is several times its size."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column of 64-bit hashes."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
    return values[offsets[0] : offsets[-1]], offsets - offsets[0]


# --- stages -------------------------------------------------------------------------------


def hashed_words(docs: DataFrame) -> DataFrame:
    hashes = F.transform(words(F.col("text")), lambda w: F.xxhash64(w))
    return docs.select(F.col("doc_id").cast("long"), hashes.alias("words"))


def sketches(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE) -> DataFrame:
    """Per document: number of shingles, fingerprint of the set, short signature, band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            sets = shingle_sets(*_hashes(batch.column(1)), size)
            signed = signatures(sets, bands * rows)
            keys = band_keys(signed, bands, rows).view(np.int64)
            short = (signed & np.uint32(255)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]),
                    pa.array([row.tobytes() for row in short]),
                    pa.array(list(keys), pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "print", "sketch", "keys"],
            )

    return hashed_words(docs).mapInArrow(
        run, "doc_id long, n_shingles long, print binary, sketch binary, keys array<long>"
    )


def full_sets(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            sets = shingle_sets(*_hashes(batch.column(1)), size)
            packed = pa.array([s.tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), packed], ["doc_id", "hashes"])

    return hashed_words(docs).mapInArrow(run, "doc_id long, hashes binary")


def _pairs_with(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    left = table.select(F.col("doc_id").alias("a"), F.col(column).alias("left"))
    right = table.select(F.col("doc_id").alias("b"), F.col(column).alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")


def likely(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """Pairs whose short signatures agree often enough, with that share as ``share``.

    Low bytes of different coordinates agree by chance in 1 of 256; that is in the pairs' favour.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (
                np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                for k in (2, 3)
            )
            share = (left == right).mean(axis=1)
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(share)], ["a", "b", "share"]
            )
            yield out.filter(pa.array(share >= AGREEING))

    return _pairs_with(pairs, table, "sketch").mapInArrow(run, "a long, b long, share double")


def confirmed(pairs: DataFrame, sets: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """Pairs with 100 * intersection >= similar * union, on full sets."""

    def linked(left: bytes, right: bytes) -> bool:
        a, b = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
        if 100 * min(len(a), len(b)) < similar * max(len(a), len(b)):
            return False
        both = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * both >= similar * (len(a) + len(b) - both)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                keep = [linked(x.as_py(), y.as_py()) for x, y in zip(batch.column(2), batch.column(3))]
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _pairs_with(pairs, sets, "hashes").mapInArrow(run, "a long, b long")


class Linker:
    """Keeps what is known while pairs are tested: components so far and sets read so far."""

    def __init__(self, docs: DataFrame, table: DataFrame, size: int, similar: int):
        self.docs, self.table, self.size, self.similar = docs, table, size, similar
        self.sets: DataFrame | None = None
        self.labels: DataFrame | None = None

    def labelled(self, members: DataFrame, node: str = "doc_id", name: str = "component") -> DataFrame:
        """Add the component of ``node``."""
        if self.labels is None:
            return members.withColumn(name, F.col(node))
        found = self.labels.select(F.col("node").alias(node), F.col("component").alias("found"))
        joined = members.join(found, node, "left")
        return joined.withColumn(name, F.coalesce("found", node)).drop("found")

    def open(self, pairs: DataFrame) -> DataFrame:
        """Pairs of different components."""
        both = self.labelled(self.labelled(pairs, "a", "of_a"), "b", "of_b")
        return both.where("of_a <> of_b").drop("of_a", "of_b")

    def read_sets(self, ids: DataFrame) -> None:
        """Full sets of documents, from their texts, once for all tests.

        Always by a merge join: the ids may be a broadcast on little data, not on much.
        """
        texts = self.docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null")
        chosen = texts.join(ids.hint("merge"), "doc_id", "left_semi")
        self.sets = written(full_sets(chosen, self.size).distinct(), "sets")

    def test(self, pairs: DataFrame) -> None:
        """Verify pairs whose sets have been read and merge what they link."""
        new = written(confirmed(pairs, self.sets, self.similar), "new")
        if new.isEmpty():
            return
        if self.labels is not None:
            new = new.unionByName(self.labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
        self.labels = components(new)


def _led(members: DataFrame) -> DataFrame:
    """(key, a, b): each member a of a bucket with the bucket's leader b.

    The leader is the member that meets most documents over all its buckets: in a group of edited copies
    that is the text they were made from, to which all of them are similar even where
    two copies are not.
    """
    met = members.groupBy("doc_id").agg(F.sum("m").alias("met"))
    every = members.join(met, "doc_id")
    leaders = every.groupBy("key").agg(F.max(F.struct("met", "doc_id")).alias("leader"))
    led = every.join(leaders.select("key", F.col("leader.doc_id").alias("b")), "key")
    return led.where("doc_id <> b").select("key", F.col("doc_id").alias("a"), "b")


def _spread(members: DataFrame) -> DataFrame:
    """Open pairs per bucket: members, largest component, and pairs of different components."""
    counts = members.groupBy("key", "component").agg(F.count("*").alias("c"))
    buckets = counts.groupBy("key").agg(
        F.sum("c").alias("m"),
        ((F.sum("c") ** 2 - F.sum(F.col("c") * F.col("c"))) / 2).alias("open"),
        F.max(F.col("c")).alias("most"),
        F.count("*").alias("parts"),
    )
    buckets = buckets.where("parts > 1").select("key", "m", "open", "most")
    # the largest component; of several, all but one count as others, told apart by the smallest id
    main = counts.join(buckets, "key").where("c = most").groupBy("key").agg(F.min("component").alias("main"))
    return buckets.join(main, "key")


def _light_pairs(members: DataFrame, buckets: DataFrame) -> DataFrame:
    """All pairs of different components in light buckets; one of a pair is never of the main one."""
    own = members.join(buckets.select("key", "main"), "key")
    others = own.where("component <> main").select(
        "key", F.col("doc_id").alias("a"), F.col("component").alias("of_a")
    )
    every = own.select(
        "key", F.col("doc_id").alias("b"), F.col("component").alias("of_b"), "main"
    )
    pairs = others.join(every, "key").where("of_a <> of_b and (of_b = main or a < b)")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _is_light(light: int = LIGHT):
    return F.col("open") <= light * F.col("m")


def _rare_shingles(sets: DataFrame, similar: int) -> DataFrame:
    """(key, doc_id, n, left, short): the rare shingles by which similar sets must meet.

    All sets' shingles are put in one order, by the number of sets that hold them. Of two sets
    with a similarity of s, the larger one has a shingle within its first n - ceil(s * n) + 1 that the
    other has within its first n - ceil(2 * s / (1 + s) * n) + 1 (``short``). ``left`` is how many shingles of
    the set come in the order from this one on.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(packed, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), doc)), pa.array(own)], ["doc_id", "key"]
                )

    rows = sets.mapInArrow(unpack, "doc_id long, key long")
    held = rows.groupBy("key").agg(F.count("*").alias("held")).where("held > 1")
    ranked = rows.join(held, "key", "left").groupBy("doc_id").agg(
        F.count("*").alias("n"),
        F.array_sort(F.collect_list(F.when(F.col("held") > 1, F.struct("held", "key")))).alias("shared"),
    )
    # shingles of one set only come first in the order and never match
    alone = F.col("n") - F.size("shared")
    long = F.greatest(F.lit(0), F.col("n") - F.ceil(F.col("n") * similar / 100) + 1 - alone).cast("int")
    short = F.col("n") - F.ceil(F.col("n") * 2 * similar / (100 + similar)) + 1 - alone
    first = ranked.select("doc_id", "n", "shared", short.alias("last"), F.posexplode(F.slice("shared", 1, long)).alias("at", "s"))
    left = F.col("n") - alone - F.col("at")
    return first.select(
        F.col("s.key").alias("key"), "doc_id", "n", left.alias("left"), (F.col("at") < F.col("last")).alias("short")
    )


def near_duplicates(
    docs: DataFrame, similar: int = SIMILAR, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """Per document: n_shingles, component_id and kept.

    ``docs`` has doc_id and text; other columns are not read. Documents are linked when
    100 * intersection >= similar * union of their sets of ``size`` words. component_id is the
    smallest doc_id reachable, kept says whether that is the document's own. Null and
    empty texts and texts without words have no shingles and no links. Repeated rows of a doc_id
    are one document; each row returns. Rows without doc_id are linked with nothing and are kept. With 32 bands of 4 rows
    two documents at the threshold miss each other in every band once in 200,000 times.
    Runs jobs when called.
    """
    small_batches(docs.sparkSession)
    table = written(sketches(docs, bands, rows, size), "sketches")
    full = table.where("n_shingles > 0 and doc_id is not null")
    classes = full.groupBy("print").agg(F.min("doc_id").alias("doc_id"))
    reps = written(
        full.join(classes, ["print", "doc_id"], "left_semi").dropDuplicates(["doc_id", "print"]), "classes"
    )
    spread = reps.select("doc_id", F.explode("keys").alias("key")).distinct()
    shared = spread.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    members = written(spread.join(shared, "key"), "members")
    led = written(_led(members), "led")

    linker = Linker(docs, reps.select("doc_id", "sketch"), size, similar)
    linker.read_sets(members.select("doc_id").distinct())
    linker.test(likely(led.select("a", "b").distinct(), linker.table).select("a", "b"))

    rest = linker.labelled(led.select("key", F.col("a").alias("doc_id")))
    rest = written(rest, "rest")
    open_buckets = written(_spread(rest), "open")
    light = open_buckets.where(_is_light())
    heavy = open_buckets.where(~_is_light())
    linker.test(likely(_light_pairs(rest, light), linker.table).select("a", "b"))
    if not heavy.isEmpty():
        _deal_again(linker, rest.join(heavy, "key", "left_semi").select("doc_id").distinct())

    # a document's class, then the component of the class
    labels = linker.labelled(reps.select("print", "doc_id")).select("print", F.col("component").alias("found"))
    of_print = labels.groupBy("print").agg(F.min("found").alias("found"))
    joined = table.join(of_print, "print", "left").withColumn(
        "component_id", F.when(F.col("n_shingles") > 0, F.coalesce("found", "doc_id")).otherwise(F.col("doc_id"))
    )
    kept = F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True))
    return joined.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def _deal_again(linker: Linker, ids: DataFrame) -> None:
    """The exact way for crowded buckets: members meet by shared rare shingles.

    Each round compares up to ``LEADERS`` sets of a bucket, that can be the smaller one of a similar pair,
    with its members of other components, until no such set is left; more in small buckets, so that these
    need one round.
    """
    ids = written(ids, "crowded")
    sets = linker.sets.join(ids, "doc_id", "left_semi")
    members = written(_rare_shingles(sets, linker.similar), "rare")
    met = members.groupBy("doc_id").agg(F.count("*").alias("met"))
    members = members.join(met, "doc_id")
    while True:
        own = linker.labelled(members.select("key", "doc_id", "n", "left", "short", "met"))
        mixed = own.groupBy("key").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.max("short").alias("some"),
            F.count("*").alias("m"),
        )
        mixed = mixed.where("low <> high and some").select("key", "m")
        own = written(own.join(mixed, "key"), "rare")
        if own.isEmpty():
            return
        by_key = Window.partitionBy("key").orderBy(F.desc("met"), "doc_id")
        ranked = own.where("short").withColumn("rank", F.row_number().over(by_key))
        rank, most = F.col("rank"), max(LEADERS, math.isqrt(PAIRED))
        leaders = ranked.where((rank <= most) & ((rank <= LEADERS) | (rank * F.col("m") <= PAIRED))).select(
            "key", F.col("doc_id").alias("a"), F.col("n").alias("of"), F.col("left").alias("left_a"), F.col("component").alias("of_a")
        )
        leaders = written(leaders, "leaders")
        pairs = own.join(leaders, "key").where("component <> of_a and (of < n or of = n and a < doc_id)")
        # enough can be shared from here on; where it is not the first shared one, the first one tells
        enough = linker.similar * (F.col("n") + F.col("of"))
        pairs = pairs.where((100 + linker.similar) * F.least("left", "left_a") >= enough)
        pairs = pairs.where(100 * F.col("of") >= linker.similar * F.col("n"))
        pairs = pairs.select(F.col("doc_id").alias("a"), F.col("a").alias("b")).distinct()
        linker.test(linker.open(likely(pairs, linker.table).select("a", "b")))
        done = leaders.select("key", F.col("a").alias("doc_id"), F.lit(True).alias("done"))
        members = own.join(done, ["key", "doc_id"], "left").withColumn("short", F.expr("short and done is null"))
