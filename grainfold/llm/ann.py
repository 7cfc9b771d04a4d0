"""Nearest vectors by inner product: inverted lists scanned by adaptive dimension blocks.

Vectors get one more dimension that makes their norms equal, so that the largest inner product is the smallest
distance, and are then turned by a random rotation. Within a probed list the scan reads the rotated
vectors block of dimensions by block. After each block a hypothesis test compares the partial distance,
scaled to all dimensions, with the worst of the best found so far, and candidates that are too far with
high confidence are abandoned. What is left is scored exactly on the original vectors. A share of the rows is scanned
first, and the k-th score found there is the bound that a query brings to the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainfold.session import written

NEAREST = 20
SAMPLE = 20_000
#: Lists at most (the square root of the rows up to then), and lists probed: a share of them, and at least so many.
MOST_LISTS = 4_096
PROBED, LEAST_PROBED = 0.6, 24
BLOCK = 16
#: Width of the test, in standard deviations of a rotated partial distance.
CONFIDENCE = 2.1
#: Vectors of a shard and queries of a block at most, on average; shards at least; pairs of them held at a time.
SHARD, QUERIES, LEAST_SHARDS = 32_768, 8_192, 8
PAIRS = 500_000
#: How many times more shards each round of the search has covered than the one before.
WIDER = 8
SEED = 7


def usable(vector: Column) -> Column:
    """Whether a vector is not null or zero and has only finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _rotation(n: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((n, n)))
    return q * np.sign(np.diag(r))


def _centres(sample: np.ndarray, lists: int) -> np.ndarray:
    """k-means on the bounded sample, on the driver."""
    rng = np.random.default_rng(SEED)
    centres = sample[rng.choice(len(sample), lists, replace=False)].copy()
    for _ in range(8):
        near = _nearest(sample, centres, 1)[:, 0]
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        counts = np.bincount(near, minlength=lists)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray, k: int) -> np.ndarray:
    own = (centres**2).sum(axis=1)
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), 1024):
        far = own - 2 * x[at : at + 1024] @ centres.T
        out[at : at + 1024] = np.argpartition(far, k - 1, axis=1)[:, :k] if k < len(centres) else np.argsort(far)
    return out


def scan_many(
    queries: np.ndarray, rotated: np.ndarray, k: int, keep: np.ndarray, bound: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a query and a row that may be among its k nearest, for all queries of a list at once.

    ``bound`` is a squared distance within which a query already has k vectors, or infinite; ``keep`` says which
    rows are candidates of which query. Partial distances are taken block by block, with early abandonment of pairs.
    """
    n = rotated.shape[1]
    if len(rotated) > k:
        # the first rows in full give a first bound
        few = rotated[: k + 1]
        near = ((queries[:, None, :] - few[None, :, :]) ** 2).sum(axis=2)
        near = np.sort(np.where(keep[:, : k + 1], near, np.inf), axis=1)[:, k - 1]
        bound = np.minimum(bound, near * (1 + 1e-9))
    whole, end = np.zeros(keep.shape), 0
    # blocks of all pairs by matrix product while most of them are alive
    while end < n and (end == 0 or 4 * np.count_nonzero(keep) > keep.size):
        at, end = end, min(n, end + BLOCK)
        q, x = queries[:, at:end], rotated[:, at:end]
        whole += (q**2).sum(axis=1)[:, None] + (x**2).sum(axis=1) - 2 * (q @ x.T)
        if end < n and len(rotated) > k:
            # the k that look nearest so far, in full, tighten the bound
            likely = np.argpartition(np.where(keep, whole, np.inf), k - 1, axis=1)[:, :k]
            full = ((queries[:, None, :] - rotated[likely]) ** 2).sum(axis=2)
            full = np.where(np.take_along_axis(keep, likely, axis=1), full, np.inf).max(axis=1)
            bound = np.minimum(bound, full * (1 + 1e-9))
        # products cancel: equal vectors may come out a little apart
        keep = keep & (whole <= _limit(bound, end, n)[:, None] + 1e-9 * (bound[:, None] + 1))
    alive, row = np.nonzero(keep)
    partial = whole[alive, row]
    while end < n:
        at, end = end, min(n, end + BLOCK)
        partial = partial + ((queries[alive, at:end] - rotated[row, at:end]) ** 2).sum(axis=1)
        stay = partial <= _limit(bound, end, n)[alive] + 1e-9 * (bound[alive] + 1)
        alive, row, partial = alive[stay], row[stay], partial[stay]
    return alive, row


def _limit(bound: np.ndarray, seen: int, n: int) -> np.ndarray:
    """Largest partial distance over ``seen`` of n dimensions that the test lets pass."""
    if seen == n:
        return bound * (1 + 1e-9)
    return bound * (1 + CONFIDENCE / np.sqrt(seen)) ** 2 * seen / n


def scan(query: np.ndarray, rotated: np.ndarray, k: int, keep: np.ndarray) -> np.ndarray:
    """Rows that may be among the k nearest of one query, of which nothing is known yet."""
    return scan_many(query[None, :], rotated, k, keep[None, :], np.array([np.inf]))[1]


def search(
    vectors: DataFrame, is_query: Column, k: int = NEAREST, id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The k nearest found of every query row: query_id, rank, vec_id, score.

    Nearest by inner product in double precision, ties to the smaller id; a row is no candidate of its
    own query. Rows with a null id, or a vector that is null, zero or not finite or of another length than most
    take no part. Repeated rows of an id are one vector. Runs jobs when called; other columns are not read.

    The index is fitted on at most about ``SAMPLE`` vectors and holds every row. Rows are dealt to shards by the hash
    of their id, so that every shard has its share of each list and a list of copies is spread over tasks. A query
    meets one shard first, then ``WIDER`` times as many in every round, each time with the k-th score found so far.
    """
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x"),
        F.coalesce(is_query, F.lit(False)).alias("query"),
    )
    rows = rows.where(usable(F.col("x")) & F.col("vec_id").isNotNull()).dropDuplicates(["vec_id"])
    sizes = rows.groupBy(F.size("x").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = written(rows.where(F.size("x") == sizes.n), "vectors")
    count = sizes.rows
    norm = float(rows.select(F.max(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))).first()[0])
    share = min(1.0, SAMPLE / count)
    sampled = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) < share * 1_000_000)
    # at most about SAMPLE vectors
    sample = _lifted(np.array([r.x for r in sampled.select("x").orderBy("vec_id").collect()]), norm, False)
    turn = _rotation(sizes.n + 1)
    lists = max(1, min(MOST_LISTS, int(np.sqrt(count)), len(sample) // 8))
    centres = _centres(sample @ turn, lists)
    probed = min(lists, max(LEAST_PROBED, int(np.ceil(PROBED * lists))))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = np.stack(batch["x"].to_numpy())
                near = _nearest(_lifted(x, norm, False) @ turn, centres, 1)[:, 0]
                yield pd.DataFrame({"list": near, "vec_id": batch["vec_id"], "x": batch["x"]})

    schema_list = "list long, vec_id long, x array<double>"
    stored = written(rows.select("vec_id", "x").mapInPandas(assign, schema_list), "lists")
    shards = max(LEAST_SHARDS, -(-count // SHARD))
    queries = rows.where("query").select(F.col("vec_id").alias("query_id"), "x")
    blocks = max(1, -(-queries.count() // QUERIES))
    stored = stored.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)))
    stored = stored.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def within(key, queries: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        if not len(queries) or not len(own):
            return none
        own = own.sort_values("vec_id")
        ids, x = own["vec_id"].to_numpy(), np.stack(own["x"].to_numpy())
        rotated = _lifted(x, norm, False) @ turn
        out = [none]
        lists_of = own["list"].to_numpy()
        step = max(1, PAIRS // len(own))
        for at in range(0, len(queries), step):
            part = queries.iloc[at : at + step]
            asked_ids, vector = part["query_id"].to_numpy(), np.stack(part["x"].to_numpy())
            least = part["least"].to_numpy(np.float64)
            least = np.where(np.isnan(least), -np.inf, least - 1e-9 * np.abs(least))
            bound = np.maximum(0, (vector**2).sum(axis=1) + norm - 2 * least)
            turned = _lifted(vector, norm, True) @ turn
            is_probed = np.zeros((len(part), lists), bool)
            np.put_along_axis(is_probed, _nearest(turned, centres, probed), True, axis=1)
            who, row = scan_many(turned, rotated, k, is_probed[:, lists_of] & (ids != asked_ids[:, None]), bound)
            score = np.einsum("ij,ij->i", x[row], vector[who])
            better = score >= least[who]
            who, row, score = who[better], row[better], score[better]
            order = np.lexsort((ids[row], -score, who))
            who, row, score = who[order], row[order], score[order]
            # place of a pair among those of its query
            place = np.arange(len(who)) - np.searchsorted(who, who)
            best = place < k
            out.append(pd.DataFrame({
                "query_id": asked_ids[who[best]], "vec_id": ids[row[best]], "score": score[best],
            }))
        return pd.concat(out)

    best = vectors.sparkSession.createDataFrame([], "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    low, high = 0, 1
    while low < shards:
        least = best.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("least"))
        own_hash = F.xxhash64("query_id")
        steps = F.explode(F.sequence(F.lit(low), F.lit(min(high, shards) - 1)))
        asked = queries.join(least, "query_id", "left").withColumn("step", steps)
        asked = asked.withColumn("shard", F.pmod(F.pmod(own_hash, F.lit(shards)) + F.col("step"), F.lit(shards)))
        asked = asked.withColumn("block", F.pmod(own_hash, F.lit(blocks)).cast("int"))
        cells = asked.select("shard", "block", "query_id", "x", "least").groupBy("shard", "block").cogroup(
            stored.select("shard", "block", "list", "vec_id", "x").groupBy("shard", "block")
        )
        found = cells.applyInPandas(within, "query_id long, vec_id long, score double").unionByName(best)
        top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        best = written(top.select("query_id", "vec_id", "score"), "best")
        low, high = high, high * WIDER
    return best.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score")


def _lifted(x: np.ndarray, norm: float, query: bool) -> np.ndarray:
    """One more dimension: what is missing to the largest squared norm, or 0 for queries."""
    rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, norm - (x**2).sum(axis=1)))
    return np.hstack([x, rest[:, None]])
