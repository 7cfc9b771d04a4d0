"""Benchmark decontamination: windows of test items looked up in documents.

The main path is DataFrame expressions only. The hashed windows of the benchmark are broadcast as long as
there are at most ``BROADCAST_WINDOWS`` of them, counted first; beyond that Spark joins by a
shuffle. Hits are then verified word by word.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainfold.llm.words import NOT_ALNUM, NOT_ALNUM_CASED, word_count, words
from grainfold.session import written

WINDOW = 10
BROADCAST_WINDOWS = 1_000_000
#: The same for the keys of documents that go.
BROADCAST_KEYS = 1_000_000
KEY = ["id_key", "text_key"]


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows are told apart by doc_id and text; neither key is null."""
    return docs.withColumns({
        "id_key": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))),
        "text_key": F.xxhash64("text"),
    })


def _runs(of: Column, size: Column | int) -> Column:
    """All runs of ``size`` words, in order; null if there are fewer words."""
    at = F.sequence(F.lit(1), F.size(of) - size + 1)
    return F.when(F.size(of) >= size, F.transform(at, lambda i: F.slice(of, i, size)))


def _hashed_runs(of: Column, size: int) -> Column:
    at = F.sequence(F.lit(1), F.size(of) - size + 1)
    return F.when(F.size(of) >= size, F.transform(at, lambda i: F.xxhash64(F.slice(of, i, size))))


def item_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, length, hash, window): the windows of all items; a short item is one window."""
    split = benchmark.select("item_id", words(F.col("text"), NOT_ALNUM).alias("words"))
    split = split.where(F.size("words") > 0).withColumn("length", F.least(F.size("words"), F.lit(size)))
    rows = split.select("item_id", "length", F.explode(_runs(F.col("words"), F.col("length"))).alias("window"))
    return rows.withColumn("hash", F.xxhash64("window")).distinct()


def _verified(docs: DataFrame, benchmark: DataFrame, size: int) -> tuple[DataFrame, DataFrame] | None:
    """The windows of the benchmark, and (keys, start, length, hash) of where they occur; None if there are none."""
    windows = written(item_windows(benchmark, size), "windows")
    known = windows.select("length", "hash").distinct()
    lengths = sorted(r.length for r in known.select("length").distinct().collect())  # size at most
    if not lengths:
        return None
    if known.count() <= BROADCAST_WINDOWS:
        known = F.broadcast(known)
    keyed = _keyed(docs).select(*KEY, "text")
    split = keyed.select(*KEY, words(F.col("text"), NOT_ALNUM).alias("words"))
    found = []
    for length in lengths:
        runs = split.select(*KEY, F.posexplode(_hashed_runs(F.col("words"), length)).alias("at", "hash"))
        found.append(runs.join(known.where(F.col("length") == length), "hash"))
    places = functools.reduce(DataFrame.unionByName, found).groupBy(*KEY).agg(
        F.collect_set(F.struct((F.col("at") + 1).alias("start"), "length", "hash")).alias("places")
    )
    places = written(places, "places")

    verbatim = F.transform(
        "places", lambda p: F.struct(
            p.start.alias("start"), p.length.alias("length"), p.hash.alias("hash"),
            F.slice("words", p.start, p.length).alias("window"),
        )
    )
    # only texts with places are split again; always by a merge join: places may be a broadcast on little data, not on much
    hit = keyed.join(places.hint("merge"), KEY).select(*KEY, "places", words(F.col("text"), NOT_ALNUM).alias("words"))
    seen = hit.select(*KEY, F.inline(verbatim)).distinct()
    verified = seen.join(windows.select("length", "hash", "window").distinct(), ["length", "hash", "window"])
    return windows, written(verified.select(*KEY, "start", "length", "hash"), "verified")


def hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame | None:
    """Verified hits by document: id_key, text_key, spans and items; None if no item has a word.

    spans: struct (start, length) by start, the first word of a text being 1. items: distinct ids of
    the items whose windows occur, as strings, sorted. Runs jobs when called.
    """
    found = _verified(docs, benchmark, size)
    if found is None:
        return None
    windows, verified = found
    spans = verified.groupBy(*KEY).agg(F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans"))
    of_window = windows.where("item_id is not null").select("item_id", "length", "hash").distinct()
    items = verified.select(*KEY, "length", "hash").distinct().join(of_window, ["length", "hash"])
    items = items.groupBy(*KEY).agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")
    )
    return spans.join(items, KEY, "left")


def _covered(spans: Column) -> Column:
    """Number of words within any span."""
    start = F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("n"))

    def add(done: Column, span: Column) -> Column:
        end = span.start + span.length - 1
        new = F.greatest(F.lit(0), end - F.greatest(span.start, done.to + 1) + 1)
        return F.struct(F.greatest(done.to, end).alias("to"), (done.n + new).alias("n"))

    return F.aggregate(spans, start, add, lambda done: done.n)


def hit_report(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Rows are told apart by doc_id and text, so that repeated rows get equal results and rows without
    a doc_id are looked at like others. Null and empty texts have no words and no hits. An empty
    benchmark, or items without words, hit nothing; items without an id hit words but are not
    listed. Other columns are not read.
    """
    rows = _keyed(docs).select(
        *KEY, F.col("doc_id").cast("long").alias("doc_id"),
        word_count(F.col("text"), NOT_ALNUM_CASED).cast("long").alias("n_words"),
    )
    found = hits(docs, benchmark, size)
    if found is None:
        rows = rows.withColumns({"spans": F.lit(None), "items": F.lit(None).cast("array<string>"),
                                 "n_hit": F.lit(0).cast("long")})
    else:
        rows = rows.join(found, KEY, "left").withColumn("n_hit", F.coalesce(_covered(F.col("spans")), F.lit(0)))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select(
        "doc_id", "n_words", F.col("n_hit").cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def without_hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window; all columns stay."""
    found = _verified(docs, benchmark, size)
    if found is None:
        return docs
    gone = written(found[1].select(*KEY).distinct(), "gone")
    # the documents themselves are only shuffled where very many go
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_KEYS else gone.hint("merge")
    keyed = _keyed(docs.withColumn("row", F.struct(*docs.columns)).select("row", "doc_id", "text"))
    return keyed.join(gone, KEY, "left_anti").select("row.*")
