"""Operators of grainfold.llm against plain versions of them, and on odd rows."""

import hashlib
import math
import re
import string
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from compare import database, difference
from conftest import TABLES
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from grainfold.llm import ann, chat, decontaminate, katz, language, minhash, packing, pii, suffixes, toxicity
from grainfold.llm.components import components
from grainfold.llm.oracle import ORACLE
from grainfold.llm.queries import QUERIES, TOKENIZER
from grainfold.llm.tokens import unit_ids
from grainfold.llm import words as expressions
from grainfold.llm.words import NOT_ALNUM, NOT_ALNUM_CASED, SPACES, fold, word_count
from grainfold.session import shared_folder

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SENTENCE = "the quick brown fox jumps over the lazy dog while seven wizards mix potent elixirs behind old barns"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(20_000))
ODD = [
    (1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t ", "en", "s", 4), (4, LONG, "en", "s", len(LONG)),
    (5, SENTENCE, "en", "s", len(SENTENCE)), (5, SENTENCE, "en", "s", len(SENTENCE)), (6, SENTENCE, None, None, None),
    (None, SENTENCE, "en", "s", 3), (7, "é ü 日本 😀 " * 60, "fr", "s", 9), (8, "a b", "en", "s", 3),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(ODD, DOCS)
    return rows.withColumns({n: F.lit("x") for n in ("spans", "row", "severity", "words", "key", "n", "part")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{TABLES}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", lowered(text)) if w]


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    expected = database(str(TABLES)).execute(ORACLE[name]).df()
    assert difference(QUERIES[name](spark, str(TABLES)), expected) is None


# --- 1 ------------------------------------------------------------------------------------


def test_nearest_recall(spark):
    vectors = spark.read.parquet(f"{TABLES}/embeddings.parquet")
    found = ann.search(vectors, F.col("vec_id") % 20 == 0).collect()
    rows = [r for r in vectors.collect() if r.embedding]
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    hits = total = 0
    for query in ids[ids % 20 == 0]:
        score = x @ x[ids == query][0]
        score[ids == query] = -np.inf
        best = set(ids[np.lexsort((ids, -score))[:20]].tolist())
        own = sorted((r for r in found if r.query_id == query), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, len(own) + 1))
        assert all(abs(r.score - score[ids == r.vec_id][0]) < 1e-9 for r in own)
        hits, total = hits + len(best & {r.vec_id for r in own}), total + len(best)
    assert hits / total >= 0.9


def test_nearest_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (None, [1.0, 1.0]), (20, [0.5, 0.5]), (2, [2.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("list", F.lit(1))
    found = ann.search(table, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in found] == [
        (0, 1, 2, 2.0), (0, 2, 1, 1.0), (0, 3, 20, 0.5), (20, 1, 2, 1.5), (20, 2, 0, 0.5), (20, 3, 1, 0.5)]
    assert ann.search(table.where("vec_id > 100"), F.lit(True)).count() == 0


def test_nearest_in_several_rounds_and_blocks(spark, monkeypatch):
    for name, value in (("SHARD", 40), ("QUERIES", 10), ("LEAST_SHARDS", 2), ("WIDER", 2), ("LEAST_PROBED", 1_000)):
        monkeypatch.setattr(ann, name, value)
    x = np.random.default_rng(3).integers(-2, 3, (300, 6)).astype(float)
    x[100:220] = x[0] = [2, 1, 0, 0, 0, 1]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = ann.search(table, F.col("vec_id") % 10 == 0).orderBy("query_id", "rank").collect()
    whole = [i for i in range(300) if x[i].any()]
    expected = []
    for q in (i for i in whole if i % 10 == 0):
        near = sorted((-(x[i] @ x[q]), i) for i in whole if i != q)[:20]
        expected += [(q, at, i, -score) for at, (score, i) in enumerate(near, 1)]
    assert [tuple(r) for r in found] == expected


def test_abandoning_keeps_the_nearest():
    x = np.random.default_rng(1).standard_normal((3000, 65))
    kept = 0
    for query in x[:20] + 0.1:
        near = ann.scan(query, x, 20, np.ones(len(x), bool))
        true = np.argsort(((x - query) ** 2).sum(axis=1))[:20]
        kept += len(set(true) & set(near))
        assert len(near) < 1500
    assert kept >= 380


# --- 2 ------------------------------------------------------------------------------------


def check_packing(rows, texts):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    expected = Counter()
    for doc, text in texts:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        first = (len(ids) % 2048 or 2048) if len(ids) > 2048 else len(ids)
        cuts = [0, *range(first, len(ids), 2048), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    return len(places)


def test_packing(docs, texts):
    rows = packing.pack_documents(docs, TOKENIZER).collect()
    n = check_packing(rows, list(texts.items()))
    assert n <= -(-sum(r.length for r in rows) // 2048) + 1


def test_sizes_left():
    """Sizes taken and given back one at a time, in time that does not follow the gaps between them."""
    draw = np.random.default_rng(3)
    sizes = np.append(draw.integers(1, 300, 500), [2048, 2000, 1])
    left, held = packing.Sizes(sizes, 2048), sizes.tolist()
    for _ in range(600):
        own = int(draw.choice(held))
        held.remove(own)
        left.take(own)
        if draw.random() < 0.5:
            own = int(draw.integers(1, 2049))
            held.append(own)
            left.give(own)
        expected = packing.Sizes(np.array(held), 2048)
        assert (left.left == expected.left).all() and (left.below == expected.below).all()
        if len(held) < 2:
            break
    reads = []

    class Watched(np.ndarray):
        def __getitem__(self, at):
            reads.append(at)
            return super().__getitem__(at)

    left = packing.Sizes(np.array([1, 2048]), 2048)
    left.below = left.below.view(Watched)
    left.take(2048), left.take(1), left.give(1)
    assert len(reads) < 10


def test_packing_odd_rows(odd, empty):
    rows = packing.pack_documents(odd, TOKENIZER, keep_ids=True).collect()
    check_packing(rows, [(r[0], r[1]) for r in ODD])
    assert all(len(r.ids) == r.length for r in rows)
    assert packing.pack_documents(empty, TOKENIZER).count() == 0


def test_added_tokens_in_texts():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    texts = ["a  <|endoftext|>  b", "<|endoftext|>", "plain  text", "x<|endoftext|>\ny <|endoftext|><|endoftext|> z ", "", "<|endoftext"]
    plain = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(plain[1]) == 1
    values, sizes = unit_ids(TOKENIZER).ids(pa.array(texts))
    assert [ids.tolist() for ids in np.split(values, np.cumsum(sizes)[:-1])] == plain


@pytest.mark.parametrize("seed", range(6))
def test_bin_completion(seed):
    draw = np.random.default_rng(seed)
    sizes = draw.integers(1, [20, 60, 101, 101, 40, 101][seed], 200)
    bins = packing.bin_completion(sizes, 100, 2000)
    assert sorted(s for b in bins for s in b) == sorted(sizes.tolist())
    assert max(map(sum, bins)) <= 100
    assert len(bins) <= len(packing.best_fit(sizes, 100))


def test_bin_completion_beats_best_fit():
    sizes = np.array([60, 50, 40, 30, 20] * 1 + [50, 40, 10])  # 300 in 3 bins
    assert len(packing.bin_completion(sizes, 100)) == 3


def least_bins(sizes, limit):
    """Fewest bins, by the least (bins, fill of the last one) over all subsets."""
    best = {0: (1, 0)}
    for chosen in range(1, 1 << len(sizes)):
        best[chosen] = min(
            (n, fill + s) if fill + s <= limit else (n + 1, s)
            for i, s in enumerate(sizes) if chosen >> i & 1 for n, fill in [best[chosen & ~(1 << i)]])
    return best[(1 << len(sizes)) - 1][0]


def test_bin_completion_is_exact_on_small_groups():
    assert len(packing.bin_completion(np.array([50, 45, 42, 38, 30, 26, 25, 24, 20]), 100)) == 3
    draw = np.random.default_rng(5)
    for _ in range(150):
        sizes = draw.integers(draw.integers(1, 24), draw.integers(30, 60), draw.integers(1, 11))
        bins = packing.bin_completion(sizes, 100)
        assert sorted(s for b in bins for s in b) == sorted(sizes.tolist()) and max(map(sum, bins)) <= 100
        assert len(bins) == least_bins(sizes.tolist(), 100)


def test_fillings_keep_one_that_dominates_each():
    values, counts, gap = [10, 12, 20, 24, 30], [2, 1, 1, 1, 1], 50
    found = list(packing.fillings(values, counts, gap))
    kept = [f for f in found if f is not None]
    assert kept[0] == (30, 20) and None in found
    assert sorted(kept, key=sum, reverse=True) == kept and len(set(kept)) == len(kept)
    # 30 fits in place of the 24 of (24, 20), and 24 in place of the 20 of (20, 10, 10)
    assert (24, 12, 10) in kept and (20, 10, 10) not in kept and (24, 20) not in kept


# --- 3, 4, 5 ------------------------------------------------------------------------------


def test_language(docs, odd, empty):
    found = language.languages(docs, fold("doc_id")).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    model = language.train(docs, fold("doc_id") != 0)
    rows = language.with_language(odd.select(F.col("doc_id"), F.lit(True).alias("held_out"), "text"), model).collect()
    assert len(rows) == len(ODD)
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {1, 2, 3}
    assert all(0 <= r.score <= 1 for r in rows)
    assert language.languages(empty, fold("doc_id")).count() == 0
    assert {r.lang_pred for r in language.languages(odd.where("lang is null"), fold("doc_id")).collect()} == {"und"}


def test_toxicity(spark, docs, odd, empty):
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    insults = ["you idiot", "pathetic loser scum"]
    more = [(10**6 + i, f"{SENTENCE} {insults[i % 2]} {i} {SENTENCE}", None, None, None) for i in range(40)]
    more += [(2 * 10**6 + i, f"{SENTENCE} {i}", None, None, None) for i in range(40)]
    corpus = docs.unionByName(spark.createDataFrame(more, DOCS))
    flags = [(r[0], 1, int(r[0] < 2 * 10**6)) for r in more if r[0] % 4] + [(None, 1, 1), (10**6 + 1, None, None)]
    own = labels.unionByName(spark.createDataFrame(flags, labels.schema))
    graded = {r.doc_id: r for r in toxicity.graded(corpus, own).collect()}
    assert all(graded[r[0]].rejected == (r[0] < 2 * 10**6) for r in more)
    assert graded[10**6 + 1].severity >= graded[10**6].severity
    clean = toxicity.without_toxic(corpus, own)
    assert clean.columns == corpus.columns
    scored = toxicity.graded(odd, own).collect()
    assert len(scored) == len(ODD) and not any(r.rejected for r in scored)
    assert toxicity.graded(empty, labels).count() == 0
    assert not any(r.rejected for r in toxicity.graded(odd, labels.limit(0)).collect())


def test_texts_are_not_shuffled_for_the_sample(spark):
    wide = spark.range(300_000).selectExpr("id as doc_id", "repeat('some text ', 20) as text")
    labels = spark.range(10_000).selectExpr("id * 30 as doc_id", "cast(id % 2 as int) as toxic")
    plan = toxicity._sample(wide, labels, 5_000)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_thresholds_are_ordered():
    draw = np.random.default_rng(0)
    x = draw.integers(0, 3, (400, 5)).astype(np.float32)
    grades = np.clip((x[:, 0] + x[:, 1]).astype(int), 0, 3)
    weights, thresholds = toxicity.ordinal_fit(x, grades, 4)
    assert (np.diff(thresholds) > 0).all() and min(weights[:2]) > 3 * abs(weights[2:]).max()


def test_katz(docs, texts):
    rows = {r.doc_id: r for r in katz.scores(docs, fold("doc_id") != 1).collect()}
    learned = {d for d in texts if zlib.crc32(str(d).encode()) % 5 != 1}
    tokens = {d: [*plain_words(t), None] for d, t in texts.items()}
    count = Counter(w for d in learned for w in tokens[d])
    pairs = Counter(p for d in learned for p in zip(["<s>", *tokens[d]], tokens[d]))
    total, kinds = sum(count.values()), len(count)
    ratios, pair_ratios = (katz.discounts(Counter(c.values())) for c in (count, pairs))
    kept = sum(c * ratios.get(c, 1) for c in count.values())
    p = {w: c * ratios.get(c, 1) / total for w, c in count.items()}
    seen = {}
    for (h, w), c in pairs.items():
        seen.setdefault(h, {})[w] = c
    of, back = {}, {}
    for h, own in seen.items():
        c, d = sum(own.values()), sum(n * pair_ratios.get(n, 1) for n in own.values())
        of[h] = c if c - d > 1e-9 else c + 1
        back[h] = (of[h] - d) / of[h] / (1 - sum(p[w] for w in own))
    unknown = 1 - kept / total

    def prob(h, w):
        if w in seen.get(h, {}):
            c = seen[h][w]
            return c * pair_ratios.get(c, 1) / of[h]
        return back.get(h, 1.0) * p.get(w, unknown)

    for h in ["<s>", "the", None.__class__]:
        assert math.isclose(sum(prob(h, w) for w in p) + back.get(h, 1.0) * unknown, 1, rel_tol=1e-9)
    for d, own in tokens.items():
        r = rows[d]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (d not in learned, len(own), total)
        assert r.n_known == sum(w in count for w in own)
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in own)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        score = sum(math.log10(prob(h, w)) for h, w in zip(["<s>", *own], own))
        assert math.isclose(r.score, score, rel_tol=1e-7)
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_katz_odd_rows(odd, empty):
    rows = katz.scores(odd, fold("doc_id") != 1).collect()
    assert len(rows) == len(ODD) and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert katz.scores(empty, fold("doc_id") != 1).count() == 0
    assert all(r.n_known == 0 for r in katz.scores(odd, F.lit(False)).collect())


def test_katz_in_blocks_and_parts(docs, monkeypatch):
    one = {r.doc_id: r for r in katz.scores(docs, fold("doc_id") != 1).collect()}
    monkeypatch.setattr(katz, "BLOCK", 3000)
    monkeypatch.setattr(katz, "PART", 2000)
    many = katz.scores(docs, fold("doc_id") != 1).collect()
    assert len(many) == len(one)
    for r in many:
        assert r[:5] == one[r.doc_id][:5]
        assert math.isclose(r.base_score, one[r.doc_id].base_score) and math.isclose(r.score, one[r.doc_id].score)


def test_katz_takes_little_disk(spark):
    draw = np.random.default_rng(5)
    texts = [(i, " ".join(f"word{w}" for w in draw.integers(0, 3000, 300))) for i in range(400)]
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    local = [str(d) for d in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()]

    def files():
        tables = Path(shared_folder(spark).removeprefix("file:")).rglob("*.parquet")
        shuffled = (f for d in local for f in Path(d).rglob("shuffle_*"))
        return {f: f.stat().st_size for found in (tables, shuffled) for f in found}

    before, setting = files(), spark.conf.get(name, None)
    scored = katz.scores(spark.createDataFrame(texts, "doc_id long, text string"), fold("doc_id") != 1)
    # nearly all bigrams are distinct; tables and shuffles with a row for each take over 20 bytes a word
    assert sum(size for f, size in files().items() if f not in before) < 6.5 * 400 * 300
    assert spark.conf.get(name, None) == setting
    assert scored.count() == 400


# --- 6 ------------------------------------------------------------------------------------


def plain_components(rows):
    sets = {}
    for d, text in rows:
        w = plain_words(text)
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(sets[d]), root(d), root(d) == d) for d in sets}


def test_near_duplicates_in_crowded_buckets(spark):
    """Edited copies, documents that share most but not enough, and a passage in all of them."""
    draw = np.random.default_rng(3)
    fresh = lambda n: [f"w{v}" for v in draw.integers(0, 10**9, n)]
    passage, origin = fresh(60), fresh(120)
    rows = []
    for i in range(60):
        copy = list(origin)
        for k in draw.integers(0, 120, 4):
            copy[k] = f"e{i}x{k}"
        rows.append((i, " ".join(copy)))
    rows += [(100 + i, " ".join(passage + fresh(10 + i % 3))) for i in range(60)]
    rows += [(200 + i, " ".join(passage + fresh(20))) for i in range(60)]
    rows.append((300, " ".join(origin)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(table).collect()}
    assert found == plain_components(rows)


def test_crowded_path_alone(spark, settings, monkeypatch):
    """Every open bucket goes the exact way by rare shingles."""
    monkeypatch.setattr(minhash, "_is_light", lambda light=0: F.lit(False))
    monkeypatch.setattr(minhash, "LEADERS", 3)
    test_near_duplicates_in_crowded_buckets(spark)


@pytest.mark.parametrize("paired, rounds", [(4_000_000, 1), (0, 3)])
def test_rounds_of_crowded_buckets(spark, monkeypatch, paired, rounds):
    """Buckets of few pairs are compared in one round; larger ones take several, with the same result."""
    labels = []

    def kept(df, label, write=minhash.written):
        labels.append(label)
        return write(df, label)

    monkeypatch.setattr(minhash, "written", kept)
    monkeypatch.setattr(minhash, "PAIRED", paired, raising=False)
    test_crowded_path_alone(spark, None, monkeypatch)
    assert labels.count("leaders") == 1 if rounds == 1 else labels.count("leaders") >= rounds


def test_components_of_stars(spark, monkeypatch):
    """Links that are stars after one round need no other."""
    from grainfold.llm import components as module

    rounds = []

    def kept(df, label, write=module.written):
        rounds.append(label)
        return write(df, label)

    monkeypatch.setattr(module, "written", kept)
    links = [(1, 2), (3, 1), (1, 4), (1, 2), (5, 5), (None, 6), (9, 8)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted(map(tuple, found)) == [(1, 1), (2, 1), (3, 1), (4, 1), (8, 8), (9, 8)]
    assert len(rounds) == 1
    assert components(spark.createDataFrame([(5, 5), (None, 6)], "a long, b long")).count() == 0


def test_near_duplicates_odd_rows(odd, empty):
    rows = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(odd).collect()
                  if r.doc_id)
    n = len(plain_words(SENTENCE)) - 4
    assert rows == sorted([(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 19996, 4, True), (5, n, 5, True),
                           (5, n, 5, True), (6, n, 5, False), (7, 4, 7, True), (8, 1, 8, True)])
    assert minhash.near_duplicates(odd).count() == len(ODD)
    assert minhash.near_duplicates(empty).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 99), (99, 98), (7, 7), (None, 3)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys([98, 99, 100], 98)}


# --- 7 ------------------------------------------------------------------------------------


def plain_removal(rows, length):
    raws = [(t or "").encode() for _, t in rows]
    count = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for (d, _), raw in zip(rows, raws):
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if count[raw[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((gone & ~np.append(False, gone[:-1])[: len(gone)]).sum())
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        out.append((d or 0, len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def removed(table):
    rows = suffixes.without_repeats(table).collect()
    return sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)


def test_repeats(docs, texts):
    assert removed(docs) == plain_removal(list(texts.items()), 200)


def test_repeats_odd_rows(odd, empty, spark):
    assert removed(odd) == plain_removal([(r[0], r[1]) for r in ODD], 200)
    rows = [(1, "ab" * 300), (2, "x" * 199), (3, "x" * 201), (4, "q" + "ab" * 99 + "z" * 10)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert removed(table) == plain_removal(rows, 200)
    assert suffixes.without_repeats(empty).count() == 0


def test_repeats_of_near_copies(spark, monkeypatch):
    draw = np.random.default_rng(7)
    base = "".join(draw.choice(list("abcdefgh ü"), 2_000))
    rows = []
    for d in range(40):
        at = draw.integers(0, len(base), 3)
        text = "".join(("#" + str(d) if i in at[:2] else "" if i == at[2] else c) for i, c in enumerate(base))
        rows.append((d, text[draw.integers(0, 400) : draw.integers(900, 2_100)]))
    rows += [(40, rows[0][1]), (40, rows[0][1]), (41, "ab" * 400 + base[300:620]), (42, base[301:510])]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    write, sizes = suffixes.written, {}

    def kept(df, label):
        sizes[label] = (out := write(df, label)).count()
        return out

    monkeypatch.setattr(suffixes, "written", kept)
    assert removed(table) == plain_removal(rows, 200)
    # strings of units that differ are no rows of a table; 20,218 of them were written
    assert sum(sizes.values()) < 2_500


def test_repeats_of_one_byte(spark):
    # a unit per byte: their runs must not fall on one hash when they are collected
    table = spark.createDataFrame([(1, "a" * 400_000), (2, "b" * 300)], "doc_id long, text string")
    assert [r[1:4] for r in removed(table)] == [(400_000, 400_000, 1), (300, 300, 1)]


def test_pieces(monkeypatch):
    raw = np.random.default_rng(8).integers(97, 100, 3_000).astype(np.uint8)
    first, last, sample, gram, _ = suffixes.text_units(raw)
    place = (first << 32) | ((last - first) << 16) | (sample - first)
    assert all((a == b).all() for a, b in zip(suffixes._placed(place), (first, last, sample)))
    pieces = suffixes.text_pieces(raw, place, gram)
    strings = []
    for unit, at, low, high, _, before, after in zip(*(p.tolist() for p in pieces)):
        assert 0 <= low <= high < suffixes.PIECE
        assert before.to_bytes(7, "little") == bytes(raw[at - high : at])[::-1] + bytes(7 - high)
        assert after.to_bytes(7, "little") == bytes(raw[at + 193 : at + 200 - low]) + bytes(low)
        strings += range(at - high, at - low + 1)
        assert first[unit] <= at - high and at - low <= last[unit]
    assert sorted(strings) == list(range(len(raw) - 199))
    monkeypatch.setattr(suffixes, "BLOCK", 300)
    assert all((a == b).all() for a, b in zip(pieces, suffixes.text_pieces(raw, place, gram)))


def test_only_rows_asked_for(spark, monkeypatch):
    texts = spark.range(2_000).selectExpr("xxhash64(id) as row", "'t' as text", "id")
    rows = texts.where("id % 100 = 0").select("row")
    left = {r.id for r in suffixes._only(texts, rows).collect()}
    assert left >= set(range(0, 2_000, 100)) and len(left) < 200
    assert suffixes._only(texts, rows.where("false")).count() == 0
    monkeypatch.setattr(suffixes, "ROW_BITS", 64)
    assert suffixes._only(texts, rows).count() == 2_000


# --- 8, 9, 10 -----------------------------------------------------------------------------


def test_chat(spark):
    rows = [
        (1, 0, "u", "Hello there my friend\nhow is it"), (1, 1, "a", "> hello there MY friend\n>  how is it\nFine thanks a lot"),
        (1, 2, "u", ">> Hello there my friend\n>> how is it\n> Fine thanks a lot\n\nok then good"),
        (1, 3, "a", "> ok then good\n\nbye"), (1, 4, "u", "> something nobody wrote\nnew"), (2, 0, "u", None), (2, 1, "u", ""),
        (None, 1, "x", "> ok then good"), (3, 5, "u", "> Hello there my friend\n> how is it"), (3, 5, "u", "> Hello there my friend\n> how is it"),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("path", F.lit(1))
    found = {(r.conv_id, r.turn): (r.reply_to, r.thread, r.depth, r.path, r.text) for r in chat.conversations(table).collect()}
    assert found == {
        (1, 0): (None, 0, 0, [0], "Hello there my friend\nhow is it"), (1, 1): (0, 0, 1, [0, 1], "Fine thanks a lot"),
        (1, 2): (1, 0, 2, [0, 1, 2], "ok then good"), (1, 3): (2, 0, 3, [0, 1, 2, 3], "bye"), (1, 4): (None, 4, 0, [4], "new"),
        (2, 0): (None, 0, 0, [0], ""), (2, 1): (None, 1, 0, [1], ""), (None, 1): (None, 1, 0, [1], ""),
        (3, 5): (None, 5, 0, [5], ""),
    }
    assert chat.conversations(table.limit(0)).count() == 0


def test_chat_links_partial_quotes(spark):
    first = "Dear all, the plan\nis ready for you.\n\nPlease read it soon.\nAsk me anything."
    rows = [
        (1, 0, first), (1, 1, "> Please read it soon.\n> Ask me anything.\nI will"), (1, 2, "> is ready for you.\nWhere is it"),
        (1, 3, "> Dear all, the plan is\n> ready for you.\nrewrapped"), (1, 4, "Yes, agreed"), (1, 5, "> Yes, agreed\nfine"),
        (1, 6, "Yes, agreed"), (1, 7, "> Yes, agreed\nwhose is it"), (1, 8, "Some more\nis ready for you."),
        (1, 9, "> is ready for you.\nthe later one"), (1, 10, "> is ready for you.\n> Ask me anything.\nonly the first has both"),
        (1, 11, "> is ready for you.\n> nobody wrote this one\nnot whole"), (2, 1, "> Ask me anything.\nanother conversation"),
    ]
    table = spark.createDataFrame([(c, t, "u", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")
    found = {(r.conv_id, r.turn): r.reply_to for r in chat.conversations(table).collect()}
    assert {k: v for k, v in found.items() if v is not None} == {
        (1, 1): 0, (1, 2): 0, (1, 3): 0, (1, 5): 4, (1, 9): 8, (1, 10): 0}


def plain_replies(texts):
    """reply_to of each message of one conversation, given as lists of (quoted, lines or empty lines)."""
    def parts(lines):
        blocks = [" ".join(b.split("\n")) for b in "\n".join(lines).strip("\n").split("\n\n")]
        return " ".join(" ".join(lines).split()), set(blocks), {x for x in lines if x}

    own = {t: parts(lines) for t, (_, lines) in enumerate(texts) if any(lines)}
    links = {}
    for at, (quote, _) in enumerate(texts):
        if any(quote):
            run, blocks, lines = parts(quote)
            earlier = [t for t in own if t < at]
            many = len(run.split()) >= 3
            whole = [t for t in earlier if own[t][0] == run][:1] if many else []
            holders = [[t for t in earlier if want <= {own[t][0]} | own[t][1] | own[t][2]] for want in (blocks, lines)]
            links[at] = next((h[-1] for h in (whole, *holders) if h and (many or len(h) == 1)), None)
    return links


def test_chat_equals_plain_links(spark, monkeypatch):
    monkeypatch.setattr(chat, "RANGE", 4)
    draw = np.random.default_rng(3)
    said = ["yes", "no", "maybe so", "one two three", "four five six seven", ""]
    pick = lambda most: [said[i] for i in draw.choice(6, draw.integers(0, most), p=[0.2, 0.2, 0.2, 0.1, 0.1, 0.2])]
    talks = [[(pick(4), pick(5)) for _ in range(40)] for _ in range(15)]
    squeezed = lambda lines: re.sub("\n\n+", "\n\n", "\n".join(lines).strip("\n")).split("\n")
    talks = [[(squeezed(q), squeezed(x)) for q, x in talk] for talk in talks]
    rows = [(c, t, "u", "\n".join([*("> " + x for x in q if any(q)), *x])) for c, talk in enumerate(talks) for t, (q, x) in enumerate(talk)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {(r.conv_id, r.turn): r.reply_to for r in chat.conversations(table).collect()}
    expected = {(c, t): at for c, talk in enumerate(talks) for t, at in plain_replies(talk).items()}
    assert sum(at is not None for at in expected.values()) > 100
    assert found == {k: expected.get(k) for k in found}


def test_chat_of_two_hundred_replies(spark):
    said = [f"this is message number {i}" for i in range(201)]
    rows = [(1, 0, "u", said[0])] + [(1, i, "u", f"> {said[i - 1]}\n{said[i]}") for i in range(1, 201)]
    rows += [(1, 201, "a", f"> {said[150]}\na branch of its own"), (2, 1, "u", f"> {said[5]}\n{said[0]}")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {(r.conv_id, r.turn): (r.reply_to, r.thread, r.depth, r.path) for r in chat.conversations(table).collect()}
    expected = {(1, i): (i - 1 if i else None, 0, i, list(range(i + 1))) for i in range(201)}
    assert found == expected | {(1, 201): (150, 0, 151, [*range(151), 201]), (2, 1): (None, 1, 0, [1])}


def test_decontamination_odd_rows(spark, odd, empty):
    w = plain_words(SENTENCE)
    items = [(1, SENTENCE), (2, " ".join(w[:10])), (3, "Quick, BROWN!"), (4, None), (5, "..."), (None, "lazy dog"), (2, "zzz")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("hash", F.lit(0))
    rows = {r.doc_id: r for r in decontaminate.hit_report(odd, bench).collect()}
    sha = hashlib.sha256(b"1,2,3").hexdigest()
    for d in (5, 6, None):
        assert (rows[d].n_words, rows[d].n_hit, rows[d].n_items, rows[d].items_sha256) == (len(w), len(w), 3, sha)
    for d in (1, 2, 3, 4, 7, 8):
        assert (rows[d].n_hit, rows[d].contaminated, rows[d].items_sha256) == (0, False, hashlib.sha256(b"").hexdigest())
    left = decontaminate.without_hits(odd, bench)
    assert left.columns == odd.columns and left.count() == 6
    assert decontaminate.hit_report(empty, bench).count() == 0
    assert not any(r.contaminated for r in decontaminate.hit_report(odd, bench.limit(0)).collect())


def test_decontamination_shuffles_texts_as_much_on_little_data(spark, settings, monkeypatch):
    """One join of texts, the same on tables of any size; whole documents stay where they are unless very many go."""
    w = SENTENCE.split()
    rows = [(1, SENTENCE), (1, SENTENCE), (2, " ".join(["x"] * 30 + w[2:14])), (3, " ".join(w[:8])), (4, None), (None, SENTENCE.upper())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([("a", SENTENCE), ("b", "lazy dog"), ("c", " ".join(w[3:13]))], "item_id string, text string")
    plans = {}

    def kept(df, label, write=decontaminate.written):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, label)

    monkeypatch.setattr(decontaminate, "written", kept)
    assert [r.doc_id for r in decontaminate.without_hits(docs, bench).collect()] == [3, 4]
    assert "SortMergeJoin" in plans["verified"]
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    left = decontaminate.without_hits(docs, bench)
    assert "Exchange hashpartitioning" not in left._jdf.queryExecution().executedPlan().toString()
    assert [r.doc_id for r in left.collect()] == [3, 4]
    monkeypatch.setattr(decontaminate, "BROADCAST_KEYS", 0)
    assert [r.doc_id for r in decontaminate.without_hits(docs, bench).collect()] == [3, 4]


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def plain_spans(text):
    def valid(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "card":
            total = sum(v - 9 * (v > 9) for v in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))))
            return 13 <= len(digits) <= 19 and total % 10 == 0
        return kind != "phone" or 9 <= len(digits) <= 15

    return [(k, m.start(), m.end()) for k, p in BASE for m in re.finditer(p, text) if valid(k, m[0])]


HARD = [
    "a@b.com_foo@x.y a.b@c..d.e@f.g.h x@y @z.w a@b.c.", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 1.2..3.4.5.6",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 41111111111111112 4111 1111-1111 1111-", "+1 (514) 555-8389 +12 +1234567 +1-234-567-8901-",
    "é 😀 +1 (514) 555-8389 😀 ñ@b.com 日a@b.co", "a@bc.de 41111111 1111 1111", "9" * 5000, "a." * 3000 + "@b.c", "1 " * 4000,
    "a@b" + ".c" * 4000, "password=e1c093f22d3955eaac x", "call 514-555-8389 now", "x@y.z" * 50, "+" * 50 + "1" * 12,
]


def test_base_spans(spark, docs, texts, odd, empty):
    rows = [(i, t) for i, t in enumerate(HARD)]
    more = spark.createDataFrame(rows, "doc_id long, text string")
    for table, plain in ((docs, texts), (more, dict(rows))):
        for r in pii.span_report(table).collect():
            base = plain_spans(plain[r.doc_id])
            listed = ["%s:%d:%d" % s for s in base]
            assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest(), plain[r.doc_id][:80]
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k, _ in BASE]
            assert set(listed) <= set(r.spans.split(",")) | {""}
    assert pii.span_report(odd).count() == len(ODD)
    assert pii.span_report(empty).count() == 0


def test_redaction(spark):
    rows = [(1, "mail a@b.com or +1 (514) 555-8389!", 34), (2, "nothing here", 12), (3, None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    found = {r.doc_id: (r.text, r.n_chars) for r in pii.redacted(table).collect()}
    assert found == {1: ("mail <EMAIL> or <PHONE>!", 24), 2: ("nothing here", 12), 3: (None, None)}


def test_long_secrets_are_covered_whole(spark):
    keys = ["a1B2c" * size for size in (3, 40, 41, 200, 4000)]
    rows = [(i, f"user login password={keys[i % 5]} and more") for i in range(200)]
    rows += [(i, "the token: whatever <") for i in range(200, 300)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for r in pii.with_candidates(table).where("doc_id < 200").collect():
        assert [(s.kind, s.start, s.end) for s in r.candidates] == [("secret", 11, 20 + len(keys[r.doc_id % 5]))]
    assert {r.text for r in pii.redacted(table).where("doc_id < 200").collect()} == {"user login <SECRET> and more"}


def test_label_model_finds_the_reliable_labelers():
    good = dict(pattern=1, gazetteer=1, context=1, shape=1, n=50)
    bad = dict(pattern=0, gazetteer=0, context=-1, shape=0, n=50)
    noisy = dict(pattern=0, gazetteer=1, context=1, shape=1, n=5)
    labels, rates = pii.label_model([good, bad, noisy])
    assert labels[0] > 0.95 and labels[1] < 0.05 and labels[2] > 0.5
    assert rates["gazetteer"][1][1] > 0.8 > rates["gazetteer"][0][1]


# --- the pipeline -------------------------------------------------------------------------


def test_pipeline_stages(spark, docs):
    """Each stage on what the one before it kept, against a plain version of its decision."""
    folder = str(TABLES)
    own = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        after = corpus_pipeline.written(stage(spark, own, folder), name)
        assert after.columns == docs.columns
        before = {r.doc_id: r for r in own.collect()}
        left = {r.doc_id: r for r in after.collect()}
        if name == "toxicity":
            graded = toxicity.graded(own, spark.read.parquet(f"{folder}/labels.parquet"))
            assert set(left) == {r.doc_id for r in graded.where("not rejected").collect()}
        elif name == "near_duplicates":
            plain = plain_components([(d, r.text or "") for d, r in before.items()])
            assert set(left) == {d for d, (_, _, kept) in plain.items() if kept}
        elif name == "decontamination":
            items = [r.text or "" for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            split = lambda t: [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered(t)) if w]
            windows = {" ".join(w[i : i + 10]) for w in map(split, items) if w for i in range(max(1, len(w) - 9))}
            clean = lambda t: not any(f" {x} " in f" {' '.join(split(t))} " for x in windows)
            assert set(left) == {d for d, r in before.items() if clean(r.text or "")}
        else:
            assert set(left) == set(before)
            assert not any(plain_spans(r.text) for r in left.values())
        own = after
    rows = corpus_pipeline.packed(spark, own, folder).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in own.collect()])
    assert TOKENIZER == public_tokenizers.path("byte_bpe_50k.json")


def test_pipeline_on_odd_rows(spark, empty):
    rows = spark.createDataFrame(ODD, DOCS)
    for table, left in ((rows, 7), (empty, 0)):
        for name, stage in corpus_pipeline.STAGES:
            table = corpus_pipeline.written(stage(spark, table, str(TABLES)), name)
            if name == "near_duplicates":
                # the two rows of 5 and the copy in 6 become one; the row without an id stays
                assert table.count() == (left and 8)
        assert table.columns[:5] == ["doc_id", "piece", "start", "length", "ids_crc32"]


def test_near_duplicates_of_several_texts_under_one_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (5, b), (6, c), (6, None), (6, ""), (7, b + " more"), (8, "something else"), (None, a)]
    table = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], DOCS).repartition(4)
    left = corpus_pipeline.without_near_duplicates(spark, table, str(TABLES))
    assert left.columns == table.columns
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter(
        [(3, a), (5, b), (6, c), (6, None), (6, ""), (8, "something else"), (None, a)])


def test_lowering_and_word_counts_of_every_character(spark):
    chars = spark.range(0x110000).where("id not between 55296 and 57343")
    text = F.decode(F.unhex(F.lpad(F.hex("id"), 8, F.lit("0"))), "UTF-32")
    every = chars.select(F.concat(F.lit("A"), text, F.lit("Bz")).alias("text"))
    every = every.unionByName(spark.createDataFrame([(None,), ("",), (" ",), ("A",), (" a B ",), ("  ",)], "text string"))
    plain = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    assert every.where(~expressions.lowered(F.col("text")).eqNullSafe(plain)).isEmpty()
    for breaks, cased in ((SPACES, SPACES), (NOT_ALNUM, NOT_ALNUM_CASED)):
        counted = F.size(expressions.words(F.col("text"), breaks))
        assert every.where(word_count(F.col("text"), cased) != counted).isEmpty()
