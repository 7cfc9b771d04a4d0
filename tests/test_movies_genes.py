import inspect
import random
import tracemalloc
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from conftest import lines_in
from pyspark.sql import functions as F

from grainfold.operators import counting, itemsets
from grainfold.operators.itemsets import (
    association_rules, basket_fragments, candidates, frequent_itemsets, proper_subsets, to_baskets,
)
from grainfold.plans import genes, jobs, movies
from grainfold.sources import readers, writers

BASKETS = [{1, 2, 3}, {1, 2}, {1, 3}, {2}, {4}, {5}, {6}]


def pairs_of(spark, baskets):
    rows = [(b, i) for b, items in enumerate(baskets) for i in items]
    return spark.createDataFrame(rows, "basket int, item int")


def as_dict(sets):
    return {tuple(r["items"]): r["support"] for r in sets.collect()}


def brute_sets(baskets, support, max_size):
    least = max(1, int(support * len(baskets)))
    found = {}
    for size in range(1, max_size + 1):
        for items in combinations(sorted(set().union(*baskets)), size):
            n = sum(set(items) <= b for b in baskets)
            if n >= least:
                found[items] = n
    return found


def test_genre_average(spark, text_file, tmp_path):
    ratings = text_file("r.csv", "m1,u,4.0,0", "m1,u,2.0,0", "m2,u,5.0,0", "m9,u,1.0,0")
    films = text_file("m.csv", 'm1,"Heat, The",Action|Crime', "m2,Big,Comedy|Action", "short,row")
    out = str(tmp_path / "out")
    jobs.genre_average_rating(spark, ratings, films, output=out)
    got = {g: float(a) for g, a in (row.split(",") for row in lines_in(out))}
    assert got == {"Action": pytest.approx(11 / 3), "Comedy": 5.0, "Crime": 3.0}


def test_repeated_movie_lines_multiply(spark, text_file):
    ratings = readers.read_ratings(spark, text_file("r.csv", "m1,u,4.0,0", "m2,u,1.0,0"))
    films = readers.read_movies(
        spark, text_file("m.csv", "m1,A,War", "m1,A,War", "m2,B,War")
    )
    assert movies.genre_average_rating(ratings, films).first()["avg_rating"] == 3.0
    titles = [tuple(r) for r in movies.most_rated_titles(ratings, films).collect()]
    assert titles == [("A", 2, "A:2"), ("B", 1, "B:1")]


def test_cancers_with_active_gene(spark, text_file, tmp_path):
    geo = text_file(
        "expression.csv", "patientid,geneid,expression_value", "pA,42,1250000", "pA,42,1249999.9",
        "pB,42,2000000", "pC,7,2000000",
    )
    patients = text_file(
        "patients.csv", "id,age,gender,postcode,diseases,drug_response", "pA,1,m,2,leukemia lymphoma,x",
        "pB,1,m,2,leukemia flu,x", "pC,1,m,2,leukemia,x",
    )
    out = str(tmp_path / "out")
    jobs.cancers_with_active_gene(spark, geo, patients, output=out)
    assert lines_in(out) == ["leukemia\t2", "lymphoma\t1"]


def test_a_cancer_listed_twice_counts_twice(spark):
    expression = spark.createDataFrame([("p", 42, 2e6)], "patientid string, geneid int, expression double")
    patients = spark.createDataFrame([("p", "leukemia leukemia")], "id string, diseases string")
    assert genes.cancers_with_active_gene(expression, patients).first()["n"] == 2


def test_itemsets_by_hand(spark):
    sets = as_dict(frequent_itemsets(pairs_of(spark, BASKETS)))
    assert sets == {(1,): 3, (2,): 3, (3,): 2, (1, 2): 2, (1, 3): 2}
    assert set(as_dict(frequent_itemsets(pairs_of(spark, BASKETS), max_size=1))) == {(1,), (2,), (3,)}


def test_ids_that_read_alike_stay_apart(spark):
    sets = as_dict(frequent_itemsets(pairs_of(spark, [{1, 112}, {11, 12}]), support=0.5))
    assert {(1, 112), (11, 12)} <= set(sets)


def test_threshold_of_zero_still_needs_a_basket(spark):
    assert len(as_dict(frequent_itemsets(pairs_of(spark, [{1}, {2}]), support=0.1))) == 2


@pytest.mark.parametrize("support, max_size", [(0.1, 10), (0.2, 2), (0.35, 3)])
def test_itemsets_equal_brute_force(spark, support, max_size):
    draw = random.Random(5)
    baskets = [{i for i in range(8) if draw.random() < 0.15 + 0.08 * i} for _ in range(60)]
    baskets = [b for b in baskets if b]
    pairs = pairs_of(spark, baskets)
    twice = pairs.unionByName(pairs.where("item > 3"))
    got = as_dict(frequent_itemsets(twice, support=support, max_size=max_size))
    assert got == brute_sets(baskets, support, max_size)
    for items, n in got.items():
        assert all(got[s] >= n for s in combinations(items, len(items) - 1) if s)


def small(monkeypatch, settings):
    """Chunks of a few baskets, bitmaps of one word, one pair listed at a time, only shares reported, files of few sets."""
    settings(spark__sql__execution__arrow__maxRecordsPerBatch="7")
    for name, value in {"BLOCK": 3, "CHUNK": 4, "WORDS": 1, "PAIRS": 1, "SETS": 2, "REPORTED": 0}.items():
        monkeypatch.setattr(counting, name, value)


@pytest.mark.parametrize("support", [0.1, 0.3, 0.5])
def test_small_blocks_and_chunks_change_nothing(spark, monkeypatch, settings, support):
    """Pairs that reach their share in some chunks only, and sets over many files."""
    small(monkeypatch, settings)
    baskets = [{1, 2, 3, 4}, {1, 2, 3, 4}, {2, 3, 4, 5}, {1, 3, 5}] * 3 + [set(range(6, 9 + i)) for i in range(5)] + [{9}, {1, 9}]
    got = as_dict(frequent_itemsets(pairs_of(spark, baskets), support=support))
    assert got == brute_sets(baskets, support, 10)


@pytest.mark.parametrize("kinds", [150, 6000])
def test_memory_of_counting_is_bounded(kinds):
    """What a task holds for its chunks does not follow its baskets; four tasks share an executor's Python memory."""
    draw = np.random.default_rng(1)
    sizes = np.full(200_000, 5, np.int32)
    items = np.sort(np.arange(1_000_000).reshape(-1, 5) * 7919 % kinds + np.arange(5) * kinds + draw.integers(0, 2), axis=1)

    def peak(blocks):
        tracemalloc.start()
        for chunk in counting.chunks(counting._block([sizes], [items.ravel()]) for _ in range(blocks)):
            for _ in counting.pairs_in(chunk):
                pass
        top = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return top

    assert peak(9) < 300e6


@pytest.mark.parametrize("way", [counting.pairs_by_lists, counting.pairs_by_bitmaps])
def test_pairs_of_a_chunk(monkeypatch, way):
    draw = random.Random(8)
    baskets = [sorted(draw.sample(range(0, 300, 7), draw.randint(1, 9))) for _ in range(150)]
    expected = Counter(pair for own in baskets for pair in combinations(own, 2))
    for words, pairs in ((10**6, 10**6), (1, 50)):
        monkeypatch.setattr(counting, "WORDS", words)
        monkeypatch.setattr(counting, "PAIRS", pairs)
        chunk = counting.Chunk(np.array([len(b) for b in baskets]), np.concatenate([np.array(b) for b in baskets]))
        got = {}
        for x, y, n in way(chunk):
            got |= {(int(chunk.items[i]), int(chunk.items[j])): int(c) for i, j, c in zip(x, y, n)}
        assert got == expected


def test_pairs_are_reported_where_they_reach_their_share(spark, monkeypatch, settings):
    """A pair in 40 of 200 baskets is reported by chunks that hold a fifth of them or more."""
    small(monkeypatch, settings)
    monkeypatch.setattr(counting, "CHUNK", 40)
    baskets = [(i, [1, 2] if i % 5 == 0 else [3, 4 + i]) for i in range(200)]
    held = spark.createDataFrame([(b, at) for b, own in baskets for at in own], "basket long, at long").coalesce(1)
    found = counting.promising_pairs(counting.basket_blocks(held, 2), 40, 200).collect()
    reported = [row for row in found if row.x is not None]
    assert sum(row.x is None for row in found) > 3
    assert all((row.x, row.y) == (1, 2) and row.n > row.missed for row in reported if row.missed)
    rare = counting.promising_pairs(counting.basket_blocks(held, 2), 160, 200).where("x is not null").collect()
    assert all(row.n > row.missed for row in rare) and len(rare) < len(reported) + 160


def test_no_candidate_with_a_rare_part(spark):
    frequent = [[1, 2], [1, 3], [1, 4], [2, 3], [3, 4]]
    level = spark.createDataFrame([(s, [str(i) for i in s]) for s in frequent], "positions array<long>, items array<string>")
    got = {tuple(r["positions"]): r["items"] for r in candidates(level, 3).collect()}
    assert got == {(1, 2, 3): ["1", "2", "3"], (1, 3, 4): ["1", "3", "4"]}  # not (1, 2, 4): (2, 4) is rare
    triples = [list(s) for s in combinations(range(5), 3) if s not in {(1, 2, 4), (0, 3, 4)}]
    level = spark.createDataFrame([(s, [str(i) for i in s]) for s in triples], "positions array<long>, items array<string>")
    whole = [s for s in combinations(range(5), 4) if all(list(p) in triples for p in combinations(s, 3))]
    assert sorted(tuple(r["positions"]) for r in candidates(level, 4).collect()) == whole


def test_nothing_below_a_prefix_that_no_row_holds():
    sets = np.array([[0, 1, k] for k in range(2, 50)] + [[50, 51, k] for k in range(52, 60)] + [[60, 61, 62]])
    chunk = counting.Chunk(np.array([3, 2]), np.array([60, 61, 62, 50, 52]))
    wide = counting.Chunk(np.array([3, 2, 63]), np.concatenate([[60, 61, 62], [50, 52], np.arange(63)]))
    for own in (chunk, wide):
        expected = [sum(set(row) <= set(b) for b in np.split(own.items[own.local], np.cumsum(own.sizes)[:-1])) for row in sets]
        assert counting.count_chunk(own, sets).tolist() == expected
    counts = np.zeros(len(sets), np.int64)
    bits = np.zeros((63, 1), np.uint64)
    bits[[50, 60, 61, 62], 0] = [2, 1, 1, 1]
    # the root, both empty prefixes of one item, (50), (50 51), (60), (60 61)
    assert counting.walk(bits, sets, counts) <= 7 and counts.tolist() == [0] * 56 + [1]


def test_sets_and_items_stay_in_tables():
    for module in (itemsets, counting):
        source = inspect.getsource(module)
        assert "toLocalIterator" not in source and "collect()" not in source and "toPandas" not in source


def test_baskets_of_any_size(spark):
    pairs = spark.range(25_000).selectExpr("'hot' as basket", "id % 20000 as item").unionByName(
        spark.createDataFrame([("a", 3), ("a", 1), ("a", 1), ("b", None), (None, 1)], "basket string, item long"))
    parts = basket_fragments(pairs, "basket", "item", 1000).collect()
    hot = [r["items"] for r in parts if r["basket"] == "hot"]
    assert len(hot) == 20 and max(map(len, hot)) < 1200 and sorted(sum(hot, [])) == list(range(20_000))
    assert all(own == sorted(own) for own in hot)
    assert [(r["fragment"], r["items"]) for r in parts if r["basket"] == "a"] == [(0, [1, 3])]
    whole = {r["basket"]: r["items"] for r in to_baskets(pairs, "basket", "item").collect()}
    assert whole == {"hot": list(range(20_000)), "a": [1, 3]}


def test_rules_of_a_large_set_end(spark):
    """Thirty items: only antecedents that lack one item reach the confidence, none is made of those without two."""
    sets = spark.createDataFrame([(list(range(30)), 10)], "items array<int>, support long")
    asked_sizes = []

    def supports(asked):
        asked_sizes.append({r[0] for r in asked.select(F.size("items")).distinct().collect()})
        return asked.select("items", (10 + 30 - F.size("items")).cast("long").alias("support"))

    rules = association_rules(sets, 0.9, supports).collect()
    assert len(rules) == 30 and {len(r["antecedent"]) for r in rules} == {29}
    assert all(r["confidence"] == 10 / 11 for r in rules) and asked_sizes == [{29}, {28}]


@pytest.mark.parametrize("confidence", [0.0, 0.4, 0.8])
def test_rules_equal_all_splits(spark, confidence):
    draw = random.Random(3)
    baskets = [set(draw.sample(range(7), draw.randint(1, 6))) for _ in range(40)]
    found = as_dict(frequent_itemsets(pairs_of(spark, baskets), support=0.1))
    expected = {
        (a, tuple(i for i in items if i not in a)): n / found[a]
        for items, n in found.items() for size in range(1, len(items)) for a in combinations(items, size)
        if n / found[a] >= confidence
    }
    sets = spark.createDataFrame([(list(s), n) for s, n in found.items()], "items array<int>, support long")
    got = association_rules(sets, confidence).collect()
    assert {(tuple(r["antecedent"]), tuple(r["consequent"])): r["confidence"] for r in got} == expected and len(got) == len(expected)


def test_items_are_numbered_without_a_shuffle(spark):
    from pyspark.sql import types as T

    from grainfold.session import local_table

    fields = [T.StructField("at", T.IntegerType()), T.StructField("item", T.IntegerType())]
    numbered = local_table(spark, [(0, 5)], T.StructType(fields))
    plan = pairs_of(spark, BASKETS).join(numbered, "item")._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and numbered.collect() == [(0, 5)]


def test_given_sets_are_counted(spark, monkeypatch, settings):
    sets = [[1], [1, 2], [2, 3], [1, 2, 3], [4, 5], [9]]
    asked = spark.createDataFrame([(s,) for s in sets], "items array<int>")
    expected = {
        tuple(s): n for s in sets if (n := sum(set(s) <= b for b in BASKETS))
    }
    assert as_dict(itemsets.count_sets(asked, pairs_of(spark, BASKETS))) == expected
    small(monkeypatch, settings)
    assert as_dict(itemsets.count_sets(asked, pairs_of(spark, BASKETS))) == expected
    assert as_dict(itemsets.count_sets(asked.limit(0), pairs_of(spark, BASKETS))) == {}


def test_rules_by_hand(spark):
    sets = frequent_itemsets(pairs_of(spark, BASKETS))
    rules = {
        (tuple(r["antecedent"]), tuple(r["consequent"])): r["confidence"]
        for r in association_rules(sets).collect()
    }
    assert rules == {
        ((1,), (2,)): 2 / 3, ((2,), (1,)): 2 / 3, ((1,), (3,)): 2 / 3, ((3,), (1,)): 1.0
    }


def test_proper_subsets(spark):
    rows = spark.createDataFrame([([1],), ([1, 2, 3],)], "items array<int>")
    got = [r[0] for r in rows.select(F.explode(proper_subsets(F.col("items")))).collect()]
    assert sorted(got) == [[1], [1, 2], [1, 3], [2], [2, 3], [3]]


def test_itemset_and_rule_jobs(spark, text_file, tmp_path):
    names = "abcdefg"
    geo = text_file(
        "expression.csv", "patientid,geneid,expression_value",
        *[f"{names[b]},{i},1250000" for b, items in enumerate(BASKETS) for i in items],
        "a,9,1249999", "x,1,2000000",
    )
    patients = text_file("patients.csv", *[f"{n},1,m,2,flu lymphoma,x" for n in names], "x,1,m,2,flu,x")
    sets, rules = str(tmp_path / "sets"), str(tmp_path / "rules")
    jobs.gene_itemsets(spark, geo, patients, output=sets)
    assert lines_in(sets) == ["3\t1", "3\t2", "2\t1\t2", "2\t1\t3", "2\t3"]
    jobs.gene_rules(spark, sets, output=rules, confidence=0.9)
    assert lines_in(rules) == ["3 \t1 \t1.0"]
    # a file with one set only: its antecedents are not in it and must be counted
    one_set, recounted = text_file("one.tsv", "2\t1\t3"), str(tmp_path / "recounted")
    jobs.gene_rules(
        spark, one_set, output=recounted, expression_path=geo, patient_path=patients
    )
    assert lines_in(recounted) == ["3 \t1 \t1.0", f"1 \t3 \t{2 / 3}"]


def test_rules_with_two_items_on_a_side(spark, text_file):
    lines = ["10\t1", "8\t2", "6\t3", "5\t4", "6\t1\t2", "4\t1\t3", "4\t2\t3", "3\t1\t2\t3", "4\t1\t4"]
    sets = readers.read_itemsets(spark, text_file("sets.tsv", *lines), strict=True)
    rules = writers.rule_lines(genes.gene_rules(sets, 0.6)).collect()
    assert sorted(r["value"] for r in rules) == sorted([
        "1 \t2 \t0.6", "2 \t1 \t0.75", "3 \t1 \t0.6666666666666666", "3 \t2 \t0.6666666666666666",
        "1 3 \t2 \t0.75", "2 3 \t1 \t0.75", "4 \t1 \t0.8",
    ])
    low = writers.rule_lines(genes.gene_rules(sets, 0.3)).collect()
    assert {"1 \t2 3 \t0.3", "2 \t1 3 \t0.375", "3 \t1 2 \t0.5", "1 2 \t3 \t0.5"} <= {r["value"] for r in low}


def test_subsets_have_a_bound(spark):
    sets = spark.createDataFrame([(list(range(40)),)], "items array<int>")
    with pytest.raises(Exception, match="40 items are over 20"):
        sets.select(itemsets.proper_subsets(sets["items"])).collect()
