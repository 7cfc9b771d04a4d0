import inspect
import math
import random

import numpy as np
import pytest
from conftest import lines_in
from pyspark.sql import functions as F

from grainfold.operators import clustering
from grainfold.operators.clustering import (
    COMPILED_CENTROIDS,
    assign_nearest,
    assign_within_bounds,
    centres,
    kmeans,
    random_centroids,
    trimmed_kmeans,
)
from grainfold.operators import trim
from grainfold.operators.trim import _bounded, _find_cuts, _in_region, trim_group_tail
from grainfold.plans import jobs

XYZ = ["x", "y", "z"]


def measurement(sample, fsc, ssc, sca1=0.0, cd11b=0.0, ly6c=0.0):
    return f"{sample},{fsc},{ssc},0,0,0,{sca1},{cd11b},0,0,0,{ly6c},more"


@pytest.fixture
def line(spark):
    points = [(float(x), 0.0, 0.0) for x in (0, 1, 2, 10, 11, 12)]
    return spark.createDataFrame(points, "x double, y double, z double")


def test_measurements_per_researcher(spark, text_file, tmp_path):
    measurements = text_file(
        "m.csv", "sample,FSC-A,SSC-A",
        measurement("s1", 0, 150000), measurement("s1", 150001, 5), measurement("s1", 100, 200),
        measurement("s2", -1, 10), measurement("s3", 5, 5), measurement("s1", "bad", 5),
    )
    experiments = text_file(
        "e.csv", "sample,date,experiment,day,subject,kind,instrument,researchers",
        "s1,d,e,1,s,k,i,Ann; Bob", "s2,d,e,1,s,k,i,Cat", "s4,d,e,1,s,k,i,Ann", "s1,d,e,1,s,k,i,",
    )
    out = str(tmp_path / "out")
    jobs.measurements_per_researcher(spark, measurements, experiments, output=out)
    assert lines_in(out) == ["Ann\t2", "Bob\t2", "Cat\t0"]


def test_repeated_samples_and_researchers_count_again(spark, text_file, tmp_path):
    measurements = text_file("m.csv", measurement("s1", 1, 1), measurement("s1", 2, 2))
    experiments = text_file("e.csv", "s1,d,e,1,s,k,i,Ann;Ann;", "s1,d,e,1,s,k,i,Ann")
    out = str(tmp_path / "out")
    jobs.measurements_per_researcher(spark, measurements, experiments, output=out)
    assert lines_in(out) == ["Ann\t6"]


def test_kmeans_by_hand(spark, line):
    model = [(1, (0, 0, 0)), (2, (5, 0, 0)), (3, (100, 0, 0))]
    expected = [(1, 3, 1.0, 0.0, 0.0), (2, 3, 11.0, 0.0, 0.0)]
    for rounds in (1, 2, 5):
        result = kmeans(line, XYZ, model, rounds).orderBy("cluster_id")
        assert [tuple(r) for r in result.collect()] == expected
    result = kmeans(line, XYZ, model, 0).orderBy("cluster_id")
    assert [tuple(r) for r in result.collect()] == [
        (1, 0, 0.0, 0.0, 0.0), (2, 0, 5.0, 0.0, 0.0), (3, 0, 100.0, 0.0, 0.0)
    ]


def test_lowest_id_wins_a_tie(spark):
    points = spark.createDataFrame([(2.5, 0.0, 0.0)], "x double, y double, z double")
    model = [(2, (5, 0, 0)), (1, (0, 0, 0))]
    far = [(i, (99.0, 99.0, 99.0)) for i in range(3, COMPILED_CENTROIDS + 3)]
    for centroids in (model, model + far):
        assert assign_nearest(points, XYZ, centroids).first()["cluster_id"] == 1


def test_compiled_and_batched_distances_agree(spark):
    draw = random.Random(1)
    points = spark.createDataFrame(
        [tuple(draw.random() for _ in range(3)) for _ in range(500)],
        "x double, y double, z double",
    )
    model = random_centroids(COMPILED_CENTROIDS, low=0, high=1, seed=2)
    far = model + [(99, (50.0, 50.0, 50.0))]
    few = assign_nearest(points, XYZ, model).collect()
    assert sorted(few) == sorted(assign_nearest(points, XYZ, far).collect())
    for row in few:
        nearest = min((math.dist(row[:3], c), i) for i, c in model)
        assert (row["cluster_id"], row["dist"]) == (nearest[1], pytest.approx(nearest[0]))


@pytest.mark.parametrize("k", [3, 30, 300])
def test_bounds_change_no_result(spark, monkeypatch, k):
    draw = random.Random(k)
    rows = [(float(draw.randint(0, 40)), draw.random() * 40, float(draw.randint(0, 9))) for _ in range(3000)]
    points = spark.createDataFrame(rows + [(math.nan, 0.0, 0.0)], "x double, y double, z double")
    model, expected = random_centroids(k, low=0, high=40, seed=1), None
    for bound in (10**6, 0):
        if bound:
            plain = model
            for _ in range(5):
                found = sorted(centres(clustering._nearest_batched(points.where("not isnan(x)"), XYZ, plain), XYZ).collect())
                plain = [(r["cluster_id"], [r[f] for f in XYZ]) for r in found]
            expected = found
        else:
            monkeypatch.setattr(clustering, "COMPILED_CENTROIDS", 0)
            got = sorted(kmeans(points, XYZ, model, 5).collect())
            assert [r["cluster_id"] for r in got] == [r["cluster_id"] for r in expected]
            assert [r["n"] for r in got] == [r["n"] for r in expected]
            for a, b in zip(got, expected):
                assert tuple(a)[2:] == pytest.approx(tuple(b)[2:])


def test_bounds_spare_distances(spark):
    draw = random.Random(4)
    spots = [(draw.random() * 100, draw.random() * 100, draw.random() * 100) for _ in range(100)]
    rows = [tuple(c + draw.random() for c in spots[i % 100]) for i in range(5000)]
    points = spark.createDataFrame(rows, "x double, y double, z double")
    model = [(i, spot) for i, spot in enumerate(spots)]
    first = assign_within_bounds(points, XYZ, model).persist()
    moved = [(r["cluster_id"], [r[f] for f in XYZ]) for r in sorted(centres(first, XYZ).collect())]
    second = assign_within_bounds(first, XYZ, moved, model)
    taken = [df.agg({"taken": "sum"}).first()[0] for df in (first, second)]
    assert taken[0] == 5000 * 100 and taken[1] < 5000 * 10
    assert sorted(second.select(*XYZ, "cluster_id").collect()) == sorted(
        assign_nearest(points, XYZ, moved).select(*XYZ, "cluster_id").collect())


def test_ties_and_odd_values_within_bounds():
    centre = np.array([[0.0], [2.0], [2.0], [1e308]])
    values = [np.array([1.0, 2.0, 5.0, 1e308, -1e308])]
    at, lower, taken = clustering.nearest_within_bounds(values, np.zeros(5, int), np.zeros(5), None, centre)
    assert at.tolist() == [0, 1, 1, 3, 0] and (taken == 4).all()
    again, _, _ = clustering.nearest_within_bounds(values, at, lower, centre, centre)
    assert again.tolist() == at.tolist()


ODD = [float("nan"), float("inf"), float("-inf"), None]


@pytest.mark.parametrize("odd", [*ODD, 1e308])
def test_odd_features_mean_the_same_for_every_k(spark, odd):
    points = spark.createDataFrame([(0.1, 0.2, 0.3), (odd, 0.2, 0.3), (0.1, 0.2, odd)], "x double, y double, z double")
    model = random_centroids(COMPILED_CENTROIDS, low=0, high=1, seed=2)
    few = assign_nearest(points, XYZ, model).collect()
    many = assign_nearest(points, XYZ, model + [(99, (50.0, 50.0, 50.0))]).collect()
    assert sorted(few) == sorted(many)
    assert len(few) == (3 if odd == 1e308 else 1)
    assert all(math.isfinite(row["dist"]) for row in few)


@pytest.mark.parametrize("odd", [*ODD, 1e308])
def test_trim_ends_on_odd_values(spark, odd):
    rows = [(1, float(i), 0.0) for i in range(3000)] + [(1, odd, 0.0)]
    table = spark.createDataFrame(rows, "g int, v double, t double")
    kept = trim_group_tail(table, "g", "v", ["t"], keep=0.5, buckets=16, rank_rows=10).collect()
    n = 3001 if odd == 1e308 else 3000
    assert sum(r["copies"] for r in kept) == n // 2 + 1
    assert max(r["v"] for r in kept) == n // 2


@pytest.mark.parametrize("size, kept", [(1, 1), (9, 9), (10, 10), (11, 10), (20, 19), (25, 23)])
def test_trim_sizes(spark, size, kept):
    rows = spark.createDataFrame(
        [(1, float(i), 0.0) for i in range(size)], "g int, d double, x double"
    )
    left = trim_group_tail(rows, "g", "d", ["x"]).collect()
    assert sorted(r["d"] for r in left) == [float(i) for i in range(kept)]
    assert sum(r["copies"] for r in left) == kept


def brute_trim(rows, keep):
    left = []
    for group in {g for g, *_ in rows}:
        members = sorted(r for r in rows if r[0] == group)
        left += members[: min(len(members), int(keep * len(members)) + 1)]
    return sorted(left)


@pytest.mark.parametrize("buckets, rank_rows", [(2, 1), (3, 4), (16, 10), (4096, 100_000)])
@pytest.mark.parametrize("kind", ["spread", "lattice", "one value", "hot copies", "wide"])
def test_trim_equals_sorting(spark, kind, buckets, rank_rows):
    draw = random.Random(kind)
    make = {
        "spread": lambda: (draw.random(), draw.random(), draw.random()),
        "lattice": lambda: tuple(float(draw.randrange(3)) for _ in range(3)),
        "one value": lambda: (1.0, draw.random() - 0.5, 2.0),
        "hot copies": lambda: (7.0, 7.0, 7.0) if draw.random() < 0.4 else (
            float(draw.randrange(15)), 0.0, float(draw.randrange(4))),
        "wide": lambda: (10.0 ** draw.randrange(-3, 4), -(10.0 ** draw.randrange(3)), 0.0),
    }[kind]
    sizes = {1: 60, 2: 45, 3: 1}
    rows = [(g, *make()) for g, n in sizes.items() for _ in range(n)]
    keep = 0.6
    df = spark.createDataFrame(rows, "g int, d double, x double, y double").repartition(3)
    left = trim_group_tail(df, "g", "d", ["x", "y"], keep, buckets, rank_rows).collect()
    again = sorted(tuple(r)[:4] for r in left for _ in range(r["copies"]))
    assert again == brute_trim(rows, keep)


def test_trimmed_kmeans_equals_brute_force(spark):
    draw = random.Random(3)
    points = [tuple(3 * draw.random() for _ in range(3)) for _ in range(300)]
    model = [(i, [0.5 * i, 0.5 * i, 0.4 * i]) for i in (1, 2, 3, 4, 5)]

    def nearest(point, centroids):
        return min((math.dist(point, c), i) for i, c in centroids)

    placed = [(nearest(p, model), p) for p in points]
    kept = brute_trim([(i, d, *p) for (d, i), p in placed], 0.9)
    kept = [row[2:] for row in kept]
    centroids = model
    for _ in range(3):
        groups = {}
        for p in kept:
            groups.setdefault(nearest(p, centroids)[1], []).append(p)
        centroids = [(i, [sum(c) / len(g) for c in zip(*g)]) for i, g in sorted(groups.items())]
    df = spark.createDataFrame(points, "x double, y double, z double")
    result = trimmed_kmeans(df, XYZ, model, 3).orderBy("cluster_id").collect()
    assert [r["cluster_id"] for r in result] == [i for i, _ in centroids]
    assert [r["n"] for r in result] == [len(groups[i]) for i, _ in centroids]
    for row, (_, centre) in zip(result, centroids):
        assert [row[f] for f in XYZ] == pytest.approx(centre)


def test_cluster_jobs(spark, text_file, tmp_path):
    cells = text_file(
        "m.csv", "sample,FSC-A,SSC-A",
        *[measurement("s", 1, 150000, sca1=0, cd11b=0, ly6c=x) for x in (0, 1, 2, 10, 11, 12)],
        measurement("s", 0, 5, ly6c=500), measurement("s", 5, 150001, ly6c=500),
    )
    model = text_file("model.tsv", "1\t0\t0.0\t0.0\t0.0", "2\t0\t5.0\t0.0\t0.0")
    trimmed, free = str(tmp_path / "trimmed"), str(tmp_path / "free")
    jobs.cell_clusters_trimmed(spark, cells, model, output=trimmed, iterations=2)
    assert lines_in(trimmed) == ["1\t3\t1.0\t0.0\t0.0", "2\t3\t11.0\t0.0\t0.0"]
    jobs.cell_clusters(spark, cells, 3, output=free, seed=1)
    assert sum(int(row.split("\t")[1]) for row in lines_in(free)) == 6


def test_only_the_last_round_is_left_to_run(spark, line):
    """The plan of the result scans the written points and holds no earlier round."""
    plan = kmeans(line, XYZ, [(1, (0, 0, 0)), (2, (5, 0, 0))], 6)._jdf.queryExecution().toString()
    physical = plan[plan.index("Physical Plan"):]
    assert physical.count("Exchange") == 1 and "FileScan parquet" in physical


def test_trim_never_shuffles_the_points(spark):
    """Only folded rows are exchanged: all sides joined to the points are of a known small size."""
    rows = spark.range(1000).selectExpr("int(id % 3) g", "double(id) d", "0.0D x")
    left = trim_group_tail(rows, "g", "d", ["x"], buckets=4, rank_rows=10)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
    for exchange in plan.split("Exchange hashpartitioning")[1:]:
        assert "HashAggregate" in exchange.splitlines()[1]


def test_trim_goes_on_where_values_are_too_close_together(spark):
    """Neighbouring doubles, and huge ones with equal logarithms, leave no region to one task."""
    for base in (1.0, 1e300):
        near = [base]
        for _ in range(5):
            near.append(math.nextafter(near[-1], math.inf))
        rows = [(1, near[i % 6], float(i)) for i in range(600)] + [(1, -base, 0.0), (1, 2 * base, 0.0)]
        table = spark.createDataFrame(rows, "g int, v double, t double")
        cuts = _find_cuts(table, "g", ["v", "t"], 0.5, 16, 20)
        bounded = table.join(cuts, "g")
        assert bounded.where(_in_region(_bounded(bounded, ["v", "t"]))).count() <= 20
        kept = trim_group_tail(table, "g", "v", ["t"], 0.5, 16, 20).collect()
        assert sorted((r["v"], r["t"]) for r in kept for _ in range(r["copies"])) == sorted(r[1:] for r in rows)[:302]


def test_trim_of_many_groups(spark):
    """A hundred thousand groups, and one that is searched; the driver holds none of them."""
    many = spark.range(300_000).selectExpr("id % 100000 as g", "cast(id as double) as v", "0D as t")
    hot = spark.range(5000).selectExpr("-1L as g", "cast(id * 7 % 5000 as double) as v", "0D as t")
    left = trim_group_tail(many.unionByName(hot), "g", "v", ["t"], 0.5, 64, 1000)
    sizes = left.groupBy("g").agg(F.sum("copies").alias("n"), F.max("v").alias("v"))
    assert sizes.where("g >= 0").agg(F.count("*"), F.min("n"), F.max("n")).first()[:] == (100_000, 2, 2)
    assert sizes.where("g < 0").select("n", "v").first()[:] == (2501, 2500.0)
    assert ".collect(" not in inspect.getsource(trim)
