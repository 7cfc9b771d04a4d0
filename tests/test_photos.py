import pytest
from conftest import lines_in
from pyspark.sql import functions as F

from grainfold.plans import jobs, photos
from grainfold.sources import readers

SYDNEY, PARIS = "Sydney, NSW, Australia", "Paris, Ile-de-France, France"


@pytest.fixture
def files(text_file):
    photo_path = text_file(
        "photos.tsv",
        "p1\tu1\tsydney harbour 2008 bridge\t2008-03-01\tpl1\t16",
        "p2\tu1\tHarbour syd2008\t2008-04-02\tpl2\t16",
        "p3\tu2\topera harbour\t2010-01-01\tpl1\t16",
        "p4\tu2\tparis\t2009-01-01\tpl9\t16",
        "p5\tu3\teiffel tower tower\t2009-05-05\tpl3\t15",
        "p6\tu3\tx\t2009-05-05\t\t",
        "p7\tu4\tbeach\t2011-01-01\tpl4\t16",
    )
    place_path = text_file(
        "places.tsv",
        f"pl1\tw\t0\t0\t{SYDNEY}\t7\t/u",
        f"pl2\tw\t0\t0\tGlebe, {SYDNEY}\t22\t/u",
        f"pl3\tw\t0\t0\t{PARIS}\t7\t/u",
        "pl4\tw\t0\t0\tAustralia\t12\t/u",
        "pl5\tw\t0\t0\tNo comma\t22\t/u",
        "pl6\tw\t0\t0\tBroken\tseven\t/u",
    )
    return photo_path, place_path


def test_counts_and_top_localities(spark, files, tmp_path):
    counts, top = str(tmp_path / "counts"), str(tmp_path / "top")
    jobs.photos_per_locality(spark, *files, output=counts)
    assert sorted(lines_in(counts)) == [f"{PARIS}\t1", f"{SYDNEY}\t3"]
    jobs.top_localities(spark, counts, output=top)
    assert lines_in(top) == [f"{SYDNEY}\t3", f"{PARIS}\t1"]


def test_locality_tags_and_stored_counts(spark, files, text_file, tmp_path):
    tags, out = str(tmp_path / "tags"), str(tmp_path / "out")
    jobs.locality_tags(spark, *files, output=tags)
    rows = {tuple(r) for r in readers.read_tag_counts(spark, tags).collect()}
    assert rows == {
        (SYDNEY, "harbour", 2), (SYDNEY, "Harbour", 1), (SYDNEY, "bridge", 1),
        (SYDNEY, "opera", 1), (PARIS, "tower", 2), (PARIS, "eiffel", 1),
    }
    top = text_file("top.tsv", f"{SYDNEY}\t3", f"{PARIS}\t1", "Nowhere\t1")
    jobs.top_tags_from_counts(spark, top, tags, output=out)
    assert lines_in(out) == [
        "Nowhere\t1",
        f"{PARIS}\t1\ttower:2\teiffel:1",
        f"{SYDNEY}\t3\tharbour:2\tHarbour:1\tbridge:1\topera:1",
    ]


def test_top_tags_from_photos(spark, files, text_file, tmp_path):
    top = text_file("top.tsv", f"{SYDNEY}\t3", "Nowhere\t1")
    out = str(tmp_path / "out")
    jobs.top_tags_per_locality(spark, *files, top, output=out, n_tags=2)
    assert lines_in(out) == ["Nowhere\t1", f"{SYDNEY}\t3\tharbour:2\tHarbour:1"]


def test_same_counts_when_nothing_is_broadcast(spark, files, settings):
    settings(**{"spark__sql__autoBroadcastJoinThreshold": "-1"})
    read = readers.read_photos(spark, files[0]), readers.read_places(spark, files[1])
    counts = {tuple(r) for r in photos.photos_per_locality(*read).collect()}
    assert counts == {(SYDNEY, 3), (PARIS, 1)}
    assert photos.locality_tags(*read).count() == 6


def test_duplicate_place_does_not_multiply(spark, text_file, files):
    places = text_file(
        "twice.tsv", f"pl1\tw\t0\t0\t{SYDNEY}\t7\t/u", f"pl1\tw\t0\t0\t{SYDNEY}\t7\t/u"
    )
    read = readers.read_photos(spark, files[0]), readers.read_places(spark, places)
    assert [tuple(r) for r in photos.photos_per_locality(*read).collect()] == [(SYDNEY, 2)]


def test_stored_counts_with_colons_and_parts_add_up(spark, text_file):
    path = text_file("tags.tsv", "A\tx:y:2,z:1,", "A\tz:4,", "B\tbroken,ok:1,")
    counts = photos.merge_tag_counts(readers.read_tag_counts(spark, path))
    assert {tuple(r) for r in counts.collect()} == {("A", "x:y", 2), ("A", "z", 5), ("B", "ok", 1)}


def test_many_tags_take_several_lines(spark, tmp_path):
    from grainfold.sources import writers

    rows = [("A", f"t{i}", i) for i in range(100)] + [("B", "x", 1)]
    counts = spark.createDataFrame(rows, "locality string, tag string, n bigint")
    out = str(tmp_path / "tags")
    writers.write_lines(writers.packed_tag_lines(counts, tags_per_line=10), out)
    lines = lines_in(out)
    assert sum(line.startswith("B") for line in lines) == 1 and 5 < len(lines) <= 11
    assert sorted(map(tuple, readers.read_tag_counts(spark, out).collect())) == sorted(rows)


def test_a_place_with_most_photos_is_split(spark, settings):
    """One place owns most photos: the sort-merge join reads it in several tasks."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    n = 40_000
    taken = spark.range(n, numPartitions=8).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).cast("string").alias("place_id"),
        F.concat(F.lit("tag"), F.col("id").cast("string")).alias("tags"),
        F.lit("2001-01-01").alias("date_taken"),
    )
    places = spark.range(n).select(
        F.col("id").cast("string").alias("place_id"),
        F.concat(F.lit("Town "), (F.col("id") % 5).cast("string")).alias("place_name"),
        F.lit(7).alias("place_type_id"),
    )
    tags = photos.locality_tags(taken, places)
    assert tags.agg(F.sum("n")).first()[0] == n
    plan = tags._jdf.queryExecution().executedPlan()
    tags.collect()
    assert "skew=true" in plan.toString()


def test_rank_is_limited_before_the_shuffle(spark, settings):
    from grainfold.operators.ranking import top_n_per_group

    rows = spark.range(100).select((F.col("id") % 3).alias("g"), "id", F.lit(1).alias("n"))
    plan = top_n_per_group(rows, "g", "n", "id", 10)._jdf.queryExecution().toString()
    final, partial = plan.index("Final"), plan.index("Partial")
    assert final < plan.index("Exchange", final) < partial
