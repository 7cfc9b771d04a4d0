import pytest
from conftest import ROOT, lines_in
from pyspark.sql import functions as F

from grainfold.functions.text import (
    after_first_comma,
    field_count,
    occurs_in,
    split_fields,
    trim_blanks,
    without_year,
)
from grainfold.session import shared_folder, written
from grainfold import __main__ as commands
from grainfold.sources import readers, writers


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column).first()[0]


@pytest.mark.parametrize(
    "text, fields",
    [("a;b", ["a", "b"]), ("a;b;;", ["a", "b"]), (";a", ["", "a"]), ("", [""]), (";;", [])],
)
def test_split_drops_empty_fields_at_the_end(spark, text, fields):
    assert one(spark, split_fields(F.col("t"), ";"), t=text) == fields
    assert one(spark, field_count(F.col("t"), ";"), t=text) == len(fields)


def test_split_at_a_special_character(spark):
    assert one(spark, split_fields(F.col("t"), "|"), t="War|Drama") == ["War", "Drama"]


def test_text_expressions(spark):
    assert one(spark, trim_blanks(F.col("t")), t="\t a b\x01 ") == "a b"
    assert one(spark, after_first_comma(F.col("t")), t="Glebe,Sydney, NSW ") == "Sydney, NSW"
    assert one(spark, after_first_comma(F.col("t")), t="Glebe") is None
    assert one(spark, without_year(F.col("t"), F.col("d")), t="a2008 2008", d="2008-01-02") == "a "
    assert one(spark, without_year(F.col("t"), F.col("d")), t="a b", d="") == "a b"
    assert one(spark, occurs_in(F.col("t"), F.col("n")), t="SYD", n="Sydney") is True
    assert one(spark, occurs_in(F.col("t"), F.col("n")), t="", n="Sydney") is True


def test_bad_numbers_are_dropped_or_raise(spark, text_file):
    path = text_file("c.tsv", "1\t5\t0.5\t1\t2", "x\t5\t0.5\t1\t2", "2\t5\t0.5\tnone\t2")
    assert [r["cluster_id"] for r in readers.read_clusters(spark, path).collect()] == [1]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.read_clusters(spark, path, strict=True).collect()


def test_only_needed_columns_are_parsed(spark, text_file):
    path = text_file("r.csv", "m1,u,4.0,0")
    plan = readers.read_ratings(spark, path).select("rating")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<rating:string>" in plan


def test_field_counts_and_missing_texts(spark, text_file):
    path = text_file(
        "p.tsv", "p1\tu\t\t2001-01-01\tpl1", "p2\tu\tt\t2001-01-01\t\t16", "p3\tu\tt\t2001-01-01",
        'p4\tu\ta "quote\t2001-01-01\tpl4\t16\textra', "p5\tu\tt\t2001-01-01\t\t",
    )
    rows = [tuple(r) for r in readers.read_photos(spark, path).collect()]
    assert rows == [
        ("p1", "u", "", "2001-01-01", "pl1", ""),
        ("p2", "u", "t", "2001-01-01", "", "16"),
        ("p4", "u", 'a "quote', "2001-01-01", "pl4", "16"),
    ]


def test_ratings_with_header(spark, text_file):
    path = text_file("r.csv", "movieId,userId,rating,timestamp", "m1,u,4.0,0")
    assert readers.read_ratings(spark, path, strict=True, header="movieId").count() == 1


def test_itemset_lines_of_any_width(spark, text_file):
    path = text_file("s.tsv", "3\t1", "2\t1\t2\t3", "bad\t1", "2\tx")
    rows = [(r["support"], r["items"]) for r in readers.read_itemsets(spark, path).collect()]
    assert rows == [(3, [1]), (2, [1, 2, 3])]


def test_several_files_under_one_reader(spark, text_file):
    paths = [text_file("a.tsv", "A\t1"), text_file("b.tsv", "B\t2")]
    assert readers.read_key_counts(spark, paths).count() == 2


def test_written_tables_go_to_the_shared_folder(spark):
    table = written(spark.range(3), "numbers")
    assert all(shared_folder(spark) in path for path in table.inputFiles())
    assert table.count() == 3


class FakeSession:
    """A session on a given master, with or without a shared folder."""

    def __init__(self, master, folder=None):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: folder)})


def test_shared_folder_comes_from_the_session():
    assert shared_folder(FakeSession("spark://host:7077", "hdfs://x/shared/")) == "hdfs://x/shared"
    own = shared_folder(FakeSession("local[4]"))
    assert own and own == shared_folder(FakeSession("local[*]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(FakeSession("yarn"))


def test_written_tables_can_be_dropped(tmp_path):
    """In a process of its own, since all tables of the application go."""
    import subprocess
    import sys

    script = f"""
import os
from grainfold.session import drop_written, local_session, written
spark = local_session(1, **{{"spark.checkpoint.dir": "{tmp_path}"}})
assert written(spark.range(3).where("id > 5"), "none").count() == 0
assert os.listdir("{tmp_path}/grainfold")
drop_written(spark)
assert not os.listdir("{tmp_path}/grainfold")
"""
    subprocess.run([sys.executable, "-c", script], check=True, timeout=300, cwd=ROOT)


def test_command_line_knows_all_jobs(capsys):
    from grainfold.__main__ import JOBS, parser

    assert len(JOBS) == 12
    options = parser().parse_args(["gene-itemsets", "geo", "patients", "--support", "0.2"])
    assert (options.support, options.max_size, options.output) == (0.2, 10, None)
    options = parser().parse_args(["cell-clusters", "cells", "5", "--seed", "3", "--output", "o"])
    assert (options.k, options.seed, options.iterations, options.output) == (5, 3, 10, "o")


def test_one_file_is_joined_in_order(spark, tmp_path):
    """Sorted in parallel, one file, the same bytes as one task would write."""
    rows = spark.range(5000).selectExpr("cast(hash(id) as string) as value").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for write, end in ((writers.write_lines, "txt"), (writers.write_csv, "csv")):
            path = tmp_path / end
            write(rows.sort("value"), str(path), single_file=True)
            (part,) = path.glob("part-*")
            expected = sorted(r[0] for r in rows.collect())
            assert part.read_bytes() == ("\n".join(expected) + "\n").encode()
            assert spark.read.text(str(path)).count() == 5000
        writers.write_lines(rows.limit(0), str(tmp_path / "none"), single_file=True)
        assert spark.read.text(str(tmp_path / "none")).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_job_from_its_arguments(spark, text_file, tmp_path, capsys):
    counts = text_file("counts.tsv", *[f"place {i:03}\t{i}" for i in range(150)])
    commands.run(spark, ["top-localities", counts, "--n", "3", "--output", str(tmp_path / "top")])
    assert lines_in(tmp_path / "top") == ["place 149\t149", "place 148\t148", "place 147\t147"]
    commands.run(spark, ["top-localities", counts, "--n", "120"])
    shown = [line for line in capsys.readouterr().out.splitlines() if line.startswith("|place")]
    assert len(shown) == 100 and "149" in shown[0]
