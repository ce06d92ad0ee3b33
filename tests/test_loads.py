"""Loads that are checked, that come twice, and where they write."""

import datetime

import pytest

from tidemark.sources import tables

DDL = "id INT, name STRING, day DATE, amount DECIMAL(10,2)"
GOOD = ["1\tann\t2024-01-02\t3.50", "2\t\t2024-02-29\t-1", "3\tbob\t\t"]
BAD = ["4\ttoo few", "5\ttoo\t2024-01-01\t1\tmany", "x\tno number\t2024-01-01\t1", "6\tno day\t2024-02-30\t1", "7\tno amount\t2024-01-01\tfree"]


def test_lines_that_do_not_fit_are_set_aside(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.tsv").write_text("\n".join([GOOD[0], BAD[0], BAD[1], GOOD[1]]) + "\n")
    (tmp_path / "in" / "b.tsv").write_text("\n".join([*BAD[2:], GOOD[2]]) + "\n")
    path = str(tmp_path / "table")
    for _ in range(2):  # a repeated load replaces both
        tables.load_checked(spark, str(tmp_path / "in"), DDL, path, sep="\t")
        rows = sorted(tuple(r) for r in tables.loaded(spark, path, DDL).collect())
        assert [r[0] for r in rows] == [1, 2, 3]
        assert rows[0][1:3] == ("ann", datetime.date(2024, 1, 2)) and float(rows[0][3]) == 3.5
        assert rows[2][2:] == (None, None)
        assert sorted(r["line"] for r in tables.refused(spark, path, DDL).collect()) == sorted(BAD)
        assert tuple(tables.load_counts(spark, path, DDL).first()) == (3, 5)
        assert tables.loaded(spark, path, DDL).select("id").count() == 3


def test_nothing_to_load(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("")
    tables.load_checked(spark, str(tmp_path / "in"), DDL, str(tmp_path / "table"))
    spark_rows = spark.read.schema(DDL + ", _line STRING, refused BOOLEAN").parquet(str(tmp_path / "table"))
    assert spark_rows.count() == 0


def test_a_batch_twice_is_a_batch_once(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([(1, "mon"), (2, "mon"), (2, "mon"), (3, "tue"), (4, None)], "id int, batch string")
    read = lambda: sorted(((r["id"], r["batch"]) for r in spark.read.parquet(path).collect()), key=repr)
    wanted = sorted(((r["id"], r["batch"]) for r in rows.collect()), key=repr)
    tables.load_batch(rows, path, "batch")
    assert read() == wanted
    tables.load_batch(rows.filter("batch = 'mon'"), path, "batch")
    tables.load_batch(rows.filter("batch is null"), path, "batch")
    assert read() == wanted
    tables.load_batch(spark.createDataFrame([(9, "tue")], "id int, batch string"), path, "batch")
    assert read() == sorted([x for x in wanted if x[1] != "tue"] + [(9, "tue")], key=repr)


@pytest.mark.parametrize("buckets", [1, 3])
def test_bucketed_rows_come_back(spark, tmp_path, buckets):
    rows = spark.range(50).selectExpr("id % 7 AS k", "id")
    found = tables.save_bucketed(rows, f"bucketed_rows_{buckets}", str(tmp_path / "table"), ["k"], buckets)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, rows.collect()))
