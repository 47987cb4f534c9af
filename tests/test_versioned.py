"""Versioned tables: whole versions only, keyed merges that leave other files alone."""

import pytest
from pyspark.sql import functions as F

from merchantry.sources.versioned import VersionedTable


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def table(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/t", "id")
    assert t.version() == 0
    assert t.replace(spark.range(100).select("id", (F.col("id") * 2).alias("x"), F.lit("a").alias("s")), ranges=4) == 1
    return t


def test_a_merge_rewrites_only_its_ranges(spark, table):
    before = {f for f in table.read().inputFiles()}
    assert len(table.manifest()["parts"]) == 4
    updates = spark.createDataFrame([(98, -1), (99, None), (500, 7)], "id long, x long")
    assert table.merge(updates) == 2
    got = {r["id"]: (r["x"], r["s"]) for r in table.read().collect()}
    assert got == {i: (2 * i, "a") for i in range(98)} | {98: (-1, "a"), 99: (None, "a"), 500: (7, None)}
    after = {f for f in table.read().inputFiles()}
    one, two = table.manifest(1)["parts"], table.manifest(2)["parts"]
    assert [i for i in one if one[i] != two[i]] == ["3"]
    assert len(before & after) == len(before) - sum("_bucket=3" in f for f in before)
    assert _rows(table.read(1)) == [(i, 2 * i, "a") for i in range(100)]  # the old version is whole still


def test_nothing_is_seen_of_a_write_that_ends_early(spark, table):
    def killed(rows):
        raise KeyboardInterrupt  # the driver ends between writing and publishing

    with pytest.raises(KeyboardInterrupt):
        table.replace(spark.range(5).selectExpr("id", "id AS x", "'b' AS s"), audit=killed)
    with pytest.raises(KeyboardInterrupt):
        table.merge(spark.createDataFrame([(1, 0)], "id long, x long"), audit=killed)
    again = VersionedTable(spark, table.root, "id")
    assert again.version() == 1 and _rows(again.read()) == [(i, 2 * i, "a") for i in range(100)]
    assert again.vacuum() and _rows(again.read()) == [(i, 2 * i, "a") for i in range(100)]
    assert again.vacuum() == []
    assert again.merge(spark.createDataFrame([(1, 0)], "id long, x long")) == 2


def test_two_writers_cannot_publish_one_number(spark, table):
    other = VersionedTable(spark, table.root, "id")
    with pytest.raises(Exception, match="exists"):
        table.merge(spark.createDataFrame([(1, 0)], "id long, x long"), audit=lambda rows: other.merge(spark.createDataFrame([(2, 0)], "id long, x long")) and None)
    assert table.version() == 2 and {r["id"] for r in table.read().filter("x = 0").collect()} == {0, 2}


def test_defined_cases(spark, table):
    kind = "id long, x long"
    assert table.merge(spark.createDataFrame([], kind)) == 1
    with pytest.raises(ValueError, match="without id"):
        table.merge(spark.createDataFrame([(None, 1)], kind))
    with pytest.raises(ValueError, match="more than one row"):
        table.merge(spark.createDataFrame([(3, 1), (3, 2)], kind))
    assert table.version() == 1
    empty = VersionedTable(spark, f"{table.root}-empty", "id")
    with pytest.raises(LookupError):
        empty.read()
    assert empty.replace(spark.createDataFrame([], kind)) == 1 and empty.read().count() == 0
    assert empty.merge(spark.createDataFrame([(4, 1)], kind)) == 2 and _rows(empty.read()) == [(4, 1)]
    same = VersionedTable(spark, f"{table.root}-null", "id")
    same.replace(spark.createDataFrame([(None, 1), (None, 1), (5, 2)], kind), ranges=8)
    assert same.read().count() == 3
