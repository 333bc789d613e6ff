"""Joins on keys that may be NULL, pivots beyond their list, sorting, contracts, incremental loads."""

import datetime as dt
import os
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from keelson.operators import hash_key_join, join_on, pivot, sort_by
from keelson.sources import conform, new_rows


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_hash_key_join_equals_the_key_join(spark, how):
    a = spark.createDataFrame([(1, "x", 1), (1, None, 2), (None, None, 3), (2, "y", 4)],
                              "k int, s string, l int")
    b = spark.createDataFrame([(1, "x", 10), (1, None, 20), (None, None, 30), (3, "z", 40)],
                              "k int, s string, r int")
    got = hash_key_join(a, b, ["k", "s"], how).select("k", "s", "l", "r")
    assert rows_of(got) == rows_of(a.join(b, ["k", "s"], how).select("k", "s", "l", "r"))


def test_outer_joins_ignore_the_case_of_names(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "NationKey int, l string")
    b = spark.createDataFrame([(2, "B"), (3, "C")], "nationkey int, r string")
    assert rows_of(join_on(a, b, "nationkey", "full")) == [
        (1, "a", None), (2, "b", "B"), (3, None, "C")]
    assert rows_of(join_on(a, b, "NATIONKEY", "right")) == [(2, "b", "B"), (3, None, "C")]


def test_pivot_says_what_its_list_lacks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, None), (2, "a")], "k int, v string")
    n = F.count(F.lit(1))
    with pytest.raises(PySparkException, match="not in the list"):
        pivot(df, ["k"], "v", n, ["a", "b"]).collect()
    out = pivot(df, ["k"], "v", n, ["a", "b"], others="column")
    assert out.columns == ["k", "a", "b", "other"]
    assert rows_of(out) == [(1, 1, 1, None), (2, 1, None, 2)]
    assert rows_of(pivot(df.filter("k = 1"), ["k"], "v", n, ["a", "b"])) == [(1, 1, 1)]
    with pytest.raises(ValueError):
        pivot(df, ["k"], "v", n, ["a", "other"], others="column")


def test_sorting_rows_with_maps(spark):
    df = spark.createDataFrame([(2, {"a": 1}), (1, {"b": 2}), (3, None)], "k int, m map<string, int>")
    assert [r.k for r in sort_by(df, ["k"]).collect()] == [1, 2, 3]
    assert sort_by(df.select(F.struct("m").alias("s")), [F.col("s.m")["a"]]).count() == 3


def test_numbers_that_a_cast_would_change_break_the_contract(spark):
    df = spark.createDataFrame([(1.9, 5), (2.0, 300), (None, 7), (1e30, 1)], "x double, n int")
    found = conform(df, "x int, n tinyint").select("_violations").collect()
    assert [sorted(r[0]) for r in found] == [["x"], ["n"], [], ["x"]]


def test_new_rows_at_the_mark_and_without_a_value(spark):
    schema = "id int, t timestamp_ntz"
    d = lambda h: dt.datetime(2025, 1, 1, h)
    target = spark.createDataFrame([(1, d(1)), (2, d(2)), (9, None)], schema)
    source = spark.createDataFrame(
        [(1, d(1)), (2, d(2)), (3, d(2)), (4, d(3)), (5, None), (9, None), (6, d(1))], schema)
    for lazy in (False, True):
        assert [r[0] for r in rows_of(new_rows(source, target, "t", lazy=lazy, keys=["id"]))] == [3, 4, 5]
        assert [r[0] for r in rows_of(new_rows(source, target, "t", lazy=lazy))] == [4]
        assert new_rows(source, target.limit(0), "t", lazy=lazy, keys=["id"]).count() == 7


def test_the_drivers_time_zone_does_not_move_the_mark(spark):
    kinds = ("timestamp_ntz", "timestamp", "date")
    old = os.environ.get("TZ")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            os.environ["TZ"] = zone
            time.tzset()
            for kind in kinds:
                base = spark.sql(f"SELECT * FROM VALUES (1, '2025-01-01 10:00:00'), "
                                 f"(2, '2025-01-02 12:00:00') v(id, s)").select(
                    "id", F.col("s").cast(kind).alias("t"))
                assert [r.id for r in new_rows(base, base.filter("id = 1"), "t").collect()] == [2]
                assert new_rows(base, base, "t").count() == 0
    finally:
        if old is None:
            os.environ.pop("TZ", None)
        else:
            os.environ["TZ"] = old
        time.tzset()
