"""The key check of a merge stays where the result is filtered, joined,
cut down to some columns or limited."""

import pytest

from keelson.operators import insert_new, merge, scd1, scd2, scd2_init, scd3


def rows(spark, pairs, schema="id int, st string"):
    return spark.createDataFrame(pairs, schema)


@pytest.fixture()
def target(spark):
    return rows(spark, [(i, "A") for i in range(10)])


@pytest.fixture()
def twice(spark):
    return rows(spark, [(1, "B"), (1, "C"), (2, "B")])


USES = {
    "count": lambda df, other: df.count(),
    "collect": lambda df, other: df.collect(),
    "filter_value": lambda df, other: df.filter("st in ('B', 'C')").collect(),
    "filter_key": lambda df, other: df.filter("id < 5").collect(),
    "filter_one": lambda df, other: df.filter("id = 1").count(),
    "not_null": lambda df, other: df.filter("id is not null").count(),
    "join": lambda df, other: df.join(other, "id").collect(),
    "semi": lambda df, other: df.join(other, "id", "left_semi").count(),
    "select_key": lambda df, other: df.select("id").distinct().collect(),
    "limit": lambda df, other: df.limit(1000).collect(),
    "group": lambda df, other: df.groupBy("id").count().collect(),
}


@pytest.mark.parametrize("use", USES)
@pytest.mark.parametrize("strategy", ["auto", "broadcast"])
def test_repeated_keys_raise(spark, target, twice, use, strategy):
    other = rows(spark, [(1, "x"), (2, "y")], "id int, o string")
    for out in (merge(target, twice, "id", update="*", insert="*", strategy=strategy),
                merge(target, twice, "id", update={"st": "source.st"}, strategy=strategy)):
        with pytest.raises(Exception, match="2 rows for key"):
            USES[use](out, other)


@pytest.mark.parametrize("use", USES)
def test_repeated_new_keys_raise(spark, target, use):
    new = rows(spark, [(50, "B"), (50, "C"), (2, "B")])
    other = rows(spark, [(50, "x")], "id int, o string")
    uses = dict(USES, filter_key=lambda df, other: df.filter("id > 5").collect(),
                filter_one=lambda df, other: df.filter("id = 50").count())
    for out in (merge(target, new, "id", update="*", insert="*"), insert_new(target, new, "id")):
        with pytest.raises(Exception, match="2 rows for key"):
            uses[use](out, other)


@pytest.mark.parametrize("use", ["filter_value", "filter_key", "join", "limit", "select_key"])
def test_dimension_steps_raise(spark, target, twice, use):
    other = rows(spark, [(1, "x"), (2, "y")], "id int, o string")
    outs = [scd1(target, twice, "id"),
            scd2(scd2_init(target, "2025-01-01", hash_col="h"), twice, "id", "2025-01-02",
                 hash_col="h"),
            scd3(target.selectExpr("id", "st as prev_value", "st as st"), twice, "id",
                 value_col="st", prev_col="prev_value", curr_col="st")]
    for out in outs:
        with pytest.raises(Exception, match="2 rows for key"):
            USES[use](out, other)


@pytest.mark.parametrize("use", ["count", "filter_value", "limit", "select_key", "group"])
def test_null_keys_raise(spark, target, use):
    null = rows(spark, [(None, "B"), (2, "B")])
    for out in (merge(target, null, "id", update="*", insert="*"), insert_new(target, null, "id")):
        with pytest.raises(Exception, match="NULL key"):
            USES[use](out, None)
    kept = merge(target, null, "id", update="*", insert="*", null_keys="insert")
    assert kept.filter("id is null").count() == 1


def test_every_type_of_column_passes_the_check(spark):
    schema = "id int, m map<string,int>, a array<string>, s struct<x:double>, d decimal(9,2)"
    target = spark.createDataFrame([(1, {"a": 1}, ["x"], (1.0,), None)], schema)
    source = spark.createDataFrame([(1, {"b": 2}, ["y", None], (2.5,), None),
                                    (3, None, None, None, None)], schema)
    out = {r["id"]: r for r in merge(target, source, "id", update="*", insert="*").collect()}
    assert out[1]["m"] == {"b": 2} and out[1]["a"] == ["y", None] and out[1]["s"]["x"] == 2.5
    assert out[1]["d"] is None and out[3]["m"] is None
