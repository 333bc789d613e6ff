"""merge_partitions: a batch into a partitioned table."""

import glob
import os

import pytest

from keelson.operators import merge
from keelson.sources import merge_partitions

SCHEMA = "id int, v string, day string"


def stored(spark, path, rows, by=("day",), schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.partitionBy(*by).parquet(path)
    return spark.createDataFrame([], schema).schema


def files(path):
    return {os.path.relpath(f, path) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def read(spark, path, schema):
    return sorted(map(tuple, spark.read.schema(schema).parquet(path).collect()), key=str)


@pytest.fixture()
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, f"v{i}", f"d{i % 5}") for i in range(50)] + [(100, "n", None), (101, None, "d1")]
    return path, stored(spark, path, rows)


def expected(spark, path, schema, source, **kw):
    whole = merge(spark.read.schema(schema).parquet(path), source, "id", **kw)
    return sorted(map(tuple, whole.collect()), key=str)


def test_only_touched_partitions_change(spark, table):
    path, schema = table
    before = files(path)
    source = spark.createDataFrame([(6, "x"), (11, "y"), (8, "z"), (999, "nobody")], "id int, v string")
    wish = expected(spark, path, schema, source, update={"v": "source.v"})
    done = merge_partitions(spark, path, source, "id", partition_by=["day"],
                            update={"v": "source.v"}, schema=schema)
    assert done.rewritten == [("d1",), ("d3",)] and done.appended == []
    assert read(spark, path, schema) == wish
    after = files(path)
    same = {f for f in before if not f.startswith(("day=d1", "day=d3"))}
    assert same <= after and not any(f in after for f in before - same)


def test_inserts_are_appended(spark, table):
    path, schema = table
    before = files(path)
    source = spark.createDataFrame([(6, "x", "d1"), (200, "new", "d1"), (201, "new", "d2"),
                                    (202, "new", "d9"), (203, None, None)], SCHEMA)
    wish = expected(spark, path, schema, source, update={"v": "source.v"}, insert="*")
    for _ in range(2):  # the batch run again changes nothing
        done = merge_partitions(spark, path, source, "id", partition_by=["day"],
                                update={"v": "source.v"}, insert="*", schema=schema)
        assert read(spark, path, schema) == wish
        if _ == 0:
            assert done.rewritten == [("d1",)]
            assert sorted(done.appended, key=str) == [("d2",), ("d9",), (None,)]
            assert {f for f in before if not f.startswith("day=d1")} <= files(path)
    assert done.appended == []


def test_insert_only_rewrites_nothing(spark, table):
    path, schema = table
    before = files(path)
    source = spark.createDataFrame([(6, "no", "d4"), (300, "new", "d1")], SCHEMA)
    done = merge_partitions(spark, path, source, "id", partition_by=["day"], insert="*", schema=schema)
    assert done.rewritten == [] and done.appended == [("d1",)] and before < files(path)
    assert (6, "v6", "d1") in read(spark, path, schema)


def test_partition_columns_among_the_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i % 4, i, "a" if i % 2 else "b", float(i)) for i in range(16)]
    schema = stored(spark, path, rows, by=("y", "c"), schema="y int, id int, c string, v double")
    before = files(path)
    source = spark.createDataFrame([("1", 1, "a", -1.0), ("7", 1, "a", -7.0), ("2", 2, "b", None)],
                                   "y string, id int, c string, v double")
    whole = merge(spark.read.schema(schema).parquet(path), source, ["y", "c", "id"], update="*",
                  insert="*")
    wish = sorted(map(tuple, whole.select("id", "v", "y", "c").collect()), key=str)
    done = merge_partitions(spark, path, source, ["y", "c", "id"], partition_by=["y", "c"],
                            update="*", insert="*", schema=schema)
    got = spark.read.schema(schema).parquet(path).select("id", "v", "y", "c")
    assert sorted(map(tuple, got.collect()), key=str) == wish
    assert done.rewritten == [(1, "a"), (2, "b")] and done.appended == [(7, "a")]
    assert len(before & files(path)) == len(before) - 2


def test_refusals_leave_the_table_alone(spark, table):
    path, schema = table
    before = files(path)
    one = spark.createDataFrame([(6, "x", "d2")], SCHEMA)
    with pytest.raises(ValueError, match="can't be updated"):
        merge_partitions(spark, path, one, "id", partition_by=["day"], update="*", schema=schema)
    with pytest.raises(ValueError, match="needs update or insert"):
        merge_partitions(spark, path, one, "id", partition_by=["day"], schema=schema)
    twice = spark.createDataFrame([(6, "x", "d1"), (6, "y", "d1")], SCHEMA)
    with pytest.raises(Exception, match="2 rows for key"):
        merge_partitions(spark, path, twice, "id", partition_by=["day"], update={"v": "source.v"},
                         schema=schema)
    assert files(path) == before
    empty = one.limit(0)
    done = merge_partitions(spark, path, empty, "id", partition_by=["day"],
                            update={"v": "source.v"}, insert="*", schema=schema)
    assert done.rewritten == done.appended == [] and files(path) == before
