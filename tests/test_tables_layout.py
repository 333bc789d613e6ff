"""Sinks, snapshots and physical layout (rows-only operators)."""

import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from keelson.operators import lay_out, partition_profile, range_profile, write_laid_out
from keelson.plans.inputs import table
from keelson.sources import (latest_version, publish_dimension, read_dimension, read_snapshot,
                             read_table, read_versions, save_table, write_snapshot)
from tests.conftest import SF_SMALL


def test_save_table_modes(spark):
    nation = table(spark, SF_SMALL, "nation")
    save_table(nation, "kt_nation")
    with pytest.raises(AnalysisException):
        save_table(nation, "kt_nation")  # errorifexists
    save_table(nation.filter("n_regionkey = 0"), "kt_nation", mode="overwrite")
    assert read_table(spark, "kt_nation").count() == 5
    wider = nation.withColumn("n_comment", F.lit("x"))
    save_table(wider, "kt_nation", mode="overwrite", merge_schema=True)
    assert "n_comment" in read_table(spark, "kt_nation").columns


def test_snapshots_commit_and_read_latest(spark, scratch):
    base = os.path.join(scratch, "dim")
    c = table(spark, SF_SMALL, "customer")
    assert latest_version(spark, base) is None
    write_snapshot(c, base, 1)
    write_snapshot(c.filter("c_acctbal > 0"), base, 2)
    v, _ = latest_version(spark, base)
    assert v == 2
    assert read_snapshot(spark, base).count() == c.filter("c_acctbal > 0").count()
    assert read_snapshot(spark, base, version=1).count() == c.count()


def test_a_committed_version_is_not_written_again(spark, scratch):
    n = table(spark, SF_SMALL, "nation")
    for base, write in ((os.path.join(scratch, "a"), write_snapshot),
                        (os.path.join(scratch, "b"), publish_nation)):
        write(n, base, 1)
        with pytest.raises(ValueError, match="committed already"):
            write(n.limit(1), base, 1)


def publish_nation(df, base, version):
    return publish_dimension(df.withColumn("cur_rec_ind", F.lit("Y")), base, version)


def test_a_failed_write_can_be_tried_again(spark, scratch):
    base, n = os.path.join(scratch, "s"), table(spark, SF_SMALL, "nation")
    bad = n.withColumn("x", F.when(F.col("n_nationkey") == 3, F.raise_error(F.lit("crash")))
                       .otherwise(F.lit("ok")))
    with pytest.raises(PySparkException):
        write_snapshot(bad, base, 1)
    assert latest_version(spark, base) is None
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, base, version=1)
    write_snapshot(n, base, 1)
    assert read_snapshot(spark, base, version=1).count() == n.count()


def test_trouble_with_the_commits_is_not_taken_for_none(spark, scratch):
    base = os.path.join(scratch, "s")
    write_snapshot(table(spark, SF_SMALL, "nation"), base, 1)
    folder = os.path.join(base, "_commits")
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            with open(os.path.join(folder, name), "wb") as f:
                f.write(b"not parquet")
    with pytest.raises(Exception, match="parquet|Parquet|CANNOT_READ|FAILED_READ"):
        latest_version(spark, base)


DIM = "id int, v string, cur_rec_ind string, start_ts date, end_ts date"


def test_uncommitted_run_is_not_history(spark, scratch):
    base = os.path.join(scratch, "dim")
    d1, d2, d3 = dt.date(2025, 1, 1), dt.date(2025, 1, 2), dt.date(2025, 1, 3)
    publish_dimension(spark.createDataFrame([(1, "a", "Y", d1, None)], DIM), base, 1)
    # a run that wrote its files and died before its commit
    orphan = spark.createDataFrame([(1, "a", "N", d1, d2), (1, "b", "Y", d2, None)], DIM)
    orphan.withColumn("__is_current", F.col("cur_rec_ind") == "Y").write.partitionBy(
        "__is_current").parquet(os.path.join(base, "runs", "__run=0000000002-dead"))
    publish_dimension(spark.createDataFrame(
        [(1, "a", "N", d1, d3), (1, "c", "Y", d3, None)], DIM), base, 2)
    assert sorted((r.v, r.cur_rec_ind, r.end_ts) for r in read_dimension(spark, base).collect()) == [
        ("a", "N", d3), ("c", "Y", None)]
    assert [r.v for r in read_dimension(spark, base, current_only=True).collect()] == ["c"]
    assert [r.v for r in read_dimension(spark, base, version=1).collect()] == ["a"]
    with pytest.raises(FileNotFoundError):
        read_dimension(spark, base, version=7)


def test_a_column_named_v_stays(spark, scratch):
    base = os.path.join(scratch, "dim")
    rows = spark.createDataFrame([(1, "a", "Y", dt.date(2025, 1, 1), None)], DIM)
    publish_dimension(rows, base, 1)
    assert read_dimension(spark, base).columns == rows.columns
    with pytest.raises(ValueError, match="reserved"):
        publish_dimension(rows.withColumn("__run", F.lit(1)), base, 2)


def test_append_widens_a_named_table(spark):
    n = table(spark, SF_SMALL, "nation")
    save_table(n, "kt_widened")
    save_table(n.limit(2).withColumn("extra", F.lit(1)).drop("n_name"), "kt_widened", mode="append",
               merge_schema=True)
    out = read_table(spark, "kt_widened")
    assert out.count() == n.count() + 2
    assert out.filter("extra = 1 and n_name is null").count() == 2


def test_sql_over_leaves_the_callers_views_alone(spark):
    from keelson.sources.tables import sql_over
    spark.range(3).createOrReplaceTempView("kt_mine")
    out = sql_over(spark, {"kt_mine": spark.range(7), "kt_other": spark.range(5)},
                   "SELECT a.id FROM kt_mine a JOIN kt_other b ON a.id = b.id")
    assert out.count() == 5
    assert spark.table("kt_mine").count() == 3
    assert not spark.catalog.tableExists("kt_other")
    spark.catalog.dropTempView("kt_mine")


def test_salted_layout_splits_a_hot_key(spark):
    df = spark.createDataFrame([(1, i) for i in range(4000)], "k int, n int")
    plain = partition_profile(lay_out(df, "hash", 8, ["k"])).collect()
    salted = partition_profile(lay_out(df, "hash", 8, ["k"], salts=16)).collect()
    assert len(plain) == 1 and len(salted) > 3 and max(r.rows for r in salted) < 2500


def test_read_versions_merge_schema(spark, scratch):
    a, b = os.path.join(scratch, "a"), os.path.join(scratch, "b")
    n = table(spark, SF_SMALL, "nation")
    n.write.parquet(a)
    n.withColumn("extra", F.lit(1)).write.parquet(b)
    both = read_versions(spark, [a, b])
    assert "extra" in both.columns
    assert both.filter("extra IS NULL").count() == n.count()


def test_round_robin_is_even(spark):
    prof = partition_profile(lay_out(table(spark, SF_SMALL, "lineitem"), "round_robin", 8)).collect()
    sizes = [r.rows for r in prof]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 1


def test_hash_layout_keeps_a_key_in_one_partition(spark):
    df = lay_out(table(spark, SF_SMALL, "customer"), "hash", 8, ["c_mktsegment"])
    per_key = df.select("c_mktsegment", F.spark_partition_id().alias("p")).distinct() \
        .groupBy("c_mktsegment").count()
    assert per_key.filter("count > 1").count() == 0


def test_range_layout_is_disjoint(spark):
    prof = sorted(range_profile(lay_out(table(spark, SF_SMALL, "orders"), "range", 5,
                                        ["o_orderkey"]), "o_orderkey").collect(),
                  key=lambda r: r.min_key)
    assert 1 < len(prof) <= 5
    for lo, hi in zip(prof, prof[1:]):
        assert lo.max_key < hi.min_key


def test_coalesce_cannot_grow(spark):
    df = table(spark, SF_SMALL, "orders")
    assert lay_out(df, "coalesce", 1).rdd.getNumPartitions() == 1
    assert lay_out(df.coalesce(1), "coalesce", 4).rdd.getNumPartitions() == 1


def test_write_laid_out(spark, scratch):
    path = os.path.join(scratch, "laid")
    write_laid_out(table(spark, SF_SMALL, "orders"), path, "range", 4, ["o_orderdate"],
                   sort_within=["o_orderdate"])
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert 1 <= len(files) <= 4
    assert spark.read.parquet(path).count() == table(spark, SF_SMALL, "orders").count()


def test_with_partition_id(spark):
    from keelson.operators import with_partition_id
    df = with_partition_id(lay_out(table(spark, SF_SMALL, "nation"), "round_robin", 3))
    assert sorted({r.partition_id for r in df.collect()}) == [0, 1, 2]


def test_lay_out_rejects_bad_arguments(spark):
    df = table(spark, SF_SMALL, "nation")
    with pytest.raises(ValueError):
        lay_out(df, "hash", 4)
    with pytest.raises(ValueError):
        lay_out(df, "range", 4)
    with pytest.raises(ValueError):
        lay_out(df, "zigzag", 4)
    assert lay_out(df, "none").count() == df.count()


def test_apply_conf_sets_runtime_settings(spark):
    from keelson.session import apply_conf, scale_conf
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    conf = scale_conf(10 * 1024 ** 3, 8)
    shuffle_old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        apply_conf(spark, {key: conf[key]})
        assert spark.conf.get(key) in (conf[key], f"{int(conf[key]) // 1024 // 1024}m")
    finally:
        spark.conf.set(key, old)
        spark.conf.set("spark.sql.shuffle.partitions", shuffle_old)
