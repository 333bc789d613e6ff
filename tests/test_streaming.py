"""Incremental SCD 2 through Structured Streaming (file source + foreachBatch)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from keelson.operators import current, history, scd2
from keelson.plans.inputs import CUSTOMER_COLS, customer_refresh, table
from keelson.plans.q_merge import DIM_OPTS, customer_dimension
from keelson.sources import publish_dimension, read_dimension, read_snapshot, write_snapshot
from keelson.streaming import stream_apply
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("layout", ["snapshot", "dimension"])
def test_daily_batches_build_history(spark, scratch, layout):
    base = os.path.join(scratch, "dim")
    batches = os.path.join(scratch, "batches")
    if layout == "snapshot":
        write_snapshot(customer_dimension(spark, SF_SMALL), base, 1)
    else:
        publish_dimension(customer_dimension(spark, SF_SMALL), base, 1)

    day1 = customer_refresh(spark, SF_SMALL).withColumn("extract_date", F.lit("2025-07-29").cast("date"))
    day2 = customer_refresh(spark, SF_SMALL, raise_by=200).withColumn(
        "extract_date", F.lit("2025-07-30").cast("date"))
    day1.write.parquet(os.path.join(batches, "day1"))

    def step(cur, batch, as_of):
        return scd2(cur, batch, "c_custkey", as_of, hash_col="hash_key", **DIM_OPTS)

    schema = day1.schema
    ckpt = os.path.join(scratch, "ckpt")
    q = stream_apply(spark, os.path.join(batches, "*"), schema, base, step,
                     keys=["c_custkey"], as_of_col="extract_date", checkpoint=ckpt,
                     layout=layout)
    q.awaitTermination()
    day2.write.parquet(os.path.join(batches, "day2"))
    q = stream_apply(spark, os.path.join(batches, "*"), schema, base, step,
                     keys=["c_custkey"], as_of_col="extract_date", checkpoint=ckpt,
                     layout=layout)
    q.awaitTermination()

    streamed = read_snapshot(spark, base) if layout == "snapshot" else read_dimension(spark, base)
    expected = step(step(customer_dimension(spark, SF_SMALL),
                         day1.drop("extract_date"), "2025-07-29"),
                    day2.drop("extract_date"), "2025-07-30")
    assert sorted(streamed.collect()) == sorted(expected.collect())
    assert current(streamed).groupBy("c_custkey").count().filter("count > 1").count() == 0
    assert history(streamed).count() > 0
    assert set(CUSTOMER_COLS) <= set(streamed.columns)
    assert table(spark, SF_SMALL, "customer").count() <= current(streamed).count()


def test_replayed_epoch_changes_nothing(spark, scratch):
    # a crash after an epoch's commit but before the stream's checkpoint
    # makes Spark run that epoch again: simulate it with a fresh checkpoint
    base = os.path.join(scratch, "dim")
    batches = os.path.join(scratch, "batches")
    publish_dimension(customer_dimension(spark, SF_SMALL), base, 1)
    day1 = customer_refresh(spark, SF_SMALL).withColumn(
        "extract_date", F.lit("2025-07-29").cast("date"))
    day1.write.parquet(os.path.join(batches, "day1"))

    def step(cur, batch, as_of):
        return scd2(cur, batch, "c_custkey", as_of, hash_col="hash_key", **DIM_OPTS)

    for ckpt in ("ckpt_a", "ckpt_b"):
        stream_apply(spark, os.path.join(batches, "*"), day1.schema, base, step,
                     keys=["c_custkey"], as_of_col="extract_date",
                     checkpoint=os.path.join(scratch, ckpt), layout="dimension").awaitTermination()
        if ckpt == "ckpt_a":
            after_first = sorted(read_dimension(spark, base).collect())
    assert sorted(read_dimension(spark, base).collect()) == after_first
    assert read_dimension(spark, base, version=3).count() == len(after_first)


@pytest.mark.parametrize("layout", ["snapshot", "dimension"])
def test_a_backlog_equals_daily_runs(spark, scratch, layout):
    dim_schema = "id int, v string, cur_rec_ind string, start_ts date, end_ts date"
    start = spark.createDataFrame([(1, "a", "Y", dt.date(2025, 1, 1), None)], dim_schema)
    days = [[(1, "b", dt.date(2025, 1, 2)), (2, "x", dt.date(2025, 1, 2))],
            [(1, "c", dt.date(2025, 1, 3))]]
    schema = "id int, v string, d date"

    def step(cur, batch, as_of):
        return scd2(cur, batch, "id", as_of, detect="columns")

    found = []
    for daily in (True, False):
        base, batches = (os.path.join(scratch, f"{x}{daily}") for x in ("dim", "in"))
        (write_snapshot if layout == "snapshot" else publish_dimension)(start, base, 1)
        for i, rows in enumerate(days):
            spark.createDataFrame(rows, schema).write.parquet(os.path.join(batches, f"day{i}"))
            if daily or i == len(days) - 1:
                stream_apply(spark, os.path.join(batches, "*"), schema, base, step, keys=["id"],
                             as_of_col="d", checkpoint=os.path.join(scratch, f"c{daily}"),
                             layout=layout).awaitTermination()
        out = read_snapshot(spark, base) if layout == "snapshot" else read_dimension(spark, base)
        found.append(sorted(map(tuple, out.collect()), key=str))
    assert found[0] == found[1] and len(found[0]) == 4
