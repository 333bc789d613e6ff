"""Properties of the merge/SCD operators on the test tables, and the guards."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from keelson.operators import (check_source_keys, current, dedupe_latest, history, merge, scd1,
                               scd2, scd2_init)
from keelson.plans.inputs import AS_OF, SECOND_AS_OF, customer_refresh, table
from keelson.plans.q_merge import DIM_OPTS, customer_dimension
from tests.conftest import SF_SMALL


def _scd2(t, s, as_of, **kw):
    return scd2(t, s, "c_custkey", as_of, hash_col="hash_key", **DIM_OPTS, **kw)


@pytest.fixture(scope="module")
def step1(spark):
    return _scd2(customer_dimension(spark, SF_SMALL), customer_refresh(spark, SF_SMALL), AS_OF)


def test_one_current_row_per_key(spark, step1):
    per_key = current(step1).groupBy("c_custkey").count()
    assert per_key.filter("count <> 1").count() == 0
    keys_in = customer_refresh(spark, SF_SMALL).select("c_custkey").union(
        table(spark, SF_SMALL, "customer").select("c_custkey")).distinct().count()
    assert per_key.count() == keys_in


def test_replay_is_noop(spark, step1):
    again = _scd2(step1, customer_refresh(spark, SF_SMALL), AS_OF)
    assert sorted(again.collect()) == sorted(step1.collect())


def test_history_rows_never_change(spark, step1):
    step2 = _scd2(step1, customer_refresh(spark, SF_SMALL, raise_by=200), SECOND_AS_OF)
    before = sorted(history(step1).collect())
    after = history(step2).filter(F.col("end_date") < F.lit(SECOND_AS_OF).cast("date"))
    assert sorted(after.collect()) == before


def test_closed_row_ends_where_new_row_starts(spark, step1):
    closed = history(step1).select("c_custkey", F.col("end_date").alias("d"))
    opened = current(step1).select("c_custkey", F.col("start_date").alias("d"))
    assert closed.join(opened, ["c_custkey", "d"], "left_anti").count() == 0


def test_strategies_agree(spark):
    dim, src = customer_dimension(spark, SF_SMALL), customer_refresh(spark, SF_SMALL)
    a = _scd2(dim, src, AS_OF, strategy="shuffle").collect()
    b = _scd2(dim, src, AS_OF, strategy="broadcast").collect()
    assert sorted(a) == sorted(b)


def test_scd1_row_count_is_key_union(spark):
    t, s = table(spark, SF_SMALL, "customer"), customer_refresh(spark, SF_SMALL)
    out = scd1(t, s, "c_custkey")
    assert out.count() == t.select("c_custkey").union(s.select("c_custkey")).distinct().count()


def test_duplicate_source_key_raises(spark):
    t = spark.createDataFrame([(1, "a")], "id int, v string")
    s = spark.createDataFrame([(1, "b"), (1, "c")], "id int, v string")
    for kw in ({"update": "*", "insert": "*"}, {"update": "*"}, {"insert": "*"}):
        with pytest.raises(PySparkException, match="one row per key"):
            merge(t, s, "id", **kw).collect()
    with pytest.raises(ValueError, match="one row per key"):
        check_source_keys(s, ["id"])


def test_keys_alike_after_the_cast_raise(spark):
    t = spark.createDataFrame([(1, "a")], "id int, v string")
    s = spark.createDataFrame([("1", "b"), ("01", "c")], "id string, v string")
    with pytest.raises(PySparkException, match="one row per key"):
        merge(t, s, "id", update="*", insert="*").collect()
    dim = spark.createDataFrame([(1, "a", "Y", dt.date(2025, 1, 1), None)],
                                "id int, v string, cur_rec_ind string, start_ts date, end_ts date")
    with pytest.raises(PySparkException, match="one row per key"):
        scd2(dim, s, "id", "2025-02-01").collect()
    assert check_source_keys(s, ["id"]).rows == 2
    with pytest.raises(ValueError, match="one row per key"):
        check_source_keys(s, ["id"], key_types={"id": t.schema["id"].dataType})


@pytest.mark.parametrize("strategy", ["auto", "shuffle", "broadcast"])
def test_two_null_key_rows_are_inserted(spark, strategy):
    t = spark.createDataFrame([(1, "a")], "id int, v string")
    s = spark.createDataFrame([(None, "n"), (None, "m"), (2, "b")], "id int, v string")
    out = merge(t, s, "id", update="*", insert="*", null_keys="insert", strategy=strategy)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [(1, "a"), (None, "n"), (None, "m"), (2, "b")], key=str)
    assert check_source_keys(s, ["id"], null_keys="insert").null_key_rows == 2


def test_late_batch_is_refused(spark):
    dim = spark.createDataFrame([(1, "a", "Y", dt.date(2025, 1, 10), None)],
                                "id int, v string, cur_rec_ind string, start_ts date, end_ts date")
    late = spark.createDataFrame([(1, "b")], "id int, v string")
    with pytest.raises(PySparkException, match="before the start"):
        scd2(dim, late, "id", "2025-01-02", detect="columns").collect()
    same = spark.createDataFrame([(1, "a")], "id int, v string")  # nothing would be closed
    assert scd2(dim, same, "id", "2025-01-02", detect="columns").count() == 1


def test_tracked_subset_on_a_stored_hash_is_a_noop_on_replay(spark):
    base = spark.createDataFrame([(1, "ann", 30), (2, "bob", 40)], "id int, name string, age int")
    dim = scd2_init(base, "2025-01-01", hash_col="hash_key")
    out = scd2(dim, base, "id", "2025-02-01", hash_col="hash_key", tracked=["age"])
    assert sorted(out.collect()) == sorted(dim.collect())
    other = spark.createDataFrame([(1, "ANN", 30), (2, "bob", 41)], "id int, name string, age int")
    out = scd2(dim, other, "id", "2025-02-01", hash_col="hash_key", tracked=["age"])
    assert sorted((r.id, r.name, r.age, r.cur_rec_ind) for r in out.collect()) == [
        (1, "ann", 30, "Y"), (2, "bob", 40, "N"), (2, "bob", 41, "Y")]
    opened = out.filter("id = 2 and cur_rec_ind = 'Y'").first().hash_key
    assert opened == scd2_init(other.filter("id = 2"), "2025-02-01", hash_col="hash_key").first().hash_key


def test_compat_hash_replay_with_text_columns(spark):
    base = spark.createDataFrame([(1, 10.5)], "id bigint, amt double")
    dim = scd2_init(base, "2025-01-01", hash_col="hash_key", hash_compat=True)
    batch = spark.createDataFrame([("01", "10.50")], "id string, amt string")
    out = scd2(dim, batch, "id", "2025-02-01", hash_col="hash_key", hash_compat=True)
    assert out.count() == 1


def test_hash_detection_sees_nan_and_small_changes(spark):
    dim = scd2_init(spark.createDataFrame([(1, None), (2, 1e-7), (3, 5.0)], "id int, x double"),
                    "2025-01-01", hash_col="hash_key")
    batch = spark.createDataFrame([(1, float("nan")), (2, 4e-7), (3, 5.0)], "id int, x double")
    for kw in ({"detect": "hash"}, {"detect": "columns"}):
        out = scd2(dim, batch, "id", "2025-02-01", hash_col="hash_key", **kw)
        assert sorted(r.id for r in history(out).collect()) == [1, 2]


def test_moments_tell_two_loads_of_a_day_apart(spark):
    base = spark.createDataFrame([(1, "a")], "id int, v string")
    dim = scd2_init(base, dt.datetime(2025, 7, 29, 8, 0), time_type="timestamp")
    for hour, v in ((12, "b"), (18, "c")):
        batch = spark.createDataFrame([(1, v)], "id int, v string")
        dim = scd2(dim, batch, "id", dt.datetime(2025, 7, 29, hour, 30), detect="columns")
    got = sorted((r.v, r.start_ts.hour, r.end_ts.hour if r.end_ts else None) for r in dim.collect())
    assert got == [("a", 8, 12), ("b", 12, 18), ("c", 18, None)]


def test_dedupe_latest_ties_are_settled_by_the_row(spark):
    rows = [(1, 5, f"v{i}") for i in range(50)]
    found = {dedupe_latest(spark.createDataFrame(rows[::step], "k int, ts int, v string")
                           .repartition(n), ["k"], "ts").first().v for step, n in ((1, 1), (-1, 7), (1, 4))}
    assert len(found) == 1


def test_null_source_key(spark):
    t = spark.createDataFrame([(1, "a")], "id int, v string")
    s = spark.createDataFrame([(None, "n"), (2, "b")], "id int, v string")
    for kw in ({"update": "*", "insert": "*"}, {"update": "*"}, {"insert": "*"}):
        with pytest.raises(PySparkException, match="NULL key"):
            merge(t, s, "id", **kw).collect()
    out = merge(t, s, "id", update="*", insert="*", null_keys="insert")
    assert sorted(out.collect(), key=str) == sorted(
        [(1, "a"), (None, "n"), (2, "b")], key=str)


def test_null_target_keys_pass_through(spark):
    t = spark.createDataFrame([(None, "x"), (1, "a")], "id int, v string")
    s = spark.createDataFrame([(1, "b")], "id int, v string")
    out = merge(t, s, "id", update="*", insert="*", strategy="shuffle")
    assert sorted(out.collect(), key=str) == sorted([(None, "x"), (1, "b")], key=str)


def test_dedupe_latest_hot_key(spark):
    # one key holds a third of the rows: reduced map-side by max_by
    rows = [(0, i, f"v{i}") for i in range(3000)] + [(k, 1, f"w{k}") for k in range(1, 6001)]
    df = spark.createDataFrame(rows, "k int, ts int, v string").repartition(8)
    out = dedupe_latest(df, ["k"], "ts")
    assert out.count() == 6001
    assert out.filter("k = 0").first()["v"] == "v2999"
    prof = check_source_keys(out, ["k"])
    assert prof.rows == 6001 and prof.max_rows_per_key == 1


def test_update_when_condition(spark):
    t = spark.createDataFrame([(1, 10), (2, 20)], "id int, amt int")
    s = spark.createDataFrame([(1, 5), (2, 25)], "id int, amt int")
    out = merge(t, s, "id", update={"amt": "source.amt"}, update_when="source.amt > target.amt")
    assert sorted(out.collect()) == [(1, 10), (2, 25)]


def test_target_filter_keeps_non_matching_rows(spark):
    t = spark.createDataFrame([(1, "Y", 1), (1, "N", 0)], "id int, flag string, v int")
    s = spark.createDataFrame([(1, 9)], "id int, v int")
    out = merge(t, s, "id", update={"v": "source.v"}, target_filter=F.col("flag") == "Y")
    assert sorted(out.collect()) == [(1, "N", 0), (1, "Y", 9)]


@pytest.mark.parametrize("strategy", ["shuffle", "broadcast"])
def test_composite_keys_with_different_names(spark, strategy):
    t = spark.createDataFrame([(1, "a", 10), (1, "b", 20), (2, "a", 30)],
                              "k1 int, k2 string, v int")
    s = spark.createDataFrame([("1", "B", 21), ("1", "b", 22), ("3", "a", 40)],
                              "K1 string, key2 string, v int")
    out = merge(t, s, {"k1": "K1", "k2": "key2"}, update={"v": "source.v"},
                insert={"k1": "source.K1", "k2": "source.key2", "v": "source.v"},
                strategy=strategy)
    assert sorted(out.collect()) == [(1, "B", 21), (1, "a", 10), (1, "b", 22), (2, "a", 30),
                                     (3, "a", 40)]


@pytest.mark.parametrize("strategy", ["shuffle", "broadcast"])
def test_scd2_composite_key_mapping(spark, strategy):
    import datetime as dt
    dim = spark.createDataFrame(
        [(1, "a", 10, "Y", dt.date(2025, 1, 1), None)],
        "k1 int, k2 string, v int, cur_rec_ind string, start_ts date, end_ts date")
    batch = spark.createDataFrame([(1, "a", 11), (1, "z", 5)], "x int, y string, v int")
    out = scd2(dim, batch, {"k1": "x", "k2": "y"}, "2025-02-01", detect="columns",
               strategy=strategy)
    d1, d2 = dt.date(2025, 1, 1), dt.date(2025, 2, 1)
    assert sorted(out.collect(), key=str) == sorted([
        (1, "a", 10, "N", d1, d2), (1, "a", 11, "Y", d2, None), (1, "z", 5, "Y", d2, None)],
        key=str)


def test_hash_detection_compares_as_target_types(spark):
    import datetime as dt
    dim = spark.createDataFrame(
        [(1, 10.5, "Y", dt.date(2025, 1, 1), None)],
        "id bigint, amt double, cur_rec_ind string, start_ts date, end_ts date")
    batch = spark.createDataFrame([("1", "10.5")], "id string, amt string")  # untyped extract
    out = scd2(dim, batch, "id", "2025-02-01", detect="hash")
    assert out.count() == 1  # same values: nothing closes


def test_stored_hash_matches_a_reordered_batch(spark):
    import datetime as dt
    from keelson.operators import scd2_init
    base = spark.createDataFrame([(1, "ann", 30)], "id int, name string, age int")
    dim = scd2_init(base, "2025-01-01", hash_col="hash_key", start_col="start_ts",
                    end_col="end_ts")
    batch = spark.createDataFrame([(30, "ann", 1)], "age int, name string, id int")
    out = scd2(dim, batch, "id", "2025-02-01", hash_col="hash_key")
    assert out.count() == 1  # same row, other column order: unchanged
    assert out.first().start_ts == dt.date(2025, 1, 1)


def test_append_rows_types_and_rejects_unknown_columns(spark):
    from keelson.operators import append_rows
    t = spark.createDataFrame([(1, "a", 1.0)], "id int, v string, x double")
    out = append_rows(t, spark.createDataFrame([("2", "b")], "id string, v string"))
    assert out.schema == t.schema
    assert sorted(out.collect()) == [(1, "a", 1.0), (2, "b", None)]
    with pytest.raises(ValueError, match="not in target"):
        append_rows(t, spark.createDataFrame([(3, "z")], "id int, other string"))


def test_insert_new_respects_target_filter(spark):
    from keelson.operators import insert_new
    t = spark.createDataFrame([(1, "N", "old")], "id int, flag string, v string")
    s = spark.createDataFrame([(1, "N", "new"), (2, "Y", "two")], "id int, flag string, v string")
    # key 1 has no row passing the filter, so it is inserted as a new version
    out = insert_new(t, s, "id", target_filter=F.col("flag") == "Y")
    assert sorted(out.collect()) == [(1, "N", "new"), (1, "N", "old"), (2, "Y", "two")]
