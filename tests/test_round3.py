"""Typed surrogate keys, nested fingerprints, joins by expression, hot keys,
chunked lists, single-pass backlogs, commits of two writers."""

import contextlib
import io
import math

import pytest
from pyspark.sql import functions as F

from keelson.functions.hashing import row_hash
from keelson.operators import (collect_chunks, hash_key_join, hot_keys, join_on, lay_out,
                               partition_profile, semi_join)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# -- typed surrogate keys ----------------------------------------------------

@pytest.mark.parametrize("left, right", [
    ("int", "double"), ("bigint", "decimal(12,3)"), ("decimal(9,2)", "decimal(12,5)"),
    ("float", "double"), ("date", "timestamp"), ("timestamp", "timestamp"), ("string", "string"),
    ("timestamp_ntz", "timestamp_ntz"), ("smallint", "bigint"), ("boolean", "boolean")])
def test_hash_key_join_equals_join_on_for_mixed_types(spark, left, right):
    numbers = ["0", "-0.0", "1", "2.50", "2.5", "-7", "16777217", None, "1e3"]
    times = ["2024-01-01", "2024-01-01 00:00:00", "2024-03-31 02:30:00.000001", None, "1969-12-31"]
    texts = ["a", "", "A", None, "1", "1.0", "true"]
    given = (times if "date" in left + right or "timestamp" in left else
             texts if left == "string" else ["true", "false", None] if left == "boolean" else numbers)
    text = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i int, k string")
    l = text.select(F.col("i").alias("li"), F.expr(f"try_cast(try_cast(k as {'double' if given is numbers and left != 'string' else left}) as {left})").alias("k"))
    r = text.select(F.col("i").alias("ri"), F.expr(f"try_cast(try_cast(k as {'double' if given is numbers and right != 'string' else right}) as {right})").alias("k2"))
    for how in ("inner", "left", "full", "left_anti"):
        ours = hash_key_join(l, r, {"k": "k2"}, how)
        plain = join_on(l, r, {"k": "k2"}, how)
        cols = [c for c in ("li", "ri") if c in plain.columns]
        assert rows(ours.select(*cols)) == rows(plain.select(*cols)), how


def test_hash_keys_do_not_follow_the_time_zone(spark):
    moments = spark.sql("select timestamp_micros(1700000000000000 + id * 3600000000) t from range(5)")
    zone = spark.conf.get("spark.sql.session.timeZone")
    found = []
    try:
        for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            found.append(rows(hash_key_join(moments, moments, ["t"]).select("hash_key")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found[0] == found[1] == found[2] and len(found[0]) == 5


# -- nested fingerprints -----------------------------------------------------

def test_nested_values_hash_alike_in_every_time_zone(spark):
    df = spark.sql("""
      select array(timestamp_micros(id * 1000000007), null) a,
             named_struct('t', timestamp_micros(id), 'in', array(named_struct('x', id / 3D))) s,
             map(timestamp_micros(id), id, timestamp_micros(7000000), 2L) m from range(1, 5)""")
    zone = spark.conf.get("spark.sql.session.timeZone")
    found = []
    try:
        for tz in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            found.append(rows(df.select(row_hash(["a", "s", "m"], df.schema))))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found[0] == found[1] and len(set(found[0])) == 4


def test_nested_values_that_differ_hash_apart(spark):
    values = ["array(0D)", "array(-0D)", "array()", "cast(null as array<double>)", "array(null)",
              "array(null, null)", "array(0D, null)", "array(double('NaN'))", "array(0.1D)"]
    h = {}
    for v in values:
        df = spark.sql(f"select cast({v} as array<double>) a")
        h[v] = df.select(row_hash(["a"], df.schema)).first()[0]
    assert h["array(0D)"] == h["array(-0D)"] and len(set(h.values())) == len(values) - 1
    texts = ["array('a|b')", "array('a', 'b')", "array('1:a')", "array('a')", "array('~')",
             "array('')", "array(array('a'), array('b'))", "array(array('a', 'b'))", "array('[1:a]')",
             "struct('a', 'b')", "struct('a|1:b')", "map('a', 'b')", "map('a', cast(null as string))"]
    found = []
    for v in texts:
        df = spark.sql(f"select {v} a")
        found.append(df.select(row_hash(["a"], df.schema)).first()[0])
    assert len(set(found)) == len(texts)
    two = spark.sql("select map('a', 1, 'b', 2) a union all select map('b', 2, 'a', 1)")
    assert len(set(rows(two.select(row_hash(["a"], two.schema))))) == 1


# -- joins by expression -----------------------------------------------------

def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("how", ["right", "full"])
def test_outer_joins_by_expression_equal_spark(spark, how):
    a = spark.createDataFrame([(1, "a", 5), (1, "b", 9), (2, "c", 0), (None, "n", 1), (7, "x", 2)],
                              "k int, lv string, x int")
    b = spark.createDataFrame([(1, "one", 7), (1, "uno", 1), (3, "three", 1), (None, "nil", 1)],
                              "rk int, rv string, y int")
    same = b.withColumnRenamed("rk", "k")
    cases = [(a, b, a.k == b.rk), (a, b, (a.k == b.rk) & (a.x > b.y)),
             (a, b, (a.k == b.rk) & (b.rv != "uno")), (a, b, a.k.eqNullSafe(b.rk)),
             (a, b, F.col("k") == F.col("rk")), (a, same, a.k == same.k),
             (a.alias("l"), same.alias("r"), F.col("l.k") == F.col("r.k"))]
    for left, right, on in cases:
        ours, plain = join_on(left, right, on, how), left.join(right, on, how)
        assert ours.columns == plain.columns and rows(ours) == rows(plain), on
        assert "FullOuter" not in plan(ours) and "RightOuter" not in plan(ours)


def test_semi_join_by_expression(spark):
    a = spark.createDataFrame([(1, 5), (1, 0), (2, 3), (None, 1)], "k int, x int")
    b = spark.createDataFrame([(1, 3)] * 9 + [(4, 1)], "rk int, y int")
    on = (a.k == b.rk) & (a.x > b.y)
    assert rows(semi_join(a, b, on)) == [(1, 5)]
    assert rows(semi_join(a, b, on, anti=True)) == rows(a.join(b, on, "left_anti"))
    assert "Aggregate" in plan(semi_join(a, b, on))


# -- hot keys ----------------------------------------------------------------

@pytest.mark.parametrize("n", [8, 40])
def test_hot_keys_are_dealt_and_cold_ones_stay(spark, n):
    df = spark.range(0, 60_000, numPartitions=7).withColumn(
        "k", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, F.lit(None))
        .otherwise((F.col("id") % 2003).cast("string")))
    rows_, hot = hot_keys(df, ["k"], 1 / n)
    assert rows_ == 60_000 and len(hot) == (2 if n == 40 else 1)  # NULL holds a tenth
    laid = lay_out(df, "hash", n, ["k"], salts="auto")
    assert laid.columns == ["id", "k"] and laid.rdd.getNumPartitions() == n
    sizes = [r.rows for r in partition_profile(laid).collect()]
    assert sum(sizes) == 60_000 and max(sizes) < 2 * 60_000 / n
    places = laid.withColumn("p", F.spark_partition_id()).groupBy("k").agg(F.countDistinct("p").alias("c"))
    found = {r.k: r.c for r in places.collect()}
    assert found["hot"] >= n // 3 and all(c == 1 for k, c in found.items() if k not in ("hot", None))


def test_counting_takes_over_where_the_sketch_is_too_small(spark, monkeypatch):
    from keelson.operators import layout
    df = spark.range(3000).withColumn("k", F.when(F.col("id") < 1000, -1).otherwise(F.col("id")))
    sketched = hot_keys(df, ["k"], 0.1)
    monkeypatch.setattr(layout, "SKETCH_ITEMS", 10)
    assert hot_keys(df, ["k"], 0.1) == sketched == (3000, {k: 1000 for k in sketched[1]})
    assert lay_out(df.limit(0), "hash", 4, ["k"], salts="auto").count() == 0


# -- chunked lists -----------------------------------------------------------

def brute_chunks(data, size, distinct=False):
    groups = {}
    for g, v in data:
        if v is not None:
            groups.setdefault(g, []).append(v)
    out = []
    for g, values in groups.items():
        values = sorted(set(values) if distinct else values)
        out += [(g, i // size, values[i:i + size]) for i in range(0, len(values), size)]
    return sorted(out, key=str)


@pytest.mark.parametrize("distinct", [False, True])
@pytest.mark.parametrize("size", [1, 7, 100, 100_000])
def test_chunks_are_the_list_in_pieces(spark, distinct, size):
    data = [(0, (i * 37) % 900) for i in range(2000)] + [(1, 5)] * 450 + [(1, 4), (2, None), (None, 3),
                                                                         (None, 1), (3, 9)]
    df = spark.createDataFrame(data, "g int, v int").repartition(5)
    assert rows(collect_chunks(df, ["g"], "v", size, distinct)) == brute_chunks(data, size, distinct)


def test_a_large_group_is_spread_over_tasks(spark):
    df = spark.range(30_000).withColumn("g", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    out = collect_chunks(df, ["g"], "id", 500)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        tasks = out.filter("g = 0").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set(key, old)
    assert out.filter("g = 0").count() == math.ceil(10_001 / 500) or tasks > 3
    assert tasks > 3


def test_chunks_of_nothing(spark):
    df = spark.createDataFrame([(1, None)], "g int, v int")
    assert collect_chunks(df, ["g"], "v", 10).collect() == []
    assert collect_chunks(df.limit(0), ["g"], "v", 10).columns == ["g", "chunk", "v_list"]


# -- a backlog of many days --------------------------------------------------

def test_a_backlog_is_read_once(spark, tmp_path):
    from keelson.operators import scd2, scd2_init
    from keelson.sources import read_snapshot, write_snapshot
    from keelson.streaming.incremental import stream_apply
    base, landing = str(tmp_path / "dim"), str(tmp_path / "in")
    first = spark.createDataFrame([(i, "a") for i in range(20)], "id int, v string")
    write_snapshot(scd2_init(first, "2025-01-01", hash_col="h"), base, 1)
    days = 6
    for d in range(days):
        spark.createDataFrame([(i, f"v{d}", f"2025-01-{d + 2:02d}") for i in range(20)],
                              "id int, v string, day string") \
            .selectExpr("id", "v", "cast(day as date) day").coalesce(1).write.mode("append").parquet(landing)
    query = stream_apply(
        spark, landing, "id int, v string, day date", base,
        lambda cur, batch, as_of: scd2(cur, batch, "id", as_of, hash_col="h"),
        keys=["id"], as_of_col="day", checkpoint=str(tmp_path / "cp"))
    query.awaitTermination(300)
    assert query.exception() is None
    assert sum(p["numInputRows"] for p in query.recentProgress) == 20 * days
    out = read_snapshot(spark, base)
    assert out.count() == 20 * (days + 1)
    assert {r.v for r in out.filter("cur_rec_ind = 'Y'").collect()} == {f"v{days - 1}"}


# -- two writers -------------------------------------------------------------

def test_the_second_commit_of_a_version_raises(spark, tmp_path, monkeypatch):
    from keelson.sources import publish_dimension, read_dimension, read_snapshot, tables, write_snapshot
    base, df = str(tmp_path / "t"), spark.createDataFrame([(1, "Y")], "id int, cur_rec_ind string")
    write_snapshot(df, base, 1)
    # both writers are past the check before either commits
    monkeypatch.setattr(tables, "_refuse_committed", lambda *a: None)
    write_snapshot(df, base, 2)
    with pytest.raises(RuntimeError, match="two writers"):
        write_snapshot(df, base, 2)
    with pytest.raises(RuntimeError, match="two writers"):
        read_snapshot(spark, base)
    assert read_snapshot(spark, base, 1).count() == 1
    store = str(tmp_path / "d")
    publish_dimension(df, store, 1)
    with pytest.raises(RuntimeError, match="two writers"):
        publish_dimension(df, store, 1)
    publish_dimension(df, store, 2)
    assert read_dimension(spark, store, current_only=True).count() == 1
    with pytest.raises(RuntimeError, match="two writers"):
        read_dimension(spark, store)
