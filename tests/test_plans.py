"""Plan assertions: what Catalyst does with our operators."""

from pyspark.sql import functions as F

from keelson.operators import union_all
from keelson.plans.inputs import AS_OF, customer_refresh, table
from keelson.plans.q_merge import _scd2, customer_dimension
from keelson.plans.q_relational import b1_b6_filter_project, b7_b8_compare_and, d8_pivot_sum
from tests.conftest import SF_SMALL


def formatted(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_union_is_narrow(spark):
    c = table(spark, SF_SMALL, "customer").select("c_custkey", "c_name")
    s = table(spark, SF_SMALL, "supplier").select("s_suppkey", "s_name")
    assert "Exchange" not in formatted(union_all(c, s))


def test_filter_pushed_and_columns_pruned(spark):
    text = formatted(b1_b6_filter_project(spark, SF_SMALL))
    assert "EqualTo(c_mktsegment,BUILDING)" in text
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_mktsegment:string>" in text
    text = formatted(b7_b8_compare_and(spark, SF_SMALL))
    assert "GreaterThan(value,40.0)" in text


def test_broadcast_strategy_does_not_shuffle_the_target(spark):
    out = _scd2(customer_dimension(spark, SF_SMALL), customer_refresh(spark, SF_SMALL), AS_OF,
                strategy="broadcast")
    text = formatted(out)
    assert "BroadcastHashJoin" in text
    # only the small source is dealt by key (its check), and the distinct matched keys
    exchanges = [line for line in text.splitlines() if "hashpartitioning(" in line]
    assert exchanges and all("s__c_custkey" in line or "ht__c_custkey" in line
                             for line in exchanges)
    assert "SortMergeJoin" not in text


def test_shuffle_plan_can_split_hot_target_keys(spark):
    out = _scd2(customer_dimension(spark, SF_SMALL), customer_refresh(spark, SF_SMALL), AS_OF,
                strategy="shuffle")
    text = formatted(out)
    joins = {line.split(":")[1].strip() for line in text.splitlines() if "Join type:" in line}
    assert {"LeftOuter", "LeftAnti"} <= joins and "FullOuter" not in joins
    assert "BroadcastHashJoin" not in text.split("Subqueries")[0]


def test_building_a_merge_runs_no_job(spark):
    from keelson.operators import merge
    sc = spark.sparkContext
    customer, orders = table(spark, SF_SMALL, "customer"), table(spark, SF_SMALL, "orders")
    dim, batch = customer_dimension(spark, SF_SMALL), customer_refresh(spark, SF_SMALL)
    sc.setJobGroup("build-only", "plans")
    try:
        plans = [_scd2(dim, batch, AS_OF),
                 merge(customer, batch, "c_custkey", update="*", insert="*"),
                 merge(orders, orders, "o_orderkey", update={"o_orderstatus": "source.o_orderstatus"})]
        assert len(sc.statusTracker().getJobIdsForGroup("build-only")) == 0
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert all(p.columns for p in plans)


def test_hot_target_key_is_split(spark):
    # nine tenths of the target share one key: the left join's partition is split
    from keelson.operators import merge
    rows = [(0 if i % 10 else i, i, "x" * 20) for i in range(40_000)]
    target = spark.createDataFrame(rows, "k int, n int, v string").repartition(8)
    source = spark.createDataFrame([(i, "y") for i in range(0, 40_000, 10)], "k int, v string")
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = merge(target, source, "k", update={"v": "source.v"}, strategy="shuffle")
        assert out.filter("v = 'y'").count() == 40_000
        out.collect()
        text = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "skewed" in text or "skew=true" in text


def test_insert_only_merge_does_not_join_the_target(spark):
    from keelson.operators import insert_new
    out = insert_new(table(spark, SF_SMALL, "customer"), customer_refresh(spark, SF_SMALL), "c_custkey")
    joins = [line for line in formatted(out).splitlines() if "Join type:" in line]
    assert joins and all("LeftAnti" in j or "Inner" in j for j in joins)


def test_pivot_with_values_needs_no_distinct_job(spark):
    text = formatted(d8_pivot_sum(spark, SF_SMALL))
    assert "pivotfirst" in text.lower() or "HashAggregate" in text


def test_grouped_aggregate_is_two_phase(spark):
    df = table(spark, SF_SMALL, "customer").groupBy("c_nationkey").agg(F.sum("c_acctbal"))
    text = formatted(df)
    assert "partial_sum" in text


def test_semi_join_reduces_right_side_to_distinct_keys(spark):
    from keelson.operators import semi_join
    c, o = table(spark, SF_SMALL, "customer"), table(spark, SF_SMALL, "orders")
    text = formatted(semi_join(c, o, {"c_custkey": "o_custkey"}))
    # a partial aggregate over the right keys runs before any exchange
    assert "HashAggregate" in text and "LeftSemi" in text


def test_sort_spreads_a_hot_key(spark):
    from keelson.operators import partition_profile, sort_by
    rows = [(0, i) for i in range(6000)] + [(k, k) for k in range(1, 12001)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(8)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")  # keep the 8 range partitions visible at this tiny size
    try:
        out = sort_by(df, ["k"])
        sizes = [r.rows for r in partition_profile(out).collect()]
        plain = [r.rows for r in partition_profile(sort_by(df, ["k"], spread_ties=False)).collect()]
        ks = [r.k for r in out.collect()]
    finally:
        spark.conf.set(key, old)
    assert max(plain) >= 6000       # without spreading, the hot key is one partition
    assert max(sizes) < 6000        # with it, the hot key is split across range partitions
    assert ks == sorted(ks)


def test_bucketed_dimension_is_not_shuffled(spark):
    from keelson.sources import save_table
    save_table(customer_dimension(spark, SF_SMALL), "kt_dim_bucketed", mode="overwrite",
               buckets=(8, ["c_custkey"]))
    out = _scd2(spark.table("kt_dim_bucketed"), customer_refresh(spark, SF_SMALL), AS_OF,
                strategy="shuffle")
    text = formatted(out)
    assert "Bucketed: true" in text
    exchanges = [line for line in text.splitlines() if "hashpartitioning(" in line]
    assert exchanges and not any("t__c_custkey" in line for line in exchanges)
    assert sorted(out.collect()) == sorted(
        _scd2(customer_dimension(spark, SF_SMALL), customer_refresh(spark, SF_SMALL), AS_OF,
              strategy="shuffle").collect())


def test_outer_join_by_name_equals_spark(spark):
    from keelson.operators import join_on
    big = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "n"), (7, "x")],
                                "K int, lv string")
    small = spark.createDataFrame([(1, "one"), (3, "three"), (None, "nil")], "k int, rv string")
    small2 = small.withColumnRenamed("k", "rk")
    for how in ("right", "full"):
        ours, plain = join_on(big, small, "k", how), big.join(small, "k", how)
        assert [c.lower() for c in ours.columns] == [c.lower() for c in plain.columns]
        assert sorted(map(tuple, ours.collect()), key=str) == sorted(
            map(tuple, plain.collect()), key=str)
        ours = join_on(big, small2, {"k": "RK"}, how)
        plain = big.join(small2, big.K == small2.rk, how)
        assert ours.columns == plain.columns
        assert sorted(map(tuple, ours.collect()), key=str) == sorted(
            map(tuple, plain.collect()), key=str)
    assert "FullOuter" not in formatted(join_on(big, small, "k", "full"))


def test_collect_values_matches_collect_list(spark):
    from keelson.operators import collect_values
    rows = [(0, v % 3) for v in range(3000)] + [(1, None), (2, 5), (2, 5), (3, None)]
    df = spark.createDataFrame(rows, "g int, v int").repartition(8)
    ours = {r.g: r.v_list for r in collect_values(df, ["g"], "v").collect()}
    ref = {r.g: r.l for r in df.groupBy("g").agg(F.sort_array(F.collect_list("v")).alias("l"))
           .collect()}
    assert ours == ref
    sets = {r.g: r.v_set for r in collect_values(df, ["g"], "v", distinct=True).collect()}
    assert sets == {0: [0, 1, 2], 1: [], 2: [5], 3: []}


def test_broadcast_only_within_the_proven_bound(spark):
    dim, src = customer_dimension(spark, SF_SMALL), customer_refresh(spark, SF_SMALL)
    rows, auto = "keelson.broadcast.maxRows", "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(auto)
    try:
        spark.conf.set(auto, "-1")
        spark.conf.set(rows, "10")    # the batch has more rows than this: no broadcast
        assert "BroadcastHashJoin" not in formatted(_scd2(dim, src, AS_OF, strategy="broadcast"))
        spark.conf.unset(rows)
        out = _scd2(dim, src, AS_OF, strategy="broadcast")
        assert "BroadcastHashJoin" in formatted(out)
        assert sorted(out.collect()) == sorted(_scd2(dim, src, AS_OF).collect())
    finally:
        spark.conf.unset(rows)
        spark.conf.set(auto, old)


def test_high_water_filter_reaches_the_scan(spark):
    from keelson.sources import new_rows
    orders = table(spark, SF_SMALL, "orders")
    loaded = orders.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    batch = new_rows(orders, loaded, "o_orderdate")
    assert "GreaterThan(o_orderdate," in formatted(batch)
    lazy = new_rows(orders, loaded, "o_orderdate", lazy=True)
    assert sorted(batch.collect()) == sorted(lazy.collect())
    assert new_rows(orders, orders.limit(0), "o_orderdate").count() == orders.count()


def test_stored_dimension_scans_push_their_filters(spark, tmp_path):
    from keelson.sources import publish_dimension, read_dimension
    base = str(tmp_path / "dim")
    publish_dimension(customer_dimension(spark, SF_SMALL), base, 1)
    out = _scd2(read_dimension(spark, base, current_only=True), customer_refresh(spark, SF_SMALL),
                AS_OF, strategy="shuffle")
    text = formatted(out)
    assert "EqualTo(cur_rec_ind,Y)" in text                 # current rows
    assert "Not(EqualTo(cur_rec_ind,Y))" in text            # history bypass: skipped by stats
