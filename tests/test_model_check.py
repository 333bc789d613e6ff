"""Randomised check of merge and SCD 2 against a row-by-row Python model of
MERGE (the way the golden tables were derived), plus pivot/unpivot."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keelson.operators import merge, pivot, scd2, unpivot

D0, D1 = dt.date(2025, 1, 1), dt.date(2025, 2, 1)
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

values = st.one_of(st.none(), st.integers(0, 3))
target_rows = st.dictionaries(st.integers(0, 8), values, max_size=7)
source_rows = st.dictionaries(st.integers(0, 8), values, max_size=7)


def model_upsert(target: dict, source: dict):
    out = dict(target)
    out.update(source)  # update set *, insert *
    return sorted(out.items(), key=str)


def model_scd2(current: dict, source: dict, detect: str):
    rows = []
    for k, v in current.items():
        if k in source and (detect == "always" or source[k] != v):
            rows += [(k, v, "N", D0, D1), (k, source[k], "Y", D1, None)]
        else:
            rows.append((k, v, "Y", D0, None))
    rows += [(k, v, "Y", D1, None) for k, v in source.items() if k not in current]
    return sorted(rows, key=str)


@SETTINGS
@given(target=target_rows, source=source_rows, strategy=st.sampled_from(["shuffle", "broadcast"]))
def test_upsert_matches_model(spark, target, source, strategy):
    t = spark.createDataFrame(list(target.items()), "id int, v int")
    s = spark.createDataFrame(list(source.items()), "id int, v int")
    out = merge(t, s, "id", update="*", insert="*", strategy=strategy)
    assert sorted(map(tuple, out.collect()), key=str) == model_upsert(target, source)


@SETTINGS
@given(target=target_rows, source=source_rows, detect=st.sampled_from(["hash", "columns", "always"]),
       strategy=st.sampled_from(["shuffle", "broadcast"]))
def test_scd2_matches_model(spark, target, source, detect, strategy):
    t = spark.createDataFrame([(k, v, "Y", D0, None) for k, v in target.items()],
                              "id int, v int, cur_rec_ind string, start_ts date, end_ts date")
    s = spark.createDataFrame(list(source.items()), "id int, v int")
    out = scd2(t, s, "id", D1, detect=detect, strategy=strategy)
    assert sorted(map(tuple, out.collect()), key=str) == model_scd2(target, source, detect)


def test_unpivot_of_pivot_is_grouped_sum(spark):
    from keelson.plans.inputs import table
    from tests.conftest import SF_SMALL
    c = table(spark, SF_SMALL, "customer")
    segs = [r[0] for r in c.select("c_mktsegment").distinct().collect()]
    p = pivot(c, ["c_nationkey"], "c_mktsegment", F.count(F.lit(1)), segs)
    back = unpivot(p, ["c_nationkey"], segs, "c_mktsegment", "n", include_nulls=False)
    grouped = c.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    assert sorted(back.collect()) == sorted(grouped.collect())
    # with NULL cells kept there is one row per (nation, segment)
    full = unpivot(p, ["c_nationkey"], segs, "c_mktsegment", "n")
    assert full.count() == p.count() * len(segs)
