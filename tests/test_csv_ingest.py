"""Bad-record handling (FIXTURES.md §3): the verdict must not depend on which
columns the query reads — ``count()``, a one-column select and a full read
all see the same good rows."""

import os

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from keelson.sources import conform, enforce, read_csv, split_quarantine

LINES = ["1,x,2", "z,y,3", "3", "4,w,5,extra", "5,v,q", "6,u,7"]
SCHEMA = "A int, B string, C int"
GOOD = [(1, "x", 2), (6, "u", 7)]


@pytest.fixture
def bad_csv(scratch):
    path = os.path.join(scratch, "bad.csv")
    with open(path, "w") as f:
        f.write("\n".join(LINES) + "\n")
    return path


@pytest.fixture
def header_csv(scratch):
    path = os.path.join(scratch, "head.csv")
    with open(path, "w") as f:
        f.write("A,B,C\n" + "\n".join(LINES) + "\n")
    return path


def test_quarantine_full_count_and_narrow(spark, bad_csv):
    good, bad = split_quarantine(read_csv(spark, bad_csv, SCHEMA, on_bad="quarantine"))
    assert sorted(good.collect()) == GOOD
    assert good.count() == 2
    assert good.select("B").count() == 2
    assert sorted(r[0] for r in good.select("B").collect()) == ["u", "x"]
    assert sorted(r.raw_line for r in bad.collect()) == sorted(
        ["z,y,3", "3", "4,w,5,extra", "5,v,q"])
    assert bad.count() == 4


def test_drop_malformed_count_and_narrow(spark, bad_csv):
    df = read_csv(spark, bad_csv, SCHEMA, on_bad="drop")
    assert df.count() == 2
    assert df.select("A").count() == 2
    assert sorted(df.collect()) == GOOD


def test_failfast_raises_even_under_count(spark, bad_csv):
    df = read_csv(spark, bad_csv, SCHEMA, on_bad="fail")
    with pytest.raises((Py4JJavaError, PySparkException)):
        df.count()
    with pytest.raises((Py4JJavaError, PySparkException)):
        df.select("B").collect()


def test_permissive_nulls_keeps_rows(spark, bad_csv):
    df = read_csv(spark, bad_csv, SCHEMA, on_bad="null")
    out = sorted(df.collect(), key=str)
    assert len(out) == 6
    assert (None, "y", 3) in [tuple(r) for r in out]
    assert (3, None, None) in [tuple(r) for r in out]


def test_header_all_strings(spark, header_csv):
    df = read_csv(spark, header_csv, header=True, on_bad="null")
    assert df.columns == ["A", "B", "C"]
    assert all(f.dataType.simpleString() == "string" for f in df.schema.fields)
    assert df.count() == 6


def test_infer_schema_turns_bad_column_to_text(spark, header_csv):
    df = read_csv(spark, header_csv, header=True, infer_schema=True, on_bad="null")
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert types["A"] == "string"  # 'z' in column A


def test_header_with_schema(spark, header_csv):
    good, bad = split_quarantine(read_csv(spark, header_csv, SCHEMA, header=True))
    assert sorted(good.collect()) == GOOD
    assert bad.count() == 4


def test_schema_contract_modes(spark):
    raw = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c"), ("4", None)],
                                "id string, name string")
    contract = "id int not null, name string"
    good, bad = enforce(raw, contract, on_violation="quarantine")
    assert sorted(good.collect()) == [(1, "a"), (4, None)]
    assert sorted((r.name, r._violations) for r in bad.collect()) == [("b", ["id"]), ("c", ["id"])]
    assert enforce(raw, contract, on_violation="drop").count() == 2
    with pytest.raises((Py4JJavaError, PySparkException)):
        enforce(raw, contract, on_violation="fail").collect()
    c = conform(raw, contract)
    assert c.columns == ["id", "name", "_violations"]


def test_stage_parsed_splits_without_reparsing(spark, bad_csv, scratch):
    from keelson.sources import stage_parsed
    staged = stage_parsed(read_csv(spark, bad_csv, SCHEMA, on_bad="quarantine"),
                          os.path.join(scratch, "staged"))
    good, bad = split_quarantine(staged)
    assert sorted(good.collect()) == GOOD
    assert bad.count() == 4
    assert good.select("B").count() == 2


def test_ingest_once_writes_both_sides(spark, bad_csv, scratch):
    from keelson.sources import ingest_csv, read_ingested
    dest = ingest_csv(spark, bad_csv, SCHEMA, os.path.join(scratch, "ingested"))
    assert sorted(read_ingested(spark, dest).collect()) == GOOD
    assert sorted(r.raw_line for r in read_ingested(spark, dest, bad=True).collect()) == sorted(
        ["z,y,3", "3", "4,w,5,extra", "5,v,q"])
    assert read_ingested(spark, dest).columns == ["A", "B", "C"]


def test_quarantine_without_a_schema(spark, tmp_path):
    path = str(tmp_path / "feed.csv")
    with open(path, "w") as f:
        f.write("id,name\n1,ann\n2,bob,extra\n3,cy\n")
    for infer in (False, True):
        good, bad = split_quarantine(read_csv(spark, path, header=True, infer_schema=infer))
        assert sorted(str(r.id) for r in good.collect()) == ["1", "3"]
        assert [r.raw_line for r in bad.collect()] == ["2,bob,extra"]
