"""Every registered query against its DuckDB oracle (rows as multisets,
columns by name). sf0.001 here for speed; ``python tests/oracle.py`` runs
the same comparison at sf0.01."""

import pytest

from tests.conftest import SF_SMALL
from tests.oracle import compare, duck


def _names():
    from __spark_entry__ import queries
    return sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, SF_SMALL, [name], con)[name]
    assert res.get("ok"), res


def test_every_oracle_has_a_query():
    from __spark_entry__ import oracle_sql, queries
    assert set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
                          "cur_rec_ind", "start_date", "end_date", "hash_key"]
