"""Every registered query against its DuckDB oracle (the driver's gate, run locally at sf0.001;
set STAFFRANK_TEST_SF to use another scale). Rows-only queries must run and return rows."""

import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE
from oracle_harness import compare, duck

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_named_and_flagship_has_oracle():
    assert "i5_target_metric" in ORACLES
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) >= 100


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_ORACLE, QUERIES[name], ORACLES.get(name), con)
    assert r["status"] in ("match", "rows-only"), r
    if r["status"] == "rows-only":
        assert r["spark_rows"] > 0


def test_entry(spark):
    rows = E.entry(spark).collect()
    assert len(rows) == 1 and 0.0 <= rows[0].target_metric <= 1.0
    assert rows[0].target_metric == pytest.approx(0.5847355769230769, abs=1e-6)
