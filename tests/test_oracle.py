"""Every query with an oracle matches DuckDB on the smallest fixture scale
(the driver repeats this at sf0.01)."""
import pytest

import __spark_entry__ as E
import tools.oracle_check as OC
from tools.oracle_check import compare, duck_conn

OC.STRICT = True  # doubles compared at full precision

from conftest import SF_SMALL

ORACLE = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck_conn(SF_SMALL)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, con, name):
    res = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert res["status"] == "match", res


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert [r.metric for r in rows] == ["Top Category", "Peak Hour", "Conversion Rate", "Top City",
                                        "Total Orders", "Total Revenue"]
