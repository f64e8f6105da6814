"""Every registered query against its DuckDB oracle at sf0.001 (the driver
does the same at sf0.01)."""

import pytest

import __spark_entry__ as E
from listledger.plans.queries import QUERIES
from tools.oracle_check import check, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = check(spark, con, SF, name, E.queries()[name], E.oracle_sql().get(name))
    assert r["status"] in ("ok", "rows-only"), r
    assert not r["pair_join"], r   # no nested-loop or cartesian join anywhere


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["group_idx", "group_title", "new_offers", "total_candidates", "skipped"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())
