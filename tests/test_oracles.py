"""Every named query against DuckDB on the benchmark tables."""

from pathlib import Path

import oracle_compare as oc
import pytest

import __spark_entry__ as entry_module
from weirgauge.plans.oracles import ORACLES
from weirgauge.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def con():
    return oc.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_duckdb(spark, con, name):
    assert oc.differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == ""


def test_entry(spark):
    assert entry_module.entry(spark).count() == 11
