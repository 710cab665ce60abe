"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import oracle
import pytest

import __spark_entry__ as registry
from tillpanel.plans.retail import retail_queries

TABLES_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(TABLES_DIR).is_dir(), reason="no order tables here")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(TABLES_DIR)


def test_every_query_has_its_sql():
    assert retail_queries().keys() <= registry.oracle_sql().keys()
    assert registry.oracle_sql().keys() <= registry.queries().keys()


@pytest.mark.parametrize("name", retail_queries())
def test_query_matches_sql(spark, con, name):
    frame = registry.queries()[name](spark, TABLES_DIR)
    assert oracle.differences(frame, con, registry.oracle_sql()[name]) is None


def test_entry_runs(spark):
    assert registry.entry(spark).count() > 0
