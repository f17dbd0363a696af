"""Every registered query against its SQL, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import compare, duck  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tidemark.plans.queries import REGISTRY  # noqa: E402

SF_DIR = os.environ.get("TIDEMARK_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_agrees_with_sql(spark, con, name):
    reason, _ = compare(spark, con, REGISTRY[name], SF_DIR)
    assert reason is None


def test_entry_points(spark):
    assert entry.entry(spark).columns[0] == "event_day"
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(REGISTRY) <= set(entry.queries())
