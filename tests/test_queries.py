"""Every registered query at the smallest scale, next to its SQL."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import compare as C  # noqa: E402
from __spark_entry__ import LLM_QUERIES, entry, oracle_sql, queries  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return C.oracle(SF)


@pytest.mark.parametrize("name", [n for n in queries() if n not in LLM_QUERIES])
def test_query(spark, con, name):
    sql = oracle_sql().get(name)
    ok, message = C.compare(spark, con, name, queries()[name], sql, SF)
    assert ok, message


def test_entry(spark):
    assert entry(spark).count() > 0
