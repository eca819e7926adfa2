import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent.parent
sys.path[:0] = [str(ROOT), str(Path(__file__).resolve().parent)]
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not Path(SF).exists():
        pytest.skip("test tables not present")
    return SF


@pytest.fixture
def table(spark):
    """A documents table from (doc_id, text) pairs, with an extra column of a clashing name."""
    def make(rows, schema="doc_id long, text string, score string, fp string"):
        return spark.createDataFrame([(*r, "x", None) for r in rows], schema)
    return make
