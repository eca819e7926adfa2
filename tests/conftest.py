import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from tendersift.session import build_session
    s = build_session("local[8]", 8, "tests", **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                                 "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def one(spark):
    """Value of a column expression, for a row given by keyword arguments."""
    def value(expr, **row):
        df = spark.createDataFrame([tuple(row.values()) or (1,)], list(row) or ["x"]) if not any(
            v is None for v in row.values()) else spark.createDataFrame(
            [tuple(row.values())], ", ".join(f"{k} string" for k in row))
        return df.select(expr.alias("v")).first()["v"]
    return value
