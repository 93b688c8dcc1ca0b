import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from andenlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def smoke():
    return "/root/testdata/sf0.001"


def rows(df):
    """Rows as plain tuples, in a stable order."""
    return sorted((tuple(r) for r in df.collect()),
                  key=lambda r: tuple((v is None, str(v)) for v in r))
