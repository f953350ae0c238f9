import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from shoplens.session import create_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = create_session(
        "shoplens-tests",
        master="local[8]",
        config={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
        log_level="ERROR",
    )
    yield session
    session.stop()


def rows(df):
    """The rows of a small result as tuples, in order."""
    return [tuple(row) for row in df.collect()]


def plan(df):
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
