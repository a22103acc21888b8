import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lakeops.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]",
        "lakeops-tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.autoBroadcastJoinThreshold": "10MB",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def rows():
    """Rows as a sorted list of tuples, for comparing frames as bags."""

    def sort(df, columns=None):
        picked = df.select(columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return sort
