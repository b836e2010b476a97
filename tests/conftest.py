import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from fettle.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    """Eight shuffle partitions that stay eight, so that range borders fall into small data.

    Tasks may fail twice before a job does, for the tests of retries.
    """
    session = build_session(
        "fettle-tests", "local[4,3]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
