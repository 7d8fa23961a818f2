import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortspark.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests",
        "local[8]",
        spark_sql_shuffle_partitions="4",
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Rows as tuples, sorted by text so that NULLs compare."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple(str(v) for v in t))
