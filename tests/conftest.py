from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyhouse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__python__sql__dataFrameDebugging__enabled="false",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as dicts, or as values of one column."""
    if len(columns) == 1:
        return [row[columns[0]] for row in df.collect()]
    return [row.asDict() for row in df.collect()]
