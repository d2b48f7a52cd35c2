import datetime as dt

import pytest

from scholarmart.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


def utc(*parts):
    return dt.datetime(*parts, tzinfo=dt.timezone.utc)
