import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
                            spark__driver__memory="8g", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def days(count, start=dt.date(2025, 1, 1)):
    return [start + dt.timedelta(days=i) for i in range(count)]


BAR_DDL = ("security_id string, date date, open double, high double, low double, close double, volume double, "
           "adjustment_as_of date")


def bar(day, close, sid="US-000001", anchor=dt.date(2026, 1, 1), **fields):
    row = dict(open=float(close), high=close + 1.0, low=close - 1.0, close=float(close), volume=100.0)
    row.update(fields)
    return (sid, day, row["open"], row["high"], row["low"], row["close"], row["volume"], anchor)


def bars_frame(spark, rows):
    return spark.createDataFrame(rows, BAR_DDL)
