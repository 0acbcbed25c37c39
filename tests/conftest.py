from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from affinia.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# Worked on paper: n = (2, 3, 2), squared norms (41, 29, 26), 3 users.
ROWS = [(1, "a", 5.0), (1, "b", 3.0), (2, "a", 4.0), (2, "b", 2.0), (2, "c", 1.0), (3, "b", 4.0), (3, "c", 5.0)]


@pytest.fixture(scope="session")
def prefs(spark):
    return spark.createDataFrame(ROWS, "user bigint, item string, pref double")


# One user holds a third of the rows, one item appears with nearly every user.
HOT = (
    [(0, i, float(1 + i % 5)) for i in range(60)]
    + [(u, 0, 2.0) for u in range(1, 41)]
    + [(u, 1 + (u * k) % 59, float(1 + (u + k) % 4)) for u in range(1, 41) for k in (1, 2)]
)
HOT = sorted({(u, i): (u, i, p) for u, i, p in HOT}.values())


@pytest.fixture(scope="session")
def hot(spark):
    return spark.createDataFrame(HOT, "user bigint, item bigint, pref double").repartition(4)


def rows(df, *order):
    return sorted(tuple(r) for r in df.select(*order).collect())
