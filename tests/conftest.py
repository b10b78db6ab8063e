from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from granary.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """Joins as they run when neither side is small."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
