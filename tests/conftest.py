from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cartwright.operators.hot import HotKeys
from cartwright.session import build_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        4,
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


# Nearly every key with several rows counts as hot, so small data takes the
# paths meant for skewed tables.
EAGER = HotKeys(share=0.05)
NEVER = HotKeys(share=100)


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def rows(df, *order) -> list[tuple]:
    """The frame's rows as tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(str(v) for v in r))


def plan(df) -> str:
    """The executed plan; after an action it is the final adaptive one."""
    return df._jdf.queryExecution().executedPlan().toString()
