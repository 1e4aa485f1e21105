import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from roomtide.runtime import build_session  # noqa: E402
from roomtide.schemas import ENVELOPE  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def envelope(spark):
    """Rows (streamer, category, archetype, event_type, received_at, data) as an envelope."""
    return lambda *rows: spark.createDataFrame(list(rows), ENVELOPE)


def event(kind, data, streamer="s1", category="npc", archetype="pure_robotic", at="2024-01-01T00:00:00.123456+00:00"):
    return (streamer, category, archetype, kind, at, data)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
