import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from shopmart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "shopmart-tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def rows():
    """Sorted tuples of a frame."""
    return lambda frame: sorted((tuple(row) for row in frame.collect()), key=repr)


@pytest.fixture()
def plan(capsys):
    """Text of a frame's physical plan with the scan details."""

    def text(frame):
        capsys.readouterr()
        frame.explain("formatted")
        return capsys.readouterr().out

    return text


@pytest.fixture()
def session_conf(spark):
    """Sets a session option for one test."""
    before = {}

    def change(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
