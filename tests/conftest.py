import sys
from datetime import datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from footfall.schema import FEED, MESSAGES
from footfall.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("scratch")
    session = local_session(
        4,
        app="footfall-tests",
        **{"spark.checkpoint.dir": str(scratch), "spark.sql.shuffle.partitions": "4"},
    )
    yield session
    session.stop()


PROFILE = {
    "age": 30, "os": "iOS", "gender": 1, "country": "X", "city": "X-1",
    "source": "ads", "exp_group": 1,
}


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


@pytest.fixture(scope="session")
def make_feed(spark):
    """Feed rows from ``(user, time, action)`` tuples, optionally with a dict of columns."""

    def build(rows):
        full = []
        for user, time, action, *rest in rows:
            extra = {**PROFILE, "post_id": 1, **(rest[0] if rest else {})}
            full.append(
                {"user_id": user, "time": at(time), "action": action, **extra}
            )
        return spark.createDataFrame([tuple(r[f.name] for f in FEED) for r in full], FEED)

    return build


@pytest.fixture(scope="session")
def make_messages(spark):
    """Message rows from ``(sender, receiver, time)`` tuples."""

    def build(rows):
        full = []
        for sender, receiver, time, *rest in rows:
            extra = {**PROFILE, **(rest[0] if rest else {})}
            full.append({"user_id": sender, "receiver_id": receiver, "time": at(time), **extra})
        return spark.createDataFrame([tuple(r[f.name] for f in MESSAGES) for r in full], MESSAGES)

    return build


def rows(df, *columns):
    """Sorted tuples of the given columns, with dates and times as text."""
    picked = df.select(*columns) if columns else df
    out = [tuple(v.isoformat() if hasattr(v, "isoformat") else v for v in r) for r in picked.collect()]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))
