from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from feedlens.session import build_session, checkpoint_dir  # noqa: E402
from feedlens.sources.schema import FEED_SCHEMA, MESSAGE_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8, app_name="feedlens-tests")
    checkpoint_dir(s)
    yield s
    s.stop()


def T(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


@pytest.fixture
def make_feed(spark):
    """Rows: (user_id, time, action, exp_group, post_id, os, source, gender, age)."""
    def _make(rows):
        rows = [(r[0], T(r[1]) if isinstance(r[1], str) else r[1], *r[2:]) for r in rows]
        return spark.createDataFrame(rows, FEED_SCHEMA)
    return _make


@pytest.fixture
def make_msgs(spark):
    """Rows: (user_id, reciever_id, time)."""
    def _make(rows):
        rows = [(a, b, T(t) if isinstance(t, str) else t) for a, b, t in rows]
        return spark.createDataFrame(rows, MESSAGE_SCHEMA)
    return _make
