import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidebars.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "8")
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("tidebars.shared.dir", str(tmp_path_factory.mktemp("shared")))
    return session


@pytest.fixture
def small_chunks(spark):
    """The smallest chunks: every edge is met."""
    spark.conf.set("tidebars.chunk.rows", "256")
    yield
    spark.conf.unset("tidebars.chunk.rows")


@pytest.fixture
def make_bars(spark):
    """Bars from rows (symbol, hour, open, high, low, close, volume)."""

    def make(rows):
        start = dt.datetime(2024, 1, 1)
        data = [(s, start + dt.timedelta(hours=h), *map(float, p), int(v)) for s, h, *p, v in rows]
        return spark.createDataFrame(
            data,
            "symbol string, date_time timestamp_ntz, open double, high double, low double, close double, tick_vol bigint",
        )

    return make


@pytest.fixture
def walk(make_bars):
    """A random walk of ``n`` bars per symbol, as DataFrame."""
    import numpy as np

    def make(n, symbols=("a",), seed=1):
        rng = np.random.default_rng(seed)
        rows = []
        for s in symbols:
            close = 100 + np.cumsum(rng.normal(0, 1, n))
            for h, c in enumerate(close):
                up, down, o = rng.random(3)
                rows.append((s, h, c + o - 0.5, c + up + 0.5, c - down - 0.5, c, int(rng.integers(1, 100))))
        return make_bars(rows)

    return make
