from __future__ import annotations

import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark.schemas import BARS, Thresholds  # noqa: E402
from tidemark.session import local_session  # noqa: E402

SMALL = Thresholds(
    drawdown_threshold_pct=0.20,
    drawdown_window_days=3,
    gap_threshold_pct=0.05,
    volume_spike_zscore=2.0,
    volume_spike_window_days=3,
)
RUN_DATE = date(2024, 2, 1)


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, "4g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_bars(spark):
    """Bars of one ticker from (day of January 2024, open, close, volume[, adj_close])."""

    def make(rows, ticker="AAPL"):
        out = []
        for day, opened, close, volume, *adj in rows:
            known = [v for v in (opened, close) if v is not None]
            high, low = (max(known), min(known)) if known else (None, None)
            adj_close = adj[0] if adj else close
            out.append((ticker, date(2024, 1, day), opened, high, low, close, volume, adj_close))
        return spark.createDataFrame(out, BARS)

    return make


def rows(df, *columns):
    """The rows as sorted tuples, of the given columns if any."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
