from __future__ import annotations

import random
from dataclasses import replace
from datetime import date, timedelta

import pytest
from conftest import RUN_DATE, SMALL, rows
from pyspark.sql import functions as F

from tidemark.operators import detectors
from tidemark.operators.series import split_series
from tidemark.schemas import BARS, DERIVED_TYPES, EVENT_COLUMNS, EVENTS, Thresholds

FIVE_BARS = [
    (1, 100.0, 100.0, 100),
    (2, 100.0, 105.0, 110),
    (3, 100.0, 100.0, 90),
    (4, 106.0, 80.0, 100),
    (5, 79.0, 79.0, 500),
]


def jan(day):
    return date(2024, 1, day)


def test_drawdowns_give_the_fall_and_the_peak_date(make_bars):
    found = detectors.drawdowns(make_bars(FIVE_BARS), SMALL, RUN_DATE)
    assert found.columns == EVENT_COLUMNS["drawdowns"]
    assert rows(found, "ticker", "date", "peak_date", "created_at") == [
        ("AAPL", jan(4), jan(2), RUN_DATE),
        ("AAPL", jan(5), jan(3), RUN_DATE),
    ]
    falls = [r[0] for r in rows(found, "drawdown_pct")]
    assert falls == pytest.approx([-0.21, -25 / 105])


def test_gaps_compare_the_open_with_the_previous_close(make_bars):
    found = detectors.gaps(make_bars(FIVE_BARS), SMALL, RUN_DATE)
    assert found.columns == EVENT_COLUMNS["gaps"]
    (gap,) = found.collect()
    assert (gap.date, gap.prior_close, gap.open) == (jan(4), 100.0, 106.0)
    assert gap.gap_pct == pytest.approx(0.06)


def test_volume_spikes_compare_with_the_rows_before(make_bars):
    found = detectors.volume_spikes(make_bars(FIVE_BARS), SMALL, RUN_DATE)
    assert found.columns == EVENT_COLUMNS["volume_spikes"]
    (spike,) = found.collect()
    assert (spike.date, spike.volume, spike.window_days) == (jan(5), 500, 3)
    assert (spike.trailing_mean, spike.trailing_std, spike.volume_zscore) == pytest.approx((100, 10, 40))


def test_peak_on_a_tie_is_the_earliest_row(make_bars):
    bars = make_bars([(1, 100.0, 100.0, 1), (2, 100.0, 100.0, 1), (3, 70.0, 70.0, 1)])
    assert rows(detectors.drawdowns(bars, SMALL, RUN_DATE), "date", "peak_date") == [(jan(3), jan(1))]


@pytest.mark.parametrize("gone", [None, float("nan")])
def test_a_missing_price_is_no_peak_and_no_event(make_bars, gone):
    from tidemark.operators.bars import clean_bars

    bars = clean_bars(make_bars([(1, 100.0, 100.0, 1), (2, 1.0, 1.0, 1, gone), (3, 70.0, 70.0, 1)]))
    assert rows(detectors.drawdowns(bars, SMALL, RUN_DATE), "date", "peak_date") == [(jan(3), jan(1))]


def test_thresholds_compare_exact_doubles(make_bars):
    # 80/100 - 1 lies just above -0.20; 105/100 - 1 lies just above 0.05.
    bars = make_bars([(1, 100.0, 100.0, 1), (2, 105.0, 80.0, 1)])
    assert rows(detectors.drawdowns(bars, SMALL, RUN_DATE)) == []
    assert rows(detectors.gaps(bars, SMALL, RUN_DATE), "date") == [(jan(2),)]


def test_gap_over_a_zero_close_is_infinite(make_bars):
    bars = make_bars([(1, 1.0, 0.0, 1), (2, 5.0, 0.0, 1), (3, 0.0, 1.0, 1)])
    assert rows(detectors.gaps(bars, SMALL, RUN_DATE), "date", "gap_pct") == [(jan(2), float("inf"))]


def test_gap_needs_both_prices(make_bars):
    bars = make_bars([(1, 1.0, None, 1), (2, 5.0, 5.0, 1), (3, None, 9.0, 1)])
    assert rows(detectors.gaps(bars, SMALL, RUN_DATE)) == []


def test_constant_volume_never_spikes(make_bars):
    bars = make_bars([(d, 1.0, 1.0, 100) for d in range(1, 5)] + [(5, 1.0, 1.0, 10_000)])
    assert rows(detectors.volume_spikes(bars, SMALL, RUN_DATE)) == []


def test_spike_needs_the_full_number_of_rows_before(make_bars):
    bars = make_bars([(1, 1.0, 1.0, 100), (2, 1.0, 1.0, 110), (3, 1.0, 1.0, 10_000)])
    assert rows(detectors.volume_spikes(bars, SMALL, RUN_DATE)) == []


def test_only_high_volume_spikes(make_bars):
    bars = make_bars([(1, 1.0, 1.0, 900), (2, 1.0, 1.0, 1000), (3, 1.0, 1.0, 1100), (4, 1.0, 1.0, 1)])
    assert rows(detectors.volume_spikes(bars, SMALL, RUN_DATE)) == []


def test_series_do_not_mix(make_bars):
    both = make_bars([(1, 100.0, 100.0, 1)], "A").union(make_bars([(2, 10.0, 10.0, 1)], "B"))
    assert rows(detectors.detect_events(both, SMALL, RUN_DATE)) == []


def random_bars(spark, n, seed, ticker="LONG", every=5):
    """A series with holes, ties, missing prices and zero closes."""
    rng = random.Random(seed)
    day, out = date(2000, 1, 1), []
    for _ in range(n):
        day += timedelta(days=rng.choice([1, 1, 1, 2, 3, 90 if rng.random() < 0.02 else 1]))
        close = rng.choice([None, 0.0, *map(float, range(50, 150, every))])
        opened = rng.choice([None, *map(float, range(50, 150, every))])
        adj = rng.choice([None, *map(float, range(50, 150, every))])
        volume = rng.choice([100, 110, 120, 130, 5000])
        out.append((ticker, day, opened, opened, opened, close, volume, adj))
    return out


def brute_force(bars, t):
    """Events as plain loops over one sorted series find them."""
    found = []
    bars = sorted(bars, key=lambda b: b[1])
    for i, (ticker, day, opened, _, _, close, volume, adj) in enumerate(bars):
        window = [(b[7], b[1]) for b in bars[max(0, i - t.drawdown_window_days + 1) : i + 1] if b[7] is not None]
        if window and adj is not None:
            peak = max(p for p, _ in window)
            if adj / peak - 1 <= -t.drawdown_threshold_pct:
                found.append(("drawdowns", ticker, day, min(d for p, d in window if p == peak)))
        prior = bars[i - 1][5] if i else None
        if prior is not None and opened is not None:
            gap = opened / prior - 1 if prior else (float("inf") if opened > 0 else None)
            if gap is not None and abs(gap) >= t.gap_threshold_pct:
                found.append(("gaps", ticker, day, None))
        before = [b[6] for b in bars[max(0, i - t.volume_spike_window_days) : i]]
        if len(before) == t.volume_spike_window_days:
            mean = sum(before) / len(before)
            std = (sum((v - mean) ** 2 for v in before) / (len(before) - 1)) ** 0.5
            if std > 0 and (volume - mean) / std >= t.volume_spike_zscore:
                found.append(("volume_spikes", ticker, day, None))
    return sorted(found, key=repr)


@pytest.mark.parametrize("split_rows", [None, 20, 64])
def test_detectors_agree_with_brute_force(spark, split_rows):
    t = Thresholds(0.3, 9, 0.25, 1.5, 7)
    long, short = random_bars(spark, 400, 1), random_bars(spark, 5, 2, "SHORT")
    bars = spark.createDataFrame(long + short, BARS)
    found = detectors.detect_events(bars, t, RUN_DATE, split_rows)
    assert found.schema.names == EVENTS.names
    assert rows(found, "event_type", "ticker", "date", "peak_date") == sorted(
        brute_force(long, t) + brute_force(short, t), key=repr
    )


def test_one_pass_equals_the_single_detectors(spark):
    t = Thresholds(0.3, 9, 0.25, 1.5, 7)
    bars = spark.createDataFrame(random_bars(spark, 200, 3), BARS)
    together = detectors.detect_events(bars, t, RUN_DATE)
    for event_type in DERIVED_TYPES:
        alone = getattr(detectors, event_type)(bars, t, RUN_DATE)
        columns = EVENT_COLUMNS[event_type]
        assert rows(together.filter(F.col("event_type") == event_type), *columns) == rows(alone)


def test_split_series_gives_every_row_one_home_and_its_look_back(spark):
    bars = spark.createDataFrame(random_bars(spark, 300, 4), BARS)
    cut = split_series(bars, 9, 40).select("chunk", "date", "borrowed").collect()
    own = [(r.chunk, r.date) for r in cut if not r.borrowed]
    assert sorted(d for _, d in own) == sorted(r.date for r in bars.collect())
    chunks = sorted({c for c, _ in own})
    assert len(chunks) > 3
    all_dates = sorted(d for _, d in own)
    for chunk in chunks:
        first = min(d for c, d in own if c == chunk)
        needed = all_dates[max(0, all_dates.index(first) - 9) : all_dates.index(first)]
        assert set(needed) <= {r.date for r in cut if r.chunk == chunk and r.borrowed}


def test_split_series_refuses_chunks_below_the_look_back(make_bars):
    with pytest.raises(ValueError):
        split_series(make_bars(FIVE_BARS), 59, 10)


def test_one_exchange_serves_all_detectors(make_bars):
    found = detectors.detect_events(make_bars(FIVE_BARS), Thresholds(), RUN_DATE)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
    assert plan.count("Window [") == 1


def test_a_ticker_filter_moves_below_the_windows(spark, make_bars, tmp_path):
    make_bars(FIVE_BARS).write.parquet(str(tmp_path / "bars"))
    found = detectors.detect_events(spark.read.parquet(str(tmp_path / "bars")), SMALL, RUN_DATE)
    chosen = found.filter(F.col("ticker").isin("AAPL", "MSFT"))
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "In(ticker, [AAPL,MSFT])" in plan[plan.index("PushedFilters") :]
    assert chosen.count() == 4


@pytest.mark.parametrize("frame_rows", [1, 3, 128])
def test_sliding_maxima_equal_frames(spark, monkeypatch, frame_rows):
    rng = random.Random(frame_rows)
    data = [
        (ticker, date(2020, 1, 1) + timedelta(days=d), rng.choice([None, float("nan"), 1.0, 2.0, 3.0, 4.0, 5.0]))
        for ticker in "ABC"
        for d in sorted(rng.sample(range(400), rng.randint(1, 60)))
    ]
    bars = spark.createDataFrame(data, "ticker string, date date, adj_close double")
    for window in (2, 4, 7, 30, 100):
        t = replace(SMALL, drawdown_window_days=window)
        monkeypatch.setattr(detectors, "FRAME_ROWS", 10**6)
        want = rows(detectors.drawdowns(bars, t, RUN_DATE))
        monkeypatch.setattr(detectors, "FRAME_ROWS", frame_rows)
        assert rows(detectors.drawdowns(bars, t, RUN_DATE)) == want


def test_volume_moments_do_not_depend_on_what_stands_before(spark):
    large = 10**15
    days = [date(2020, 1, 1) + timedelta(days=d) for d in range(12)]
    quiet, loud = [100, 101, 102, 5000], [large, large + 7, large - 3, large, 1, 2, 9 * large, 4]
    alone = spark.createDataFrame([("A", d, v) for d, v in zip(days[8:], quiet)], "ticker string, date date, volume bigint")
    behind = spark.createDataFrame([("A", d, v) for d, v in zip(days, loud + quiet)], "ticker string, date date, volume bigint")
    t = replace(SMALL, volume_spike_window_days=3, volume_spike_zscore=2.0)
    got = rows(detectors.volume_spikes(alone, t, RUN_DATE), "date", "trailing_mean", "trailing_std", "volume_zscore")
    assert got == [(days[11], 101.0, 1.0, 4899.0)]
    last = detectors.volume_spikes(behind, t, RUN_DATE).filter(F.col("date") == days[11])
    assert rows(last, "date", "trailing_mean", "trailing_std", "volume_zscore") == got
