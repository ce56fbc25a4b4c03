"""The whole store, from landing tables to loaders."""

from __future__ import annotations

import json
import random
from dataclasses import replace
from datetime import date, timedelta

import pytest
from conftest import SMALL, RUN_DATE, rows

import tidemark as tm
from tidemark.plans import derived, market
from tidemark.plans.tables import DERIVED, EARNINGS_ROWS, HOLDINGS, METADATA, PRICES, SECTOR_ROWS
from tidemark.schemas import RAW_EARNINGS, RAW_HOLDINGS, RAW_INFO, RAW_PRICES
from tidemark.sources import files

BASES = {"AAPL": 100.0, "MSFT": 120.0, "SPY": 400.0}
START, END = date(2024, 1, 1), date(2024, 1, 5)


def raw_rows(ticker, base, first=START):
    closes = [base, base + 5, base, base * 0.80, base * 0.79]
    opens = [base, base, base, base + 6, base * 0.79]
    for i, volume in enumerate([100, 110, 90, 100, 500]):
        day = first + timedelta(days=i)
        yield (ticker, day, opens[i], closes[i], closes[i], closes[i], closes[i], float(volume), i)


def land(spark, config, name, data, schema):
    spark.createDataFrame(list(data), schema).write.mode("append").parquet(f"{config.landing_dir}/{name}")


def make_config(path):
    (path / "universe").mkdir()
    (path / "universe" / "sp500.csv").write_text(
        "ticker,name,sector,weight_pct,source,retrieved_at\n"
        "AAPL,Apple,Tech,7.0,test,2024-01-01\nMSFT,Microsoft,Tech,6.0,test,2024-01-01\n"
    )
    (path / "universe" / "etfs.csv").write_text(
        "ticker,name,category,avg_dollar_volume,rank,source,retrieved_at\n"
        'SPY,"Trust, the",broad,1.5,1,test,2024-01-01\n'
    )
    return tm.Config(
        data_dir=str(path / "store"),
        landing_dir=str(path / "landing"),
        universe_dir=str(path / "universe"),
        events=SMALL,
        run_date=RUN_DATE,
    )


def land_all(spark, config):
    land(spark, config, "raw_prices", (r for t, b in BASES.items() for r in raw_rows(t, b)), RAW_PRICES)
    info = {
        "AAPL": {"sector": "Technology", "industry": "Phones", "quoteType": "EQUITY"},
        "MSFT": {"sector": "Technology", "industry": "Software", "quoteType": "EQUITY"},
        "SPY": {"quoteType": "ETF", "longName": "SPDR", "fundInceptionDate": 727660800},
    }
    land(spark, config, "raw_info", ((t, json.dumps(i), 0) for t, i in info.items()), RAW_INFO)
    holdings = [("SPY", 0, "AAPL", "Apple", "0.07"), ("SPY", 1, "MSFT", "Microsoft", "0.05")]
    land(spark, config, "raw_holdings", holdings, RAW_HOLDINGS)
    land(spark, config, "raw_earnings", ((t, 0, "2024-01-25", "amc") for t in BASES), RAW_EARNINGS)


@pytest.fixture
def config(tmp_path):
    return make_config(tmp_path)


@pytest.fixture
def landed(spark, config):
    land_all(spark, config)
    return config


@pytest.fixture(scope="module")
def ingested(spark, tmp_path_factory):
    """A full store with its outcome, for tests that publish nothing."""
    config = make_config(tmp_path_factory.mktemp("market"))
    land_all(spark, config)
    return config, ingest(config)


def outcome(status):
    return rows(status, "dataset", "ticker", "status")


def ingest(config, **kwargs):
    return tm.ingest_all(start_date=START, end_date=END, config=config, **kwargs)


def test_full_ingest_gives_loadable_tables(ingested):
    landed, done = ingested
    assert outcome(done.prices.status) == [("prices", t, "updated") for t in BASES]
    assert rows(tm.run_summary(done.prices.status)) == [("prices", "updated", 3)]
    assert rows(tm.run_summary(done.reference)) == [
        ("etf_holdings", "updated", 1),
        ("etf_metadata", "updated", 1),
        ("sectors", "updated", 3),
    ]
    assert done.prices.rejects.isEmpty()
    loaded = tm.load_prices(list(BASES), config=landed)
    assert loaded.missing.isEmpty() and loaded.df.count() == 15
    assert rows(tm.load_sectors(config=landed), "ticker", "sector", "quote_type") == [
        ("AAPL", "Technology", "EQUITY"),
        ("MSFT", "Technology", "EQUITY"),
        ("SPY", None, "ETF"),
    ]
    assert rows(tm.load_etf_metadata(config=landed), "ticker", "name", "category", "inception_date") == [
        ("SPY", "SPDR", "broad", date(1993, 1, 22))
    ]
    held = tm.load_etf_constituents("SPY", config=landed)
    assert [r.ticker for r in held.collect()] == ["AAPL", "MSFT"]
    weights = rows(tm.load_etf_holdings("SPY", config=landed), "ticker", "weight_pct")
    assert [w for _, w in weights] == pytest.approx([7.0, 5.0])
    assert rows(tm.load_events("earnings", config=landed), "ticker", "date", "event_time") == [
        (t, date(2024, 1, 25), "amc") for t in BASES
    ]


def test_full_ingest_derives_the_expected_events(ingested):
    landed, _ = ingested
    falls = rows(tm.load_events("drawdowns", config=landed), "ticker", "date", "drawdown_pct")
    expected = [
        ("AAPL", 4, -0.238095),
        ("AAPL", 5, -0.21),
        ("MSFT", 4, -0.232),
        ("MSFT", 5, -0.21),
        ("SPY", 4, -0.209877),
        ("SPY", 5, -0.21),
    ]
    assert [(t, d.day) for t, d, _ in falls] == [(t, d) for t, d, _ in expected]
    assert [f for _, _, f in falls] == pytest.approx([f for _, _, f in expected], abs=1e-6)
    gaps = rows(tm.load_events("gaps", config=landed), "ticker", "date")
    assert gaps == [("AAPL", date(2024, 1, 4)), ("MSFT", date(2024, 1, 4))]
    spikes = rows(tm.load_events("volume_spikes", config=landed), "ticker", "volume_zscore")
    assert spikes == [(t, 40.0) for t in BASES]
    assert tm.load_events("all", config=landed).count() == 3 + 6 + 2 + 3


def test_a_rerun_changes_nothing(spark, landed):
    ingest(landed)
    content = rows(tm.store_fingerprint(config=landed))
    before = rows(tm.data_store_manifest(spark, landed.data_dir))
    again = ingest(landed)
    assert {s for _, _, s in outcome(again.prices.status)} == {"already_current"}
    assert {s for _, _, s in outcome(again.reference)} == {"already_current"}
    assert {s for _, _, s in outcome(again.events)} == {"already_current"}
    assert rows(tm.store_fingerprint(config=landed)) == content
    assert rows(tm.data_store_manifest(spark, landed.data_dir)) == before


def test_events_without_earnings(landed):
    ingest(landed, skip_earnings=True)
    assert tm.load_events("earnings", config=landed).isEmpty()
    assert tm.load_events("drawdowns", config=landed).count() == 6


def test_ingest_of_some_tickers_takes_the_etfs_among_them(landed):
    done = ingest(landed, tickers=["SPY", "AAPL", "SPY"])
    assert outcome(done.reference) == [
        ("etf_holdings", "SPY", "updated"),
        ("etf_metadata", "SPY", "updated"),
        ("sectors", "AAPL", "updated"),
        ("sectors", "SPY", "updated"),
    ]


def test_increment_takes_only_days_after_the_last(spark, landed):
    tm.ingest_prices(["AAPL"], start_date="2024-01-01", end_date="2024-01-03", config=landed)
    # A late revision of a stored day is not taken; of new days the last delivery is.
    revised = [
        ("AAPL", date(2024, 1, 2), 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 99),
        ("AAPL", date(2024, 1, 4), 7.0, 7.0, 7.0, 7.0, 7.0, 7.0, 99),
        ("AAPL", date(2024, 1, 6), 8.0, 8.0, 8.0, 8.0, 8.0, 8.0, 99),
    ]
    land(spark, landed, "raw_prices", revised, RAW_PRICES)
    done = tm.ingest_prices(["AAPL", "NONE"], start_date=START, end_date=END, config=landed)
    assert rows(done.status, "ticker", "status", "reason") == [
        ("AAPL", "updated", None),
        ("NONE", "skipped", "no bars delivered in range"),
    ]
    loaded = tm.load_prices("AAPL", adjusted=False, config=landed).df
    assert rows(loaded, "date", "close") == [
        (date(2024, 1, d), c) for d, c in zip(range(1, 6), [100.0, 105.0, 100.0, 7.0, 79.0])
    ]
    store = market._store(landed)
    assert len(store.batches(PRICES)) == 2
    assert rows(derived.stored_last_dates(store)) == [("AAPL", END, 5)]


def test_force_replaces_the_series_of_tickers_with_bars(spark, landed):
    tm.ingest_prices(start_date=START, end_date=END, config=landed)
    done = tm.ingest_prices(
        ["AAPL", "NONE"], start_date=date(2024, 1, 4), end_date=END, force=True, config=landed
    )
    assert rows(done.status, "ticker", "status") == [("AAPL", "updated"), ("NONE", "skipped")]
    counts = tm.load_prices(list(BASES), config=landed).df.groupBy("ticker").count()
    assert rows(counts) == [("AAPL", 2), ("MSFT", 5), ("SPY", 5)]
    # Nothing in range: the store stays as it is.
    late = date(2025, 1, 1)
    done = tm.ingest_prices(["AAPL"], start_date=late, end_date=late, force=True, config=landed)
    assert rows(done.status, "status") == [("skipped",)]
    assert tm.load_prices("AAPL", config=landed).df.count() == 2


def test_a_bar_without_volume_is_rejected(spark, config):
    bad = ("AAPL", START, 1.0, 1.0, 1.0, 1.0, 1.0, float("nan"), 0)
    land(spark, config, "raw_prices", [bad], RAW_PRICES)
    done = tm.ingest_prices(["AAPL"], start_date=START, end_date=END, config=config)
    assert rows(done.rejects, "ticker", "date", "volume") == [("AAPL", START, None)]
    assert rows(done.status, "status") == [("skipped",)]
    assert not market._store(config).exists(PRICES)


def test_load_prices_repeats_what_is_asked_twice(ingested):
    landed, _ = ingested
    loaded = tm.load_prices(
        ["MSFT", "NONE", "AAPL", "MSFT"], start="2024-01-02", end="2024-01-03", config=landed
    )
    assert rows(loaded.missing) == [(1, "NONE")]
    ordered = loaded.df.orderBy("position", "date").select("ticker", "date").collect()
    assert [(r.ticker, r.date.day) for r in ordered] == [
        (t, d) for t in ("MSFT", "AAPL", "MSFT") for d in (2, 3)
    ]


def test_missing_deliveries_are_skipped(config):
    assert outcome(tm.ingest_sectors(["AAPL"], config=config)) == [("sectors", "AAPL", "skipped")]
    assert outcome(tm.ingest_earnings(["AAPL"], config=config)) == [("earnings", "AAPL", "skipped")]
    assert outcome(tm.ingest_etf_constituents(["SPY"], config=config)) == [("etf_holdings", "SPY", "skipped")]
    with pytest.raises(FileNotFoundError):
        tm.load_sectors(config=config)
    with pytest.raises(FileNotFoundError):
        tm.load_etf_holdings("SPY", config=config)


def test_an_etf_without_info_still_gets_a_row(config):
    assert outcome(tm.ingest_etf_metadata(config=config)) == [("etf_metadata", "SPY", "skipped")]
    assert rows(tm.load_etf_metadata(config=config), "name", "category", "inception_date") == [
        ("Trust, the", "broad", None)
    ]


def test_unreadable_earnings_are_skipped(spark, config):
    land(spark, config, "raw_earnings", [("AAPL", 0, "not-a-date", None)], RAW_EARNINGS)
    status = tm.ingest_earnings(["AAPL"], config=config)
    assert outcome(status) == [("earnings", "AAPL", "skipped")]
    assert tm.load_events("earnings", config=config).isEmpty()


def test_force_drops_rows_of_tickers_that_are_no_longer_delivered(spark, landed):
    tm.ingest_sectors(config=landed)
    empty = tm.Config(landed.data_dir, landed.landing_dir + "2", landed.universe_dir, run_date=RUN_DATE)
    land(spark, empty, "raw_info", [("SPY", "{}", 0)], RAW_INFO)
    status = tm.ingest_sectors(["AAPL", "SPY"], force=True, config=empty)
    assert outcome(status) == [("sectors", "AAPL", "skipped"), ("sectors", "SPY", "updated")]
    assert rows(tm.load_sectors(config=landed), "ticker", "quote_type") == [("MSFT", "EQUITY"), ("SPY", None)]


def test_holdings_of_further_etfs_are_added(spark, landed):
    land(spark, landed, "raw_holdings", [("007", 0, "MSFT", "Microsoft", "0.5")], RAW_HOLDINGS)
    tm.ingest_etf_constituents(["SPY"], config=landed)
    status = tm.ingest_etf_constituents(["SPY", "007"], config=landed)
    assert outcome(status) == [("etf_holdings", "007", "updated"), ("etf_holdings", "SPY", "already_current")]
    assert rows(tm.load_etf_holdings("007", config=landed), "etf", "ticker") == [("007", "MSFT")]
    assert tm.load_etf_holdings("SPY", config=landed).count() == 2


def test_force_replaces_holdings_of_delivered_etfs_only(spark, landed):
    land(spark, landed, "raw_holdings", [("QQQ", 0, "MSFT", "Microsoft", "0.5")], RAW_HOLDINGS)
    tm.ingest_etf_constituents(["SPY", "QQQ"], config=landed)
    fresh = tm.Config(landed.data_dir, landed.landing_dir + "2", landed.universe_dir, run_date=RUN_DATE)
    land(spark, fresh, "raw_holdings", [("SPY", 0, "NVDA", "Nvidia", "x")], RAW_HOLDINGS)
    tm.ingest_etf_constituents(["SPY", "QQQ"], force=True, config=fresh)
    assert rows(tm.load_etf_holdings("SPY", config=landed), "ticker", "weight_pct") == [("NVDA", None)]
    assert rows(tm.load_etf_holdings("QQQ", config=landed), "ticker") == [("MSFT",)]


def test_derived_events_without_any_bars_stay_as_they_are(ingested):
    landed, _ = ingested
    detected = tm.ingest_derived_events(["NONE"], config=landed)
    assert detected.updated == [] and rows(detected.missing, "ticker") == [("NONE",)]
    assert tm.load_events("drawdowns", config=landed).count() == 6


def test_derived_events_of_a_requested_ticker_without_bars_go(spark, ingested):
    landed, _ = ingested
    later = tm.Config(landed.data_dir + "2", landed.landing_dir, landed.universe_dir, SMALL, RUN_DATE)
    tm.ingest_prices(["AAPL"], start_date=START, end_date=END, config=later)
    store = market._store(later)
    old = market._store(landed).read(DERIVED)
    batch = store.new_batch(DERIVED)
    derived._write_events(store, batch, old)
    store.publish(batch)
    detected = tm.ingest_derived_events(["AAPL", "MSFT"], config=later)
    assert detected.updated == ["drawdowns", "gaps", "volume_spikes"]
    assert rows(tm.load_events("volume_spikes", config=later), "ticker") == [("AAPL",), ("SPY",)]


def test_another_day_rewrites_events_unless_told_not_to(landed):
    tm.ingest_prices(start_date=START, end_date=END, config=landed)
    tm.ingest_derived_events(config=landed)
    tomorrow = tm.Config(
        landed.data_dir, landed.landing_dir, landed.universe_dir, SMALL, RUN_DATE + timedelta(days=1)
    )
    assert tm.ingest_derived_events(config=tomorrow, ignore_created_at=True).updated == []
    assert tm.ingest_derived_events(config=tomorrow).updated == ["drawdowns", "gaps", "volume_spikes"]


def test_new_bars_give_the_events_that_a_full_run_gives(spark, config, monkeypatch):
    monkeypatch.setattr("tidemark.sources.store.FAN", 100)
    rng = random.Random(9)

    def deliver(tickers, days):
        data = []
        for ticker in tickers:
            for d in days:
                price = float(rng.randint(50, 150))
                volume = float(rng.choice([100, 110, 120, 9000]))
                data.append((ticker, START + timedelta(days=d), *[price] * 5, volume, 0))
        land(spark, config, "raw_prices", data, RAW_PRICES)
        tm.ingest_prices(["A", "B", "C"], start_date=START, end_date=date(2025, 1, 1), config=config)

    def refresh(tickers=("A", "B", "C")):
        return tm.ingest_derived_events(list(tickers), config=config, incremental=True).updated

    def batches():
        return len(market._store(config).batches(DERIVED))

    deliver("AB", range(20))
    refresh()
    assert batches() == 1
    deliver("A", range(20, 30))
    refresh()
    assert batches() == 2 and refresh() == [] and batches() == 2
    deliver("BC", range(20, 40))
    refresh("B")
    deliver("ABC", range(40, 45))
    refresh()
    assert batches() == 4
    assert tm.load_events("all", config=config).count() > 50
    # A full run finds the same rows.
    full = tm.ingest_derived_events(["A", "B", "C"], config=config, ignore_created_at=True)
    assert full.updated == []
    # Other thresholds: all events are derived anew.
    strict = replace(config, events=replace(SMALL, gap_threshold_pct=0.5))
    done = tm.ingest_derived_events(["A", "B", "C"], config=strict, incremental=True)
    assert done.updated == ["gaps"]
    assert tm.ingest_derived_events(["A", "B", "C"], config=strict, incremental=True).updated == []
    # Replaced history: that ticker's events are derived anew, the others stay as they were.
    before = rows(tm.load_events("all", ["B", "C"], config=strict))
    tm.ingest_prices(["A"], start_date=START + timedelta(days=40), end_date=END.replace(year=2025), force=True, config=config)
    later = replace(strict, run_date=RUN_DATE + timedelta(days=1))
    done = tm.ingest_derived_events(["A", "B", "C"], config=later, incremental=True)
    assert "drawdowns" in done.updated
    assert rows(tm.load_events("all", ["B", "C"], config=strict)) == before
    assert {r[0] for r in rows(tm.load_events("drawdowns", ["A"], config=strict), "created_at")} <= {later.run_date}
    assert tm.ingest_derived_events(["A", "B", "C"], config=later, ignore_created_at=True).updated == []


def test_load_events_filters_by_ticker_and_day(ingested):
    landed, _ = ingested
    day = date(2024, 1, 4)
    chosen = tm.load_events("all", ["AAPL", "SPY"], day, day, config=landed)
    assert rows(chosen, "event_type", "ticker") == [
        ("drawdowns", "AAPL"),
        ("drawdowns", "SPY"),
        ("gaps", "AAPL"),
    ]
    with pytest.raises(ValueError):
        tm.load_events("splits", config=landed)


def test_universe(config):
    both = tm.load_universe(config=config).orderBy("position").collect()
    assert [r.ticker for r in both] == ["AAPL", "MSFT", "SPY"]
    assert rows(tm.load_universe("etfs", config=config), "ticker") == [("SPY",)]
    with pytest.raises(NotImplementedError):
        tm.load_universe(as_of="2020-01-01", config=config)
    with pytest.raises(ValueError):
        tm.load_universe("bonds", config=config)
    absent = tm.Config(config.data_dir, config.landing_dir, config.universe_dir + "-absent")
    with pytest.raises(tm.UniverseSnapshotMissing):
        tm.load_universe("sp500", config=absent)


def test_an_unfinished_batch_is_never_read(spark, ingested):
    landed, _ = ingested
    store = market._store(landed)
    half = store.new_batch(PRICES)
    store.write(PRICES, store.read(PRICES), half)
    assert tm.load_prices(list(BASES), config=landed).df.count() == 15
    assert store.new_batch(PRICES).last > half.last
    assert not files.exists(spark, half.marker)


def test_build_etfs_ranks_candidates_by_dollar_volume(spark, landed, tmp_path):
    (tmp_path / "universe" / "etf_candidates.csv").write_text(
        "ticker,name,category\nAAPL,Apple Fund,tech\nSPY,Trust,broad\nNONE,Nothing,none\n"
    )
    config = tm.Config(landed.data_dir, landed.landing_dir, landed.universe_dir + "2", run_date=END)
    (tmp_path / "universe2").mkdir()
    (tmp_path / "universe2" / "etf_candidates.csv").write_text(
        (tmp_path / "universe" / "etf_candidates.csv").read_text()
    )
    tm.build_etfs(top_n=2, days=2, config=config)
    etfs = files.read_etfs(spark, config.universe_dir)
    assert rows(etfs, "position", "ticker", "category", "rank", "avg_dollar_volume", "retrieved_at") == [
        (0, "SPY", "broad", 1, (320.0 * 100 + 316.0 * 500) / 2, END),
        (1, "AAPL", "tech", 2, (80.0 * 100 + 79.0 * 500) / 2, END),
    ]


def test_a_newer_delivery_of_holdings_replaces_the_older_one(spark, config):
    def deliver(number, symbols, etf="SPY"):
        data = [(etf, k, s, s, "0.1", number) for k, s in enumerate(symbols)]
        schema = "etf string, position bigint, Symbol string, Name string, `Holding Percent` string, delivery int"
        land(spark, config, "raw_holdings", data, schema)

    deliver(1, ["AAPL", "MSFT"])
    deliver(1, ["MSFT"], "QQQ")
    tm.ingest_etf_constituents(["SPY", "QQQ"], config=config)
    deliver(2, ["NVDA", "AAPL"])
    tm.ingest_etf_constituents(["SPY", "QQQ"], force=True, config=config)
    assert rows(tm.load_etf_holdings("SPY", config=config), "position", "ticker") == [(0, "NVDA"), (1, "AAPL")]
    assert rows(tm.load_etf_holdings("QQQ", config=config), "position", "ticker") == [(0, "MSFT")]


def test_withdrawn_earnings_dates_go(spark, config):
    schema = "ticker string, position bigint, `Earnings Date` string, `Event Time` string, delivery int"
    land(spark, config, "raw_earnings", [("AAPL", 0, "2024-01-25", "amc", 1), ("MSFT", 0, "2024-01-20", None, 1)], schema)
    tm.ingest_earnings(["AAPL", "MSFT"], config=config)
    land(spark, config, "raw_earnings", [("AAPL", 0, "2024-01-30", "amc", 2)], schema)
    tm.ingest_earnings(["AAPL", "MSFT"], force=True, config=config)
    assert rows(tm.load_events("earnings", config=config), "ticker", "date") == [
        ("AAPL", date(2024, 1, 30)),
        ("MSFT", date(2024, 1, 20)),
    ]


def test_merging_batches_keeps_every_row(spark, config, monkeypatch):
    def run(fan):
        monkeypatch.setattr("tidemark.sources.store.FAN", fan)
        own = replace(config, data_dir=f"{config.data_dir}{fan}")
        for k in range(5):
            first = START + timedelta(days=7 * k)
            day = replace(own, run_date=RUN_DATE + timedelta(days=k))
            landed = spark.createDataFrame(list(raw_rows("AAPL", 100.0 + k, first)), RAW_PRICES)
            tm.ingest_prices(["AAPL"], start_date=START, end_date=first + timedelta(days=4), config=day, landed=landed)
            tm.ingest_derived_events(["AAPL"], config=day, incremental=True)
        store = market._store(own)
        loaded = rows(tm.load_prices("AAPL", adjusted=False, config=own).df)
        return (rows(tm.load_events("all", config=own)), loaded), [len(store.batches(t)) for t in (DERIVED, PRICES)]

    many, n_many = run(100)
    few, n_few = run(2)
    assert many == few and n_many == [5, 5] and max(n_few) <= 2
    assert len({r[4] for r in many[0]}) == 5  # created_at of each run


def test_one_bad_cell_costs_one_row(spark, config):
    schema = "ticker string, Date string, Open string, High string, Low string, Close string, `Adj Close` string, Volume string, position bigint"
    landed = spark.createDataFrame(
        [
            ("AAPL", "2024-01-02", "1", "1", "1", "1", "1", "5", 0),
            ("AAPL", "someday", "1", "1", "1", "1", "1", "5", 0),
            ("MSFT", "2024-01-02", "1", "1", "1", "n/a", "1", "5", 0),
            ("MSFT", "2024-01-03", "1", "1", "1", None, "1", "5", 0),
        ],
        schema,
    )
    done = tm.ingest_prices(["AAPL", "MSFT"], start_date=START, end_date=END, config=config, landed=landed)
    assert rows(done.rejects, "ticker", "reason") == [
        ("AAPL", "unreadable Date"),
        ("MSFT", "no close"),
        ("MSFT", "unreadable Close"),
    ]
    assert outcome(done.status) == [("prices", "AAPL", "updated"), ("prices", "MSFT", "skipped")]
    again = tm.ingest_prices(["AAPL"], start_date=START, end_date=END, config=config, landed=landed)
    assert outcome(again.status) == [("prices", "AAPL", "no_new_bars")]


def test_old_landed_rows_are_skipped_despite_a_ticker_that_never_delivers(spark, landed):
    tm.ingest_prices(["AAPL", "MSFT"], start_date=START, end_date=END, config=landed)
    store = market._store(landed)
    asked = market._requested(landed, ["AAPL", "MSFT", "NEVER"])
    windows = market.B.fetch_windows(asked, derived.stored_last_dates(store), START, END + timedelta(days=9))
    _, scan = market._scan_bounds(windows, START)
    raw = spark.read.parquet(f"{landed.landing_dir}/raw_prices")
    plan = market.B.read_bars(raw).filter(scan)._jdf.queryExecution().optimizedPlan().toString()
    assert "NEVER" in plan and "2024-01-06" in plan


def test_metadata_is_taken_up_again_if_asked(spark, config):
    tm.ingest_etf_metadata(config=config)
    land(spark, config, "raw_info", [("SPY", json.dumps({"longName": "SPDR", "fundInceptionDate": 727660800}), 0)], RAW_INFO)
    assert outcome(tm.ingest_etf_metadata(config=config)) == [("etf_metadata", "SPY", "already_current")]
    assert outcome(tm.ingest_etf_metadata(retry_missing=True, config=config)) == [("etf_metadata", "SPY", "updated")]
    assert rows(tm.load_etf_metadata(config=config), "inception_date") == [(date(1993, 1, 22),)]


def batch_count(config, table):
    return len(market._store(config).batches(table))


def files_under(path):
    return sorted(str(p.relative_to(path)) for p in path.rglob("*") if p.is_file() and not p.name.endswith(".crc"))


def test_force_writes_only_the_rows_of_its_tickers(spark, landed, tmp_path):
    tm.ingest_prices(start_date=START, end_date=END, config=landed)
    tm.ingest_etf_constituents(config=landed)
    store = market._store(landed)
    before = files_under(tmp_path / "store")
    tm.ingest_prices(["AAPL"], start_date=date(2024, 1, 4), end_date=END, force=True, config=landed)
    newest = store.batches(PRICES)[-1]
    assert rows(spark.read.parquet(newest.part("rows")), "ticker", "date") == [("AAPL", date(2024, 1, d)) for d in (4, 5)]
    assert rows(store.replaced([newest])) == [("AAPL", 2)]
    assert set(before) <= set(files_under(tmp_path / "store"))  # nothing was rewritten
    assert rows(derived.stored_last_dates(store)) == [("AAPL", END, 2), ("MSFT", END, 5), ("SPY", END, 5)]
    # Replaced again, then merged: what older batches held stays gone.
    tm.ingest_prices(["AAPL"], start_date=END, end_date=END, force=True, config=landed)
    counts = [("AAPL", 1), ("MSFT", 5), ("SPY", 5)]
    assert rows(tm.load_prices(list(BASES), config=landed).df.groupBy("ticker").count()) == counts
    store.merge_newest(PRICES, 2)
    assert rows(tm.load_prices(list(BASES), config=landed).df.groupBy("ticker").count()) == counts
    store.merge_newest(PRICES, 2)
    assert rows(tm.load_prices(list(BASES), config=landed).df.groupBy("ticker").count()) == counts
    assert rows(derived.stored_last_dates(store)) == [("AAPL", END, 1), ("MSFT", END, 5), ("SPY", END, 5)]


def test_upserts_write_only_their_own_rows(spark, landed):
    tm.ingest_sectors(["AAPL", "MSFT"], config=landed)
    tm.ingest_sectors(["AAPL", "MSFT", "SPY"], config=landed)
    store = market._store(landed)
    assert [rows(spark.read.parquet(b.part("rows")), "ticker") for b in store.batches(SECTOR_ROWS)] == [
        [("AAPL",), ("MSFT",)],
        [("SPY",)],
    ]
    tm.ingest_sectors(["MSFT"], force=True, config=landed)
    assert rows(spark.read.parquet(store.batches(SECTOR_ROWS)[-1].part("rows")), "ticker") == [("MSFT",)]
    assert rows(tm.load_sectors(config=landed), "ticker") == [("AAPL",), ("MSFT",), ("SPY",)]


def test_a_rerun_of_everything_writes_no_file(landed, tmp_path):
    tm.ingest_all(start_date=START, end_date=END, config=landed)
    before = files_under(tmp_path / "store")
    done = tm.ingest_all(start_date=START, end_date=END, config=landed)
    assert {r[1] for r in rows(done.prices.status, "ticker", "status")} == {"already_current"}
    assert files_under(tmp_path / "store") == before


def opened(config, table, name, tickers, start=START, end=END):
    """Landed files that an ingest would open: new ones, and old ones."""
    store = market._store(config)
    asked = market._requested(config, tickers)
    dated = (start, end) if table is PRICES else ()
    taken = market.landing.take(store, table, config.landing_dir, [name], asked, *dated)
    return len(taken.new.get(name, [])), len(taken.old.get(name, []))


def land_one(spark, config, name, data, schema):
    spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(f"{config.landing_dir}/{name}")


def test_a_rerun_opens_no_old_file(spark, config):
    silent = [f"S{k}" for k in range(2000)]
    land_one(spark, config, "raw_prices", raw_rows("AAPL", 100.0), RAW_PRICES)
    tm.ingest_prices(["AAPL", *silent], start_date=START, end_date=END, config=config)
    assert opened(config, PRICES, "raw_prices", ["AAPL", *silent]) == (0, 0)
    # A later end: the file holds no such day. A ticker not asked for before: all files.
    later = END + timedelta(days=30)
    assert opened(config, PRICES, "raw_prices", ["AAPL", *silent], end=later) == (0, 0)
    assert opened(config, PRICES, "raw_prices", ["AAPL", "MSFT"], end=later) == (0, 1)
    land_one(spark, config, "raw_prices", raw_rows("MSFT", 50.0, START + timedelta(days=5)), RAW_PRICES)
    assert opened(config, PRICES, "raw_prices", ["AAPL", *silent], end=later) == (1, 0)
    done = tm.ingest_prices(["AAPL", "MSFT"], start_date=START, end_date=later, config=config)
    assert outcome(done.status) == [("prices", "AAPL", "no_new_bars"), ("prices", "MSFT", "updated")]
    assert opened(config, PRICES, "raw_prices", ["AAPL", "MSFT"], end=later) == (0, 0)
    # Those who were not asked for when the second file was taken need it, and only it.
    assert opened(config, PRICES, "raw_prices", silent, end=later) == (0, 1)


def test_days_outside_the_request_are_taken_when_they_are_asked_for(spark, config):
    config = replace(config, landing_dir=f"{config.landing_dir} of+a é%")
    land_one(spark, config, "raw_prices", raw_rows("AAPL", 100.0), RAW_PRICES)
    middle = date(2024, 1, 3)
    tm.ingest_prices(["AAPL"], start_date=START, end_date=middle, config=config)
    assert opened(config, PRICES, "raw_prices", ["AAPL"], end=middle) == (0, 0)
    assert opened(config, PRICES, "raw_prices", ["AAPL"]) == (1, 0)
    done = tm.ingest_prices(["AAPL"], start_date=START, end_date=END, config=config)
    assert outcome(done.status) == [("prices", "AAPL", "updated")]
    assert tm.load_prices("AAPL", config=config).df.count() == 5


def test_snapshots_open_only_files_their_tickers_need(spark, config):
    info = json.dumps({"sector": "Technology", "quoteType": "EQUITY"})
    land_one(spark, config, "raw_info", [("AAPL", info, 0)], RAW_INFO)
    tm.ingest_sectors(["AAPL", "LATE"], config=config)
    assert opened(config, SECTOR_ROWS, "raw_info", ["LATE"]) == (0, 0)
    assert opened(config, SECTOR_ROWS, "raw_info", ["OTHER"]) == (0, 1)
    land_one(spark, config, "raw_info", [("LATE", info, 1)], RAW_INFO)
    assert opened(config, SECTOR_ROWS, "raw_info", ["LATE"]) == (1, 0)
    done = tm.ingest_sectors(["AAPL", "LATE"], config=config)
    assert rows(done, "ticker", "status") == [("AAPL", "already_current"), ("LATE", "updated")]
    for table, ingest, name in ((HOLDINGS, tm.ingest_etf_constituents, "raw_holdings"), (EARNINGS_ROWS, tm.ingest_earnings, "raw_earnings")):
        data = [("SPY", 0, "AAPL", "Apple", "0.07")] if table is HOLDINGS else [("SPY", 0, "2024-01-25", "amc")]
        land_one(spark, config, name, data, RAW_HOLDINGS if table is HOLDINGS else RAW_EARNINGS)
        ingest(["SPY", "QQQ"], config=config)
        assert opened(config, table, name, ["SPY", "QQQ"]) == (0, 0)
    assert batch_count(config, METADATA) == 0


def test_many_ingests_leave_few_batches(spark, config):
    for k in range(20):
        landed = spark.createDataFrame(list(raw_rows("AAPL", 100.0 + k, START + timedelta(days=5 * k))), RAW_PRICES)
        last = START + timedelta(days=5 * k + 4)
        tm.ingest_prices(["AAPL"], start_date=START, end_date=last, config=config, landed=landed)
    assert batch_count(config, PRICES) <= 4
    assert tm.load_prices("AAPL", config=config).df.count() == 100
    assert rows(derived.stored_last_dates(market._store(config))) == [("AAPL", START + timedelta(days=99), 100)]


def test_wide_and_per_ticker_landings(spark, config, tmp_path):
    fields = ["Open", "High", "Low", "Close", "Adj Close", "Volume"]

    def wide(tickers, day, names):
        columns = ", ".join(f"`{n}` double" for t in tickers for n in names(t))
        row = (day, *[float(k + 1) for k, _ in enumerate(tickers) for _ in fields])
        land_one(spark, config, "raw_prices_wide", [row], f"Date date, {columns}")

    wide(["AAPL", "A|B"], START, lambda t: [f"{t}|{f}" for f in fields])
    wide(["MSFT"], START, lambda t: [f"{f}|{t}" for f in fields])  # another set of columns
    folder = tmp_path / "landing" / "raw_prices_by_ticker"
    folder.mkdir(parents=True)
    one = spark.createDataFrame([(START, *[9.0] * 6)], "Date date, " + ", ".join(f"`{f}` double" for f in fields))
    one.toPandas().to_parquet(folder / "BRK-B.parquet")
    asked = ["AAPL", "A|B", "MSFT", "BRK-B", "NONE"]
    done = tm.ingest_prices(asked, start_date=START, end_date=END, config=config)
    assert rows(done.status, "ticker", "status") == [
        ("AAPL", "updated"), ("A|B", "updated"), ("BRK-B", "updated"), ("MSFT", "updated"), ("NONE", "skipped"),
    ]
    loaded = rows(tm.load_prices(asked, adjusted=False, config=config).df, "ticker", "date", "close", "volume")
    assert loaded == [("AAPL", START, 1.0, 1), ("A|B", START, 2.0, 2), ("BRK-B", START, 9.0, 9), ("MSFT", START, 1.0, 1)]
    wide(["AAPL"], END, lambda t: [f"{t}|{f}" for f in fields])
    assert opened(config, PRICES, "raw_prices_wide", asked) == (1, 0)
    done = tm.ingest_prices(asked, start_date=START, end_date=END, config=config)
    assert ("prices", "AAPL", "updated") in outcome(done.status)
    assert tm.load_prices("AAPL", config=config).df.count() == 2
