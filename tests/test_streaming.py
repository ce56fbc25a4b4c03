from __future__ import annotations

from datetime import date, timedelta

from conftest import RUN_DATE, rows

import tidemark as tm
from tidemark.plans import derived, market, tables
from tidemark.schemas import RAW_PRICES
from tidemark.sources.store import TableStore
from tidemark.streaming.landing import SNAPSHOTS, stream_prices, stream_snapshot


def test_each_run_takes_the_files_that_are_new(spark, tmp_path):
    config = tm.Config(
        str(tmp_path / "store"), str(tmp_path / "landing"), str(tmp_path), run_date=RUN_DATE
    )
    first = date(2024, 1, 1)

    def deliver(days):
        data = [("AAPL", first + timedelta(days=d), *[1.0 + d] * 5, 100.0, 0) for d in days]
        spark.createDataFrame(data, RAW_PRICES).coalesce(1).write.mode("append").parquet(
            f"{config.landing_dir}/raw_prices"
        )

    def run():
        query = stream_prices(spark, ["AAPL"], config=config, checkpoint=str(tmp_path / "checkpoint"))
        assert query.awaitTermination(300)
        return rows(derived.stored_last_dates(market._store(config)))

    deliver([0, 1])
    assert run() == [("AAPL", date(2024, 1, 2), 2)]
    deliver([1, 2, 3])
    assert run() == [("AAPL", date(2024, 1, 4), 4)]
    assert run() == [("AAPL", date(2024, 1, 4), 4)]
    loaded = tm.load_prices("AAPL", config=config).df
    assert [d.day for (d,) in rows(loaded, "date")] == [1, 2, 3, 4]


def snapshot_config(tmp_path):
    return tm.Config(str(tmp_path / "store"), str(tmp_path / "landing"), str(tmp_path), run_date=RUN_DATE)


def land(spark, config, dataset, data):
    name, schema = SNAPSHOTS[dataset]
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{config.landing_dir}/{name}")


def run(spark, config, dataset, checkpoint, tickers=None):
    query = stream_snapshot(spark, dataset, tickers, config=config, checkpoint=checkpoint)
    assert query.awaitTermination(300)


def test_the_newest_delivery_of_holdings_wins(spark, tmp_path):
    config = snapshot_config(tmp_path)
    store = TableStore(spark, config.data_dir)
    checkpoint = str(tmp_path / "checkpoint")

    def held():
        return rows(store.read(tables.HOLDINGS), "etf", "ticker")

    land(spark, config, "etf_holdings", [("SPY", k, t, t, "0.1", 5) for k, t in enumerate(["A", "B", "C"])])
    run(spark, config, "etf_holdings", checkpoint)
    assert held() == [("SPY", "A"), ("SPY", "B"), ("SPY", "C")]
    # Newer, with fewer rows; of another fund; late; without a number or a key.
    late = [("SPY", 0, "Z", "Z", "0.1", 4), ("SPY", 0, "Y", "Y", "0.1", None), (None, 0, "X", "X", "0.1", 9)]
    land(spark, config, "etf_holdings", [("SPY", 0, "A", "A", "0.1", 6), ("QQQ", 0, "D", "D", "0.1", 1), *late])
    run(spark, config, "etf_holdings", checkpoint)
    assert held() == [("QQQ", "D"), ("SPY", "A")]
    # The same files from the start: batches that are replayed change nothing.
    before = store.batches(tables.HOLDINGS)
    run(spark, config, "etf_holdings", str(tmp_path / "another"))
    assert held() == [("QQQ", "D"), ("SPY", "A")] and store.batches(tables.HOLDINGS) == before


def test_streamed_earnings_and_info(spark, tmp_path):
    config = snapshot_config(tmp_path)
    land(spark, config, "earnings", [("A", 0, "2024-01-25", "amc", 1), ("A", 1, "2024-04-25", "amc", 1), ("B", 0, "?", "amc", 1)])
    run(spark, config, "earnings", str(tmp_path / "c1"))
    land(spark, config, "earnings", [("A", 0, "2024-01-26", "bmo", 2), ("A", 1, "unreadable", "bmo", 3)])
    run(spark, config, "earnings", str(tmp_path / "c1"))
    loaded = tm.load_events("earnings", config=config)
    # The newest delivery has no readable row, and the one before it is older.
    assert rows(loaded, "ticker", "date") == [("A", date(2024, 1, 25)), ("A", date(2024, 4, 25))]
    info = [("A", '{"sector": "Old"}', 1), ("A", '{"sector": "New", "longName": "A fund"}', 2), ("B", "{}", 1)]
    land(spark, config, "sectors", info)
    run(spark, config, "sectors", str(tmp_path / "c2"), ["A"])
    assert rows(tm.load_sectors(config=config), "ticker", "sector") == [("A", "New")]
    run(spark, config, "etf_metadata", str(tmp_path / "c3"))
    assert rows(tm.load_etf_metadata(config=config), "ticker", "name") == [("A", "A fund"), ("B", None)]
    land(spark, config, "sectors", [("A", '{"sector": "Late"}', 1), ("A", '{"sector": "Newest"}', 7)])
    run(spark, config, "sectors", str(tmp_path / "c2"), ["A"])
    assert rows(tm.load_sectors(config=config), "ticker", "sector") == [("A", "Newest")]
