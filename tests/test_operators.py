from __future__ import annotations

import random
from datetime import date

import pytest
from conftest import RUN_DATE, rows
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import bars as B
from tidemark.operators import events, keyed, reference, summary, universe
from tidemark.schemas import BARS, EARNINGS, EVENTS, RAW_EARNINGS, RAW_INFO


def values(spark, expression, texts, kind="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, x {kind}")
    return [r.y for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


# --- scalars ----------------------------------------------------------------


def test_tickers_are_cleaned_and_checked(spark):
    raw = ["brk.b", " aapl ", "-", "", "TOOLONG", "A B", "X1-Y"]
    clean = values(spark, S.clean_ticker, raw)
    assert clean == ["BRK-B", "AAPL", "-", "", "TOOLONG", "A B", "X1-Y"]
    assert values(spark, S.is_ticker, clean) == [True, True, False, False, False, False, True]


def test_epoch_seconds_become_dates(spark):
    texts = ["727660800", "727660800.0", "", "0", "abc", None, "1e18", "-86400", "NaN"]
    found = values(spark, S.epoch_date, texts)
    assert found == [date(1993, 1, 22)] * 2 + [None] * 5 + [date(1969, 12, 31), None]


def test_utc_day_follows_the_offset(spark):
    texts = ["2024-01-25 20:30:00-05:00", "2024-01-25 10:00:00-05:00", "2024-01-25", "not-a-date", None]
    day = date(2024, 1, 25)
    assert values(spark, S.utc_day, texts) == [date(2024, 1, 26), day, day, None, None]


def test_first_text_skips_empty_values(spark):
    df = spark.createDataFrame([("", "b", "c"), (None, "", "c"), ("a", "b", None)], "x string, y string, z string")
    first = S.first_text(F.col("x"), F.col("y"), F.col("z"))
    assert rows(df.select(first)) == [("a",), ("b",), ("c",)]


# --- bars -------------------------------------------------------------------


def raw_prices(spark, data):
    schema = (
        "ticker string, Date string, Open double, High double, Low double, Close double, "
        "Volume double, `Adj Close` double, position bigint"
    )
    return spark.createDataFrame(data, schema)


def test_normalise_bars(spark):
    days = [
        ("AAPL", f"2024-01-0{d + 1}", 100.0 + d, 101.0 + d, 99.0 + d, 100.5 + d, 1e6 + d, 100.5 + d, 0)
        for d in range(3)
    ]
    nan = float("nan")
    days += [
        ("AAPL", "2024-01-04", 1.0, 1.0, 1.0, nan, 1.0, 1.0, 0),
        ("AAPL", "2024-01-05", nan, 1.0, 1.0, 1.0, nan, 1.0, 0),
    ]
    bars = B.normalise_bars(raw_prices(spark, days)).drop("position")
    assert bars.columns == BARS.names
    usable, rejects = B.split_rejects(bars)
    assert rows(usable) == [
        ("AAPL", date(2024, 1, d + 1), 100.0 + d, 101.0 + d, 99.0 + d, 100.5 + d, 1_000_000 + d, 100.5 + d)
        for d in range(3)
    ]
    assert rows(rejects, "date", "open", "volume") == [(date(2024, 1, 5), None, None)]


def test_a_delivery_without_a_price_column_is_an_error(spark):
    with pytest.raises(ValueError, match="Close"):
        B.normalise_bars(raw_prices(spark, []).drop("Close"))


@pytest.mark.parametrize("name", ["{t}|{f}", "{f}|{t}"])
def test_wide_to_long_takes_both_orders(spark, name):
    wide = spark.createDataFrame(
        [("2024-01-01", *map(float, range(1, 13))), ("2024-01-02", *[None] * 6, *map(float, range(6)))],
        ["Date", *[name.format(t=t, f=f) for t in ("A#1", "B.2") for f in B.PRICE_FIELDS]],
    )
    long = B.wide_to_long(wide, ["A#1", "B.2"])
    assert rows(long, "ticker", "date", "open", "volume", "adj_close") == [
        ("A#1", date(2024, 1, 1), 1.0, 5, 6.0),
        ("B.2", date(2024, 1, 1), 7.0, 11, 12.0),
        ("B.2", date(2024, 1, 2), 0.0, 4, 5.0),
    ]


def test_adjust_scales_prices_only(spark):
    day = date(2024, 1, 1)
    bars = spark.createDataFrame(
        [
            ("A", day, 200.0, 210.0, 190.0, 200.0, 7, 100.0),
            ("B", day, 2.0, 2.0, 2.0, 0.0, 7, 5.0),
            ("C", day, 2.0, 2.0, 2.0, 2.0, 7, None),
        ],
        BARS,
    )
    assert rows(B.adjust(bars).drop("date")) == [
        ("A", 100.0, 105.0, 95.0, 100.0, 7, 100.0),
        ("B", 2.0, 2.0, 2.0, 0.0, 7, 5.0),
        ("C", 2.0, 2.0, 2.0, 2.0, 7, None),
    ]


def test_a_ticker_filter_and_date_bounds_reach_the_scan(spark, make_bars, tmp_path):
    make_bars([(1, 1.0, 1.0, 1)]).write.parquet(str(tmp_path / "b"))
    bars = spark.read.schema(BARS).parquet(str(tmp_path / "b")).filter(F.col("ticker").isin(["AAPL"]))
    loaded, _ = B.load_bars(bars, keyed.request_list(spark, "AAPL"), "2024-01-01", "2024-01-31")
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(date,2024-01-01)" in pushed and "ticker" in pushed


@pytest.mark.parametrize("few", [True, False])
def test_price_increment_takes_each_ticker_from_its_own_day(spark, few):
    day = lambda d: date(2024, 1, d)
    data = [(t, day(d), *[float(10 * v + d)] * 4, 1, 1.0, v) for t in "ABC" for d in range(1, 7) for v in (0, 1)]
    raw = spark.createDataFrame(
        data,
        "ticker string, date date, open double, high double, low double, close double, "
        "volume bigint, adj_close double, position int",
    )
    last = spark.createDataFrame([("A", day(3)), ("C", day(9))], "ticker string, last_date date")
    asked = keyed.request_list(spark, ["A", "B", "C", "D"])
    windows = B.fetch_windows(asked, last, day(2), day(5))
    new = B.price_increment(raw, windows, few)
    assert rows(new, "ticker", "date", "close") == [
        *[("A", day(d), 10.0 + d) for d in (4, 5)],
        *[("B", day(d), 10.0 + d) for d in (2, 3, 4, 5)],
    ]
    status = B.price_status(windows, new.select("ticker").distinct())
    assert rows(status, "ticker", "status") == [
        ("A", "updated"),
        ("B", "updated"),
        ("C", "already_current"),
        ("D", "skipped"),
    ]


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_the_earliest_day_needed_reaches_the_scan_of_the_landing_table(spark, tmp_path, kind):
    day = ("AAPL", "2024-01-04", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 0)
    path = str(tmp_path / "raw")
    raw_prices(spark, [day]).withColumn("Date", F.col("Date").cast(kind)).write.parquet(path)
    usable, _ = B.split_rejects(B.normalise_bars(spark.read.parquet(path)))
    recent = B.in_range(usable, date(2024, 1, 2), date(2024, 1, 5))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(Date,2024-01-02" in plan[plan.index("PushedFilters") :]
    assert rows(recent, "date") == [(date(2024, 1, 4),)]


# --- keyed tables -----------------------------------------------------------


def test_unique_ordered_keeps_the_first_position(spark):
    asked = keyed.request_list(spark, ["B", "A", "B", "C", "A"])
    assert rows(keyed.unique_ordered(asked)) == [(0, "B"), (1, "A"), (3, "C")]
    held = spark.createDataFrame([("A",), ("A",)], "ticker string")
    assert rows(keyed.missing_from_snapshot(asked, held)) == [(0, "B"), (2, "B"), (3, "C")]


def test_merge_snapshot(spark):
    old = spark.createDataFrame([("A", 1), ("B", 1), ("C", 1)], "ticker string, v int")
    new = spark.createDataFrame([("B", 2, 0), ("B", 3, 1), ("D", 2, 0)], "ticker string, v int, position bigint")
    columns = ["ticker", "v"]
    assert rows(keyed.merge_snapshot(old, new, columns, ["ticker"])) == [
        ("A", 1),
        ("B", 3),
        ("C", 1),
        ("D", 2),
    ]
    refreshed = spark.createDataFrame([("A",), ("B",)], "ticker string")
    assert rows(keyed.merge_snapshot(old, new, columns, ["ticker"], refreshed)) == [
        ("B", 3),
        ("C", 1),
        ("D", 2),
    ]


@pytest.mark.parametrize("seed", range(3))
def test_merge_snapshot_agrees_with_brute_force(spark, seed):
    rng = random.Random(seed)
    old = {k: ("old", rng.randint(0, 9)) for k in rng.sample("ABCDEFGH", 5)}
    new = [(rng.choice("ABCDEFGHIJ"), ("new", rng.randint(0, 9))) for _ in range(8)]
    refreshed = rng.sample("ABCDEFGH", 3) if seed else None
    expected = {k: v for k, v in old.items() if not refreshed or k not in refreshed} | dict(new)
    schema = "ticker string, origin string, v int, position bigint"
    merged = keyed.merge_snapshot(
        spark.createDataFrame([(k, *v, 0) for k, v in old.items()], schema).drop("position"),
        spark.createDataFrame([(k, *v, i) for i, (k, v) in enumerate(new)], schema),
        ["ticker", "origin", "v"],
        ["ticker"],
        keyed.request_list(spark, refreshed) if refreshed else None,
    )
    assert rows(merged) == sorted((k, *v) for k, v in expected.items())


def test_keep_last_cuts_a_hot_key_before_the_shuffle(spark):
    """One key holds most rows; at most one of them per task is shuffled."""
    hot = spark.range(100_000, numPartitions=4).select(
        F.when(F.col("id") % 10 < 9, "HOT").otherwise(F.col("id").cast("string")).alias("ticker"),
        F.col("id").alias("position"),
    )
    last = keyed.keep_last(hot, ["ticker"], ["position"])
    plan = last._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.index("Partial"), plan.index("Exchange")
    assert exchange < partial
    assert last.filter("ticker = 'HOT'").first().position == 99_998
    assert last.count() == 10_001


def test_table_diff_and_fingerprint(spark):
    old = spark.createDataFrame([("A", 1.0), ("A", 1.0), ("B", None)], "t string, v double")
    same = spark.createDataFrame([("B", None), ("A", 1.0), ("A", 1.0)], "t string, v double")
    new = spark.createDataFrame([("A", 1.0), ("B", None), ("C", 2.0)], "t string, v double")
    assert keyed.table_diff(old, same).isEmpty()
    assert rows(keyed.table_diff(old, new)) == [("A", 1.0, -1), ("C", 2.0, 1)]
    assert rows(keyed.fingerprint(old)) == rows(keyed.fingerprint(same))
    assert rows(keyed.fingerprint(old)) != rows(keyed.fingerprint(new))
    without = [rows(keyed.fingerprint(df, also_without=["v"]), "n_rows", "other_hash") for df in (old, same)]
    assert without[0] == without[1] != rows(keyed.fingerprint(new, also_without=["v"]), "n_rows", "other_hash")


def test_run_summary(spark):
    status = spark.createDataFrame(
        [("prices", "A", "updated"), ("prices", "B", "updated"), ("prices", "C", "skipped")],
        "dataset string, ticker string, status string",
    )
    assert rows(summary.run_summary(status)) == [("prices", "skipped", 1), ("prices", "updated", 2)]
    assert rows(summary.updated_tickers(status)) == [("A",), ("B",)]


# --- reference --------------------------------------------------------------


def test_sector_rows_have_nulls_for_what_info_lacks(spark):
    raw = spark.createDataFrame(
        [
            ("AAPL", '{"sector": "old"}', 0),
            ("AAPL", '{"sector": "Technology", "industry": "Phones", "quoteType": "EQUITY"}', 1),
            ("SPY", "{}", 0),
        ],
        RAW_INFO,
    )
    found = reference.sector_rows(reference.parse_info(raw), RUN_DATE)
    assert rows(found, "ticker", "sector", "industry", "quote_type") == [
        ("AAPL", "Technology", "Phones", "EQUITY"),
        ("SPY", None, None, None),
    ]


def test_metadata_falls_back(spark):
    raw = spark.createDataFrame(
        [
            ("A", '{"longName": "", "shortName": "Short", "fundInceptionDate": 0, "firstTradeDateEpochUtc": 86400}', 0),
            ("B", '{"longName": "Long", "shortName": "Short", "fundInceptionDate": 172800}', 0),
        ],
        RAW_INFO,
    )
    listed = spark.createDataFrame(
        [("A", "Listed A", "x", 0), ("C", "Old C", "y", 1), ("C", "Listed C", "z", 2)],
        "ticker string, name string, category string, position bigint",
    )
    asked = keyed.request_list(spark, ["A", "B", "C"])
    found = reference.metadata_rows(asked, reference.parse_info(raw), listed, RUN_DATE)
    assert rows(found, "ticker", "name", "category", "inception_date") == [
        ("A", "Short", "x", date(1970, 1, 2)),
        ("B", "Long", None, date(1970, 1, 3)),
        ("C", "Listed C", "z", None),
    ]


def test_holdings_columns_are_found_by_name(spark):
    raw = spark.createDataFrame([("SPY", 0, "AAPL", 0.07)], ["etf", "position", "ticker", "% of Weight"])
    assert rows(reference.normalise_holdings(raw, RUN_DATE), "ticker", "name", "weight_pct") == [
        ("AAPL", None, pytest.approx(7.0))
    ]
    with pytest.raises(ValueError, match="ticker"):
        reference.normalise_holdings(raw.drop("ticker"), RUN_DATE)


def test_earnings_of_a_day_keep_the_last(spark):
    raw = spark.createDataFrame(
        [
            ("AAPL", 0, "2024-01-25 20:30:00-05:00", "amc"),
            ("AAPL", 1, "2024-01-26 08:00:00-05:00", "bmo"),
            ("AAPL", 2, "not-a-date", "amc"),
        ],
        RAW_EARNINGS,
    )
    new = events.normalise_earnings(raw, RUN_DATE)
    merged = keyed.merge_snapshot(
        spark.createDataFrame([], EARNINGS), new, EARNINGS.names, ["ticker", "date"]
    )
    assert rows(merged, "ticker", "date", "event_time") == [("AAPL", date(2024, 1, 26), "bmo")]
    other = raw.drop("Event Time").withColumnRenamed("Earnings Date", "When")
    assert rows(events.normalise_earnings(other, RUN_DATE), "event_time") == [(None,), (None,)]
    with pytest.raises(ValueError):
        events.normalise_earnings(raw.select("ticker", "position"), RUN_DATE)


def test_union_events_fills_what_a_table_lacks(spark):
    day = date(2024, 1, 1)
    earnings = spark.createDataFrame([("earnings", "A", day, "s", day, "amc")], EARNINGS)
    all_events = events.union_events(earnings, spark.createDataFrame([], EVENTS))
    assert all_events.columns == EVENTS.names
    assert rows(all_events, "event_time", "gap_pct") == [("amc", None)]


# --- universe ---------------------------------------------------------------


def test_ranking_agrees_with_brute_force(spark):
    rng = random.Random(5)
    data = []
    for ticker in [f"T{i}" for i in range(12)]:
        for day in rng.sample(range(1, 29), rng.randint(0, 20)):
            close = rng.choice([None, float(rng.randint(1, 50))])
            data.append((ticker, date(2024, 1, day), close, close, close, close, rng.randint(0, 9), close))
    candidates = [(f"T{i}", f"Fund {i}", "x") for i in range(10)]
    means = {}
    for ticker, _, _ in candidates:
        usable = sorted((b[1], b[5] * b[6]) for b in data if b[0] == ticker and b[5] is not None and b[1].day > 8)
        if usable:
            recent = [v for _, v in usable[-5:]]
            means[ticker] = sum(recent) / len(recent)
    expected = sorted(means.items(), key=lambda m: (-m[1], m[0]))[:4]
    found = universe.rank_by_dollar_volume(
        spark.createDataFrame(data, BARS),
        spark.createDataFrame(candidates, "ticker string, name string, category string"),
        date(2024, 1, 28),
        days=5,
        lookback_days=20,
        top_n=4,
    )
    assert rows(found, "rank", "ticker") == [(i + 1, t) for i, (t, _) in enumerate(expected)]
    assert [v for _, v in rows(found, "rank", "avg_dollar_volume")] == pytest.approx([m for _, m in expected])


@pytest.mark.parametrize("hashed", [keyed.fingerprint, keyed.portable_fingerprint])
def test_content_hashes_tell_nulls_apart(spark, hashed):
    schema = "industry string, sector string"
    hashes = [
        hashed(spark.createDataFrame([row], schema)).first()["content_hash"]
        for row in [(None, "X"), ("X", None), ("X", ""), ("", "X"), ("1:X", None), (None, None), ("null", None), ("a,1:b", "c"), ("a", "b,1:c")]
    ]
    assert len(set(hashes)) == len(hashes)


def test_keep_last_does_not_depend_on_arrival(spark):
    data = [("A", 0, x) for x in ("b", "c", "a")]
    for rotated in (data, data[1:] + data[:1], data[2:] + data[:2]):
        df = spark.createDataFrame(rotated, "k string, position int, v string").repartition(3)
        assert rows(keyed.keep_last(df, ["k"], ["position"]), "v") == [("c",)]


def test_absent_wide_tickers_are_left_out(spark):
    fields = ["Open", "High", "Low", "Close", "Adj Close", "Volume"]
    wide = spark.createDataFrame([("2024-01-02", *[1.0] * 6)], "Date string, " + ", ".join(f"`A|{f}` double" for f in fields))
    assert rows(B.wide_to_long(wide, ["A", "B"]), "ticker", "close") == [("A", 1.0)]
    assert B.absent_tickers(wide, ["A", "B"]) == ["B"]
    assert B.wide_to_long(wide, ["B"]).isEmpty()
