"""Registered queries over the test tables, and their SQL counterparts."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import bars as B
from tidemark.operators import detectors, events, keyed, reference, summary, universe
from tidemark.plans import market, standins
from tidemark.plans.tables import DERIVED, HOLDINGS, PRICES
from tidemark.schemas import ETFS, Config, Thresholds
from tidemark.session import prepare, shared_folder
from tidemark.sources import files
from tidemark.sources.store import TableStore

Query = Callable[[SparkSession, str], DataFrame]

RUN_DATE = date(2024, 2, 1)
STANDARD = Thresholds()
# Prices in the test tables jump about, so that the defaults flag most days.
STRICT = Thresholds(drawdown_threshold_pct=0.98, gap_threshold_pct=40.0)
# About ten years of trading days.
LONG = Thresholds(drawdown_window_days=2_500, drawdown_threshold_pct=0.98, gap_threshold_pct=40.0)

# The price ingest: what is stored, and what is delivered on top of it.
EARLIEST = date(1990, 1, 1)
LAST_STORED = date(1998, 12, 31)
# The last bars of the test tables are of 2001 or before.
INCREMENT_YEARS = range(1992, 2005)
CUTOFF = date(1999, 1, 1)
DELIVERED_FROM = date(1998, 12, 22)
DELIVERED_TO = date(2024, 2, 1)
UNSTORED = "Brand#7"

RANKED_ON = date(2001, 11, 4)
LOADED_FROM, LOADED_TO = date(1996, 3, 1), date(1998, 2, 28)


# Results of summing doubles, whose last digits depend on the order of rows.
INEXACT = {"avg_dollar_volume"}


def _rounded(df: DataFrame) -> DataFrame:
    """Inexact columns to six places, for comparison across engines."""
    return df.select(*[F.round(c, 6).alias(c) if c in INEXACT else F.col(c) for c in df.columns])


# --- events -----------------------------------------------------------------


def _detector(detect, thresholds: Thresholds, split_rows: int | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _rounded(detect(standins.bars(spark, sf_dir), thresholds, RUN_DATE, split_rows))

    return run


def earnings_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised earnings, one per ticker and day."""
    rows = events.normalise_earnings(standins.raw_earnings(spark, sf_dir), RUN_DATE)
    return keyed.keep_last(rows, ["ticker", "date"], ["position"]).drop("position")


def all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = detectors.detect_events(standins.bars(spark, sf_dir), STANDARD, RUN_DATE)
    return events.union_events(earnings_rows(spark, sf_dir), derived)


def events_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(events.select_events(all_events(spark, sf_dir), "all"))


def events_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = events.select_events(
        all_events(spark, sf_dir), "all", ["Brand#3", "Brand#12", "17"], LOADED_FROM, RUN_DATE
    )
    return _rounded(chosen)


# --- prices -----------------------------------------------------------------


def brand_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every brand once, at the place where it first occurs."""
    parts = standins.table(spark, sf_dir, "part")
    return keyed.unique_ordered(
        parts.select(F.col("p_partkey").alias("position"), F.col("p_brand").alias("ticker"))
    )


def brand_and_type_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands, which have bars, and part types, which have none."""
    parts = standins.table(spark, sf_dir, "part")
    names = F.explode(F.array("p_brand", "p_type"))
    return keyed.unique_ordered(parts.select(F.col("p_partkey").alias("position"), names.alias("ticker")))


def load_prices_adjusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded, _ = B.load_bars(standins.bars(spark, sf_dir), brand_request(spark, sf_dir))
    return loaded


def load_prices_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = standins.bars(spark, sf_dir, LOADED_FROM, LOADED_TO)
    loaded, _ = B.load_bars(bars, brand_request(spark, sf_dir), LOADED_FROM, LOADED_TO, adjusted=False)
    return loaded


def missing_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = LOADED_FROM
    bars = standins.bars(spark, sf_dir, day, day)
    _, missing = B.load_bars(bars, brand_and_type_request(spark, sf_dir), day, day)
    return missing


def _stored_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = standins.bars(spark, sf_dir, end=LAST_STORED)
    return B.last_dates(stored.filter(F.col("ticker") != UNSTORED))


def _as_delivered(bars: DataFrame) -> DataFrame:
    """Bars under the names of a delivery."""
    return bars.select("ticker", *[F.col(name).alias(raw) for raw, name in B.RAW_TO_BAR.items()])


def _delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars around and after the cut-off, delivered twice, the close revised."""
    raw = _as_delivered(standins.bars(spark, sf_dir, DELIVERED_FROM, DELIVERED_TO))
    twice = raw.withColumn("position", F.explode(F.array(F.lit(0), F.lit(1))))
    return twice.withColumn("Close", F.expr("Close * if(position = 1, 1.01D, 1.0D)"))


def _price_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.fetch_windows(
        brand_and_type_request(spark, sf_dir), _stored_last(spark, sf_dir), CUTOFF, DELIVERED_TO
    )


def price_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable, _ = B.split_rejects(B.read_bars(_delivered(spark, sf_dir)))
    return B.price_increment(usable, _price_windows(spark, sf_dir))


def price_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable, _ = B.split_rejects(B.read_bars(_delivered(spark, sf_dir)))
    windows = _price_windows(spark, sf_dir)
    taken = B.price_increment(usable, windows).select("ticker").distinct()
    return B.price_status(windows, taken)


def price_status_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Asked for up to a day that most tickers already have, with nothing delivered."""
    end = date(1998, 12, 30)
    windows = B.fetch_windows(brand_and_type_request(spark, sf_dir), _stored_last(spark, sf_dir), EARLIEST, end)
    return B.price_status(windows, windows.filter("false").select("ticker"))


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.run_summary(price_status(spark, sf_dir))


def updated_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.updated_tickers(price_status(spark, sf_dir))


def last_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.last_dates(standins.bars(spark, sf_dir))


def wide_to_long_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars spread to a column per ticker and field, and folded back."""
    # A wide table has a column for each of them, so a list of them fits anywhere.
    tickers = [r["ticker"] for r in brand_request(spark, sf_dir).orderBy("position").collect()]
    return B.wide_to_long(_wide(standins.bars(spark, sf_dir), tickers), tickers)


def _wide(bars: DataFrame, tickers: list[str]) -> DataFrame:
    """Bars with a column per ticker and field, under the names of a delivery."""
    fields = {raw: name for raw, name in B.RAW_TO_BAR.items() if raw != "Date"}
    wide = (
        bars.groupBy(F.col("date").alias("Date"))
        .pivot("ticker", tickers)
        .agg(*[F.max(name).alias(raw) for raw, name in fields.items()])
    )
    return wide.toDF("Date", *[f"{t}|{raw}" for t in tickers for raw in fields])


# --- keyed tables -----------------------------------------------------------

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standins.table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)


def merge_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even orders are stored; odd ones and every tenth are new; one segment's
    customers are refreshed."""
    orders = _orders(spark, sf_dir)
    key = F.col("o_orderkey")
    existing = orders.filter(key % 2 == 0)
    new = orders.filter((key % 2 == 1) | (key % 10 == 0)).withColumn(
        "o_totalprice", F.col("o_totalprice") * 2
    )
    refreshed = (
        standins.table(spark, sf_dir, "customer")
        .filter("c_mktsegment = 'BUILDING'")
        .select(F.col("c_custkey").alias("o_custkey"))
    )
    return keyed.merge_snapshot(existing, new, ORDER_COLUMNS, ["o_orderkey"], refreshed, "o_custkey")


def missing_from_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an urgent order."""
    customers = standins.table(spark, sf_dir, "customer")
    urgent = standins.table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    requested = customers.select(F.col("c_custkey").alias("position"), F.col("c_custkey").alias("ticker"))
    return keyed.missing_from_snapshot(requested, urgent.select(F.col("o_custkey").alias("ticker")))


def snapshot_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urgent orders got dearer: each differs once as gone, once as new."""
    old = _orders(spark, sf_dir)
    dearer = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1)
    new = old.withColumn("o_totalprice", dearer.otherwise(F.col("o_totalprice")))
    return keyed.table_diff(old, new)


def content_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = [
        keyed.portable_fingerprint(standins.table(spark, sf_dir, name)).select(
            F.lit(name).alias("table"), "n_rows", F.col("content_hash").cast("string").alias("content_hash")
        )
        for name in ("orders", "lineitem", "events")
    ]
    return reduce(DataFrame.unionByName, totals)


# --- reference --------------------------------------------------------------


def sectors_from_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference.sector_rows(reference.parse_info(standins.raw_info(spark, sf_dir)), RUN_DATE)


def metadata_from_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as ETFs; those with a user's events have info."""
    listed = standins.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("position"),
        F.col("c_custkey").cast("string").alias("ticker"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("category"),
    )
    info = reference.parse_info(standins.raw_info(spark, sf_dir))
    return reference.metadata_rows(listed.select("ticker"), info, listed, RUN_DATE)


def holdings_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference.normalise_holdings(standins.raw_holdings(spark, sf_dir), RUN_DATE)


def constituents(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = reference.normalise_holdings(standins.raw_holdings(spark, sf_dir), RUN_DATE)
    return reference.constituents(held, "ASIA")


# --- universe ---------------------------------------------------------------


def ticker_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return universe.sp500_rows(standins.dirty_records(spark, sf_dir), RUN_DATE)


def ticker_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = universe.ticker_rejects(standins.dirty_records(spark, sf_dir))
    return rejects.select("p_partkey", "raw_ticker", "ticker")


def universe_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = standins.table(spark, sf_dir, "supplier")
    customers = standins.table(spark, sf_dir, "customer")
    return universe.universe_union(
        suppliers.select(F.col("s_suppkey").alias("position"), F.col("s_name").alias("ticker")),
        customers.select(F.col("c_custkey").alias("position"), F.col("c_name").alias("ticker")),
    )


def etf_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = standins.etf_bars(spark, sf_dir, start=date(2001, 8, 6), end=RANKED_ON)
    ranked = universe.rank_by_dollar_volume(bars, standins.etf_candidates(spark, sf_dir), RANKED_ON)
    return _rounded(ranked)


def etf_rank_top50(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked over the whole history's last bars, however far back they are."""
    candidates = standins.etf_candidates(spark, sf_dir)
    ranked = universe.rank_by_dollar_volume(
        standins.etf_bars(spark, sf_dir), candidates, RANKED_ON, lookback_days=4000
    )
    return _rounded(ranked.select("ticker", "avg_dollar_volume", "rank"))


# --- files ------------------------------------------------------------------

# A feed file holds the parts of this many consecutive keys at most.
PARTS_PER_FILE = 500
HOLDINGS_PRELUDE = ["Holdings of a fund", 'Fund Holdings as of,"Feb 01, 2024"', ""]
# Files take turns with these columns.
HOLDINGS_HEADERS = ["Ticker,Name,Sector,Asset Class,Weight (%)", "Ticker,Weight (%),Asset Class,Other,Sector,Name"]


def write_holdings_feed(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The dirty records as CSV files with a byte order mark and a prelude."""
    records = standins.dirty_records(spark, sf_dir).withColumn(
        "file", F.floor(F.col("p_partkey") / PARTS_PER_FILE)
    )
    name = F.concat(F.lit('"'), "name", F.lit(', ""x"""'))
    first = F.concat_ws(",", "raw_ticker", name, "sector", "asset_class", "weight_pct")
    second = F.concat_ws(",", "raw_ticker", "weight_pct", "asset_class", F.lit("-"), "sector", name)
    row = F.when(F.col("file") % 2 == 0, first).otherwise(second)
    top = ["\ufeff" + HOLDINGS_PRELUDE[0], *HOLDINGS_PRELUDE[1:]]
    header = F.when(F.col("file") % 2 == 0, HOLDINGS_HEADERS[0]).otherwise(HOLDINGS_HEADERS[1])
    above = F.posexplode(F.array(*[F.lit(line) for line in top], header))
    top.append("header")
    preludes = records.select("file").distinct().select("file", above.alias("place", "value"))
    lines = preludes.unionByName(
        records.select("file", (F.col("p_partkey") + len(top)).alias("place"), row.alias("value"))
    )
    ordered = lines.repartition("file").sortWithinPartitions("file", "place").select("file", "value")
    ordered.write.partitionBy("file").text(path)


def dirty_csv_holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/holdings-{uuid.uuid4().hex}"
    write_holdings_feed(spark, sf_dir, path)
    records, _ = universe.holdings_records(files.read_holdings_lines(spark, path), files.are_few(spark, path))
    return universe.sp500_rows(records, RUN_DATE)


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.data_store_manifest(spark, sf_dir)


def manifest_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of text files, one for each region, written from the nations."""
    path = f"{shared_folder(spark)}/manifest-{uuid.uuid4().hex}"
    lines = standins.table(spark, sf_dir, "nation").select(
        F.concat_ws(",", "n_nationkey", "n_name").alias("value"), F.col("n_regionkey").alias("region"), "n_nationkey"
    )
    ordered = lines.repartition("region").sortWithinPartitions("region", "n_nationkey").drop("n_nationkey")
    ordered.write.partitionBy("region").text(path)
    files.write_manifest(spark, path, f"{path}.csv")
    written = spark.read.schema("path string, size_bytes bigint, sha256 string").option("header", True).csv(f"{path}.csv")
    return written.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"), "size_bytes", "sha256")


# --- the store --------------------------------------------------------------


def _new_store(spark: SparkSession, thresholds: Thresholds = STANDARD) -> Config:
    folder = f"{shared_folder(spark)}/market-{uuid.uuid4().hex}"
    return Config(
        f"{folder}/store", f"{folder}/landing", f"{folder}/universe", thresholds, RUN_DATE
    )


def store_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars up to the cut-off ingested, then the delivery around it; loaded."""
    config = _new_store(spark)
    asked = brand_and_type_request(spark, sf_dir)
    first = standins.bars(spark, sf_dir, end=LAST_STORED).filter(F.col("ticker") != UNSTORED)
    market.ingest_prices(
        asked, start_date=EARLIEST, end_date=LAST_STORED, config=config, landed=_as_delivered(first)
    )
    market.ingest_prices(
        asked,
        start_date=CUTOFF,
        end_date=DELIVERED_TO,
        config=config,
        landed=_delivered(spark, sf_dir),
    )
    return market.load_prices(asked, adjusted=False, config=config).df


def store_prices_forced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All bars ingested, in two parts; then some brands delivered anew from a day on, and replaced."""
    config = _new_store(spark)
    asked = brand_request(spark, sf_dir)
    for start, end in ((EARLIEST, LAST_STORED), (CUTOFF, DELIVERED_TO)):
        landed = _as_delivered(standins.bars(spark, sf_dir, start, end))
        market.ingest_prices(asked, start_date=start, end_date=end, config=config, landed=landed)
    some = asked.filter("ticker LIKE 'Brand#1%'")
    revised = _delivered(spark, sf_dir).filter("ticker LIKE 'Brand#1%'")
    market.ingest_prices(some, start_date=DELIVERED_FROM, end_date=DELIVERED_TO, force=True, config=config, landed=revised)
    return market.load_prices(asked, adjusted=False, config=config).df


def store_prices_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars landed wide, ingested; later ones landed as rows, and only those files opened."""
    config = _new_store(spark)
    asked = brand_request(spark, sf_dir)
    tickers = [r["ticker"] for r in asked.orderBy("position").collect()]  # a column for each of them
    _wide(standins.bars(spark, sf_dir, end=LAST_STORED), tickers).write.parquet(f"{config.landing_dir}/raw_prices_wide")
    market.ingest_prices(asked, start_date=EARLIEST, config=config)
    later = _as_delivered(standins.bars(spark, sf_dir, start=CUTOFF))
    later.withColumn("position", F.lit(0)).write.parquet(f"{config.landing_dir}/raw_prices")
    market.ingest_prices(asked, start_date=EARLIEST, config=config)
    return market.load_prices(asked, adjusted=False, config=config).df


def store_prices_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of stored bars, those that do not follow the row before them in their
    file, and files whose range of (ticker, date) meets that of the one before."""
    config = _new_store(spark)
    landed = _as_delivered(standins.bars(spark, sf_dir))
    market.ingest_prices(brand_request(spark, sf_dir), start_date=EARLIEST, config=config, landed=landed)
    (batch,) = TableStore(spark, config.data_dir).batches(PRICES)
    key = F.struct("ticker", "date")
    rows = spark.read.parquet(batch.part("rows")).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), key.alias("key")
    )
    before = F.lag("key").over(Window.partitionBy("file").orderBy("row"))
    per_file = (
        rows.withColumn("ordered", before.isNull() | (before < F.col("key")))
        .groupBy("file")
        .agg(F.count("*").alias("n"), F.sum(F.when(~F.col("ordered"), 1).otherwise(0)).alias("wrong"), F.min("key").alias("low"), F.max("key").alias("high"))
    )
    # One row per file.
    meets = F.lag("high").over(Window.orderBy("low")) >= F.col("low")
    return per_file.withColumn("meets", meets).agg(
        F.sum("n").alias("n_rows"),
        F.sum("wrong").alias("n_out_of_order"),
        F.sum(F.when(F.col("meets"), 1).otherwise(0)).alias("n_overlapping_files"),
    )


def store_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars ingested in two parts, the events of each derived as it comes."""
    config = _new_store(spark, STRICT)
    asked = brand_request(spark, sf_dir)
    for start, end in ((EARLIEST, LAST_STORED), (CUTOFF, RUN_DATE)):
        landed = _as_delivered(standins.bars(spark, sf_dir, start, end))
        market.ingest_prices(asked, start_date=start, end_date=end, config=config, landed=landed)
        market.ingest_derived_events(asked, config=config, incremental=True)
    return _rounded(market.load_events("all", config=config))


def store_sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' info landed; sectors ingested for half of the users, then for all."""
    config = _new_store(spark)
    standins.raw_info(spark, sf_dir).write.parquet(f"{config.landing_dir}/raw_info")
    users = standins.table(spark, sf_dir, "events").selectExpr(
        "user_id AS position", "CAST(user_id AS STRING) AS ticker"
    )
    asked = keyed.unique_ordered(users)
    market.ingest_sectors(asked.filter("position % 2 = 0"), config=config)
    market.ingest_sectors(asked, config=config)
    return market.load_sectors(config=config)


def store_events_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars ingested year by year, events derived after each on another day, batches copied together between."""
    config = _new_store(spark, STRICT)
    asked = brand_request(spark, sf_dir)
    for k, year in enumerate(INCREMENT_YEARS):
        start, end = (EARLIEST if k == 0 else date(year, 1, 1)), date(year, 12, 31)
        day = replace(config, run_date=date(2024, 1, 1 + k))
        landed = _as_delivered(standins.bars(spark, sf_dir, start, end))
        market.ingest_prices(asked, start_date=start, end_date=end, config=day, landed=landed)
        market.ingest_derived_events(asked, config=day, incremental=True)
        if k % 4 == 3:  # whatever their sizes
            for table in (PRICES, DERIVED):
                store = TableStore(spark, config.data_dir)
                store.merge_newest(table, len(store.batches(table)))
    return _rounded(market.load_events("all", config=config))


def store_holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holdings delivered, ingested, delivered anew for some funds with fewer rows, and refreshed."""
    config = _new_store(spark)
    raw = standins.raw_holdings(spark, sf_dir)
    funds = raw.select(F.dense_rank().over(Window.orderBy("etf")).alias("position"), F.col("etf").alias("ticker")).distinct()
    landing = f"{config.landing_dir}/raw_holdings"
    raw.withColumn("delivery", F.lit(1)).write.parquet(landing)
    market.ingest_etf_constituents(funds, config=config)
    newer = raw.filter("etf < 'ASIB' AND position % 2 = 0").withColumn("Name", F.concat(F.lit("New "), "Name"))
    newer.withColumn("delivery", F.lit(2)).write.mode("append").parquet(landing)
    market.ingest_etf_constituents(funds, force=True, config=config)
    return TableStore(spark, config.data_dir).read(HOLDINGS)


def store_earnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earnings delivered, ingested, delivered anew for some users with some dates withdrawn, and refreshed."""
    config = _new_store(spark)
    raw = standins.raw_earnings(spark, sf_dir)
    users = keyed.unique_ordered(raw.select("position", "ticker"))
    landing = f"{config.landing_dir}/raw_earnings"
    raw.withColumn("delivery", F.lit(1)).write.parquet(landing)
    market.ingest_earnings(users, config=config)
    newer = raw.filter("CAST(ticker AS BIGINT) % 3 = 0 AND position % 4 <> 0")
    newer.withColumn("delivery", F.lit(2)).write.mode("append").parquet(landing)
    market.ingest_earnings(users, force=True, config=config)
    return market.load_events("earnings", config=config)


def store_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both universe files written, from a holdings feed and from landed prices; all tickers loaded."""
    config = replace(_new_store(spark), run_date=RANKED_ON)
    feed = f"{config.landing_dir}/feed"
    write_holdings_feed(spark, sf_dir, feed)
    market.build_sp500(feed, config=config)
    daily = standins.etf_bars(spark, sf_dir, start=date(2001, 8, 6), end=RANKED_ON)
    _as_delivered(daily).withColumn("position", F.lit(0)).write.parquet(f"{config.landing_dir}/raw_prices")
    files.write_csv(standins.etf_candidates(spark, sf_dir), f"{config.universe_dir}/etf_candidates.csv")
    market.build_etfs(config=config)
    return market.load_universe("all", config=config).select("ticker")


def store_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as ETFs, ingested before any info has landed, and taken up again after."""
    config = _new_store(spark)
    listed = standins.table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS ticker", "c_name AS name", "c_mktsegment AS category",
        "CAST(NULL AS DOUBLE) AS avg_dollar_volume", "CAST(NULL AS INT) AS rank",
        "CAST(NULL AS STRING) AS source", "CAST(NULL AS DATE) AS retrieved_at",
    )
    files.write_csv(listed, f"{config.universe_dir}/etfs.csv")
    market.ingest_etf_metadata(config=config)
    standins.raw_info(spark, sf_dir).write.parquet(f"{config.landing_dir}/raw_info")
    market.ingest_etf_metadata(retry_missing=True, config=config)
    return market.load_etf_metadata(config=config)


def store_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything ingested for brands, which have prices, and users, who have info and earnings; the outcome of each."""
    config = _new_store(spark, STRICT)
    _as_delivered(standins.bars(spark, sf_dir)).withColumn("position", F.lit(0)).write.parquet(f"{config.landing_dir}/raw_prices")
    standins.raw_info(spark, sf_dir).write.parquet(f"{config.landing_dir}/raw_info")
    standins.raw_earnings(spark, sf_dir).write.parquet(f"{config.landing_dir}/raw_earnings")
    users = standins.table(spark, sf_dir, "events").selectExpr("user_id AS position", "CAST(user_id AS STRING) AS ticker")
    asked = keyed.unique_ordered(brand_request(spark, sf_dir).unionByName(users))
    # Some brands, without info or holdings, and some users are listed as ETFs; some of those have holdings.
    listed = asked.filter("ticker LIKE 'Brand#1%' OR try_cast(ticker AS BIGINT) % 5 = 0")
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in ETFS if f.name != "ticker"]
    files.write_csv(listed.select("ticker", *nulls), f"{config.universe_dir}/etfs.csv")
    held = listed.filter("try_cast(ticker AS BIGINT) % 10 = 0").selectExpr(
        "ticker AS etf", "position", "'Brand#11' AS Symbol", "'One holding' AS Name", "'0.5' AS `Holding Percent`"
    )
    held.write.parquet(f"{config.landing_dir}/raw_holdings")
    done = market.ingest_all(asked, start_date=EARLIEST, config=config)
    return done.prices.status.unionByName(done.reference).unionByName(done.events)


def price_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as deliveries, some of whose cells cannot be read; what is turned away, and why."""
    raw = standins.table(spark, sf_dir, "events").selectExpr(
        "if(event_id % 17 = 0, NULL, event_type) AS ticker",
        "CASE event_id % 7 WHEN 0 THEN props WHEN 1 THEN '2024-13-01' ELSE CAST(CAST(ts AS DATE) AS STRING) END AS Date",
        "'1' AS Open", "'1' AS High", "'1' AS Low",
        "CASE event_id % 5 WHEN 0 THEN 'n/a' WHEN 1 THEN NULL ELSE CAST(user_id AS STRING) END AS Close",
        "'1' AS `Adj Close`",
        "if(event_id % 11 = 0, NULL, '7') AS Volume",
        "event_id AS position",
    )
    _, rejects = B.split_rejects(B.read_bars(raw))
    return rejects.select("position", "ticker", "date", "close", "volume", "reason")


def document_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and SHA-256 of every document's text."""
    docs = standins.table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.octet_length("text").cast("bigint").alias("size_bytes"), F.sha2("text", 256).alias("sha256"))


QUERIES: dict[str, Query] = {
    "drawdowns": _detector(detectors.drawdowns, STANDARD),
    "drawdowns_strict": _detector(detectors.drawdowns, STRICT),
    "gaps": _detector(detectors.gaps, STANDARD),
    "gaps_strict": _detector(detectors.gaps, STRICT),
    "volume_spikes": _detector(detectors.volume_spikes, STANDARD),
    "derived_events": _detector(detectors.detect_events, STRICT),
    "derived_events_split": _detector(detectors.detect_events, STRICT, split_rows=256),
    "drawdowns_long_window": _detector(detectors.drawdowns, LONG),
    "derived_events_long_window": _detector(detectors.detect_events, LONG),
    "events_all": events_all,
    "events_filtered": events_filtered,
    "load_prices_adjusted": load_prices_adjusted,
    "load_prices_raw": load_prices_raw,
    "missing_tickers": missing_tickers,
    "price_increment": price_increment,
    "price_status": price_status,
    "price_status_current": price_status_current,
    "run_summary": run_summary,
    "updated_tickers": updated_tickers,
    "last_dates": last_dates,
    "wide_to_long_prices": wide_to_long_prices,
    "merge_snapshot": merge_snapshot,
    "missing_from_snapshot": missing_from_snapshot,
    "snapshot_changed": snapshot_changed,
    "content_fingerprint": content_fingerprint,
    "unique_ordered": brand_request,
    "sectors_from_info": sectors_from_info,
    "metadata_from_info": metadata_from_info,
    "holdings_normalized": holdings_normalized,
    "constituents": constituents,
    "earnings_normalized": earnings_rows,
    "ticker_clean": ticker_clean,
    "ticker_rejects": ticker_rejects,
    "universe_all": universe_all,
    "etf_rank_top50": etf_rank_top50,
    "etf_enriched": etf_enriched,
    "dirty_csv_holdings": dirty_csv_holdings,
    "manifest": manifest,
    "manifest_hashes": manifest_hashes,
    "store_prices": store_prices,
    "store_prices_forced": store_prices_forced,
    "store_prices_wide": store_prices_wide,
    "store_prices_order": store_prices_order,
    "store_events": store_events,
    "store_sectors": store_sectors,
    "store_events_many": store_events_many,
    "store_holdings": store_holdings,
    "store_earnings": store_earnings,
    "store_universe": store_universe,
    "store_metadata": store_metadata,
    "store_all": store_all,
    "price_rejects": price_rejects,
    "document_hashes": document_hashes,
}


def prepared(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(prepare(spark), sf_dir)

    return run
