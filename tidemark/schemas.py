"""Table schemas, thresholds and fixed labels."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
}


def _schema(columns: str) -> T.StructType:
    """Columns as "name type, ..."; unlike a DDL parse, this needs no session."""
    pairs = [c.strip().rsplit(" ", 1) for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Tables, their columns and types.
BARS = _schema(
    "ticker string, date date, open double, high double, low double, "
    "close double, volume bigint, adj_close double"
)
LAST_DATES = _schema("ticker string, last_date date, bars bigint")

SP500 = _schema(
    "ticker string, name string, sector string, weight_pct double, source string, retrieved_at date"
)
ETFS = _schema(
    "ticker string, name string, category string, avg_dollar_volume double, rank int, "
    "source string, retrieved_at date"
)
ETF_CANDIDATES = _schema("ticker string, name string, category string")

SECTORS = _schema(
    "ticker string, sector string, industry string, quote_type string, source string, retrieved_at date"
)
ETF_METADATA = _schema(
    "ticker string, name string, category string, inception_date date, source string, retrieved_at date"
)
# position keeps the delivery order of the holdings, which is their weight order.
ETF_HOLDINGS = _schema(
    "etf string, position bigint, ticker string, name string, weight_pct double, "
    "source string, retrieved_at date"
)

# The event types and their columns.
EVENT_COMMON = ["event_type", "ticker", "date", "source", "created_at"]
EVENT_COLUMNS = {
    "earnings": [*EVENT_COMMON, "event_time"],
    "drawdowns": [*EVENT_COMMON, "window_days", "threshold_pct", "drawdown_pct", "peak_date"],
    "gaps": [*EVENT_COMMON, "threshold_pct", "gap_pct", "prior_close", "open"],
    "volume_spikes": [
        *EVENT_COMMON,
        "window_days",
        "zscore_threshold",
        "volume_zscore",
        "volume",
        "trailing_mean",
        "trailing_std",
    ],
}
DERIVED_TYPES = ["drawdowns", "gaps", "volume_spikes"]

# One row layout for every event type; columns foreign to a type are NULL.
EVENTS = _schema(
    "event_type string, ticker string, date date, source string, created_at date, "
    "event_time string, window_days int, threshold_pct double, drawdown_pct double, "
    "peak_date date, gap_pct double, prior_close double, open double, "
    "zscore_threshold double, volume_zscore double, volume bigint, "
    "trailing_mean double, trailing_std double"
)
# Row count and content hashes per event type and bucket of tickers.
CONTENT = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("content_hash", T.DecimalType(38, 0)),
        T.StructField("undated_hash", T.DecimalType(38, 0)),
    ]
)
# The last bar of each ticker that events were derived from, the batch that last
# replaced its bars, the settings, and the batch of events that says so.
SEEN = _schema("ticker string, last_date date, replaced_by bigint, basis string, version bigint")
EARNINGS = T.StructType([EVENTS[c] for c in EVENT_COLUMNS["earnings"]])

STATUS = _schema("dataset string, ticker string, status string, reason string")

# Landing tables: raw rows as an outside feed delivers them. position orders
# rows that share a key; the highest one is the most recent delivery.
RAW_PRICES = _schema(
    "ticker string, Date date, Open double, High double, Low double, Close double, "
    "Adj Close double, Volume double, position bigint"
)
RAW_INFO = _schema("ticker string, info_json string, position bigint")
RAW_HOLDINGS = _schema(
    "etf string, position bigint, Symbol string, Name string, Holding Percent string"
)
RAW_EARNINGS = _schema(
    "ticker string, position bigint, Earnings Date string, Event Time string"
)

# The labels stored in the source columns.
SOURCE_INFO = "yfinance .info"
SOURCE_HOLDINGS = "yfinance funds_data.top_holdings"
SOURCE_EARNINGS = "yfinance earnings dates"
SOURCE_DERIVED = "derived from local prices"
SOURCE_SP500 = "iShares IVV holdings"
SOURCE_ETFS = "yfinance 30d avg dollar volume"

# Defaults of the ingest and of the ETF ranking.
DEFAULT_START = date(2000, 1, 1)
TOP_ETFS = 50
RANKING_DAYS = 30
RANKING_LOOKBACK_DAYS = 90


@dataclass(frozen=True)
class Thresholds:
    """Detector settings; the defaults are fixed values. Windows count rows of a series, not calendar days."""

    drawdown_threshold_pct: float = 0.20
    drawdown_window_days: int = 60
    gap_threshold_pct: float = 0.05
    volume_spike_zscore: float = 3.0
    volume_spike_window_days: int = 20


@dataclass(frozen=True)
class Config:
    """Where the store, the landing tables and the universe files live.

    run_date stamps provenance columns; the default is the day of the run.
    """

    data_dir: str
    landing_dir: str
    universe_dir: str
    events: Thresholds = field(default_factory=Thresholds)
    run_date: date | None = None
