"""The tables of the store: their rows, keys, layout and what is kept beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import BARS, CONTENT, EARNINGS, ETF_HOLDINGS, ETF_METADATA, EVENTS, LAST_DATES, SECTORS, SEEN
from tidemark.sources.landing import ASKED, LANDED, newest_asked, newest_landed
from tidemark.sources.store import Table

#: Tickers whose events are hashed, compared and replaced together.
BUCKETS = 1024
BUCKET = f"CAST(pmod(hash(ticker), {BUCKETS}) AS INT)"


def _last(df: DataFrame) -> DataFrame:
    return df.groupBy("ticker").agg(F.max("last_date").alias("last_date"), F.sum("bars").alias("bars"))


def _content(df: DataFrame) -> DataFrame:
    return df.groupBy("event_type", "bucket").agg(
        *(F.sum(c).cast(CONTENT[c].dataType).alias(c) for c in ("n_rows", "content_hash", "undated_hash"))
    )


def newest_version(df: DataFrame) -> DataFrame:
    """The rows of each ticker that were written last."""
    newest = F.max("version").over(Window.partitionBy("ticker"))
    return df.withColumn("_newest", newest).filter("version = _newest").drop("_newest")


#: The newest delivery of each key that a stream has brought.
DELIVERED = T.StructType([T.StructField("key", T.StringType()), T.StructField("delivery", T.LongType())])


def newest_delivered(df: DataFrame) -> DataFrame:
    return df.groupBy("key").agg(F.max("delivery").alias("delivery"))


_LEDGER = {"landed": LANDED, "asked": ASKED}
_REDUCE_LEDGER = {"landed": newest_landed, "asked": newest_asked}
_BESIDE = {**_LEDGER, "delivered": DELIVERED}
_REDUCE_BESIDE = {**_REDUCE_LEDGER, "delivered": newest_delivered}

PRICES = Table(
    "prices",
    BARS,
    "ticker",
    sort=("ticker", "date"),
    spread=True,
    parts={"last": LAST_DATES, **_LEDGER},
    keyed=("rows", "last"),
    reduce={"last": _last, **_REDUCE_LEDGER},
)
SECTOR_ROWS = Table("sectors", SECTORS, "ticker", sort=("ticker",), parts=_BESIDE, reduce=_REDUCE_BESIDE)
METADATA = Table("etf_metadata", ETF_METADATA, "ticker", sort=("ticker",), parts=_BESIDE, reduce=_REDUCE_BESIDE)
HOLDINGS = Table(
    "etf_holdings",
    ETF_HOLDINGS,
    "etf",
    sort=("etf", "position"),
    partition_by=("etf",),
    spread=True,
    parts=_BESIDE,
    reduce=_REDUCE_BESIDE,
)
EARNINGS_ROWS = Table("earnings", EARNINGS, "ticker", sort=("ticker", "date"), parts=_BESIDE, reduce=_REDUCE_BESIDE)
#: Beside events: hashes per bucket; the last bar of each ticker they were derived
#: from; and the last bars of each ticker, as many as an event can look back on.
DERIVED = Table(
    "derived_events",
    T.StructType([*EVENTS, T.StructField("bucket", T.IntegerType())]),
    "bucket",
    sort=("event_type", "ticker", "date"),
    partition_by=("event_type",),
    parts={
        "content": CONTENT,
        "seen": SEEN,
        "tail": T.StructType([*BARS, T.StructField("version", T.LongType())]),
    },
    keyed=("rows", "content"),
    reduce={"content": _content, "seen": newest_version, "tail": newest_version},
)
ALL = (PRICES, SECTOR_ROWS, METADATA, HOLDINGS, EARNINGS_ROWS, DERIVED)
