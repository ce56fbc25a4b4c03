"""Reference snapshots: sectors, ETF metadata, ETF holdings."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import (
    epoch_date,
    find_weight_column,
    first_text,
    nan_to_null,
    require_columns,
)
from tidemark.operators.keyed import keep_last
from tidemark.schemas import (
    ETF_HOLDINGS,
    ETF_METADATA,
    SECTORS,
    SOURCE_HOLDINGS,
    SOURCE_INFO,
)

INFO_FIELDS = (
    "sector string, industry string, quoteType string, longName string, shortName string, "
    "fundInceptionDate string, firstTradeDateEpochUtc string"
)


def parse_info(raw_info: DataFrame) -> DataFrame:
    """The newest info document per ticker, its fields as columns.

    Fields a document lacks, and all fields of an empty one, are NULL.
    """
    newest = keep_last(raw_info, ["ticker"], ["position"])
    return newest.select("ticker", F.from_json("info_json", INFO_FIELDS).alias("info")).select(
        "ticker", "info.*"
    )


def sector_rows(info: DataFrame, run_date: date) -> DataFrame:
    """Parsed info to sector rows."""
    return info.select(
        "ticker",
        "sector",
        "industry",
        F.col("quoteType").alias("quote_type"),
        F.lit(SOURCE_INFO).alias("source"),
        F.lit(run_date).alias("retrieved_at"),
    ).select(*SECTORS.names)


def metadata_rows(
    requested: DataFrame, info: DataFrame, universe: DataFrame, run_date: date
) -> DataFrame:
    """A metadata row per requested ETF, also for those without info.

    ``universe`` has a ``position``; of rows with the same ticker the last
    counts. The name falls back to the universe's; the category is always the
    universe's; the inception date falls back to the first trade date.
    """
    named = keep_last(universe, ["ticker"], ["position"]).select(
        "ticker", F.col("name").alias("universe_name"), "category"
    )
    return (
        requested.join(info, "ticker", "left")
        .join(named, "ticker", "left")
        .select(
            "ticker",
            first_text(F.col("longName"), F.col("shortName"), F.col("universe_name")).alias("name"),
            "category",
            F.coalesce(
                epoch_date(F.col("fundInceptionDate")), epoch_date(F.col("firstTradeDateEpochUtc"))
            ).alias("inception_date"),
            F.lit(SOURCE_INFO).alias("source"),
            F.lit(run_date).alias("retrieved_at"),
        )
        .select(*ETF_METADATA.names)
    )


def normalise_holdings(raw: DataFrame, run_date: date) -> DataFrame:
    """Delivered holdings to store rows; the weight, a fraction, to percent.

    The weight column is found by name. A delivery without names or weights
    gives NULLs; one without symbols is an error.
    """
    columns = raw.columns
    symbol = "Symbol" if "Symbol" in columns else "ticker"
    require_columns(columns, ["etf", "position", symbol], "raw holdings")
    name = next((c for c in ("Name", "name") if c in columns), None)
    weight = find_weight_column(columns)
    percent = (
        nan_to_null(F.col(f"`{weight}`").cast("string").try_cast("double")) * 100.0
        if weight
        else F.lit(None).cast("double")
    )
    return raw.select(
        "etf",
        F.col("position").cast("bigint").alias("position"),
        F.col(symbol).alias("ticker"),
        (F.col(name) if name else F.lit(None).cast("string")).alias("name"),
        percent.alias("weight_pct"),
        F.lit(SOURCE_HOLDINGS).alias("source"),
        F.lit(run_date).alias("retrieved_at"),
    ).select(*ETF_HOLDINGS.names)


def constituents(holdings: DataFrame, etf: str) -> DataFrame:
    """Tickers one ETF holds, in delivered order."""
    return holdings.filter(F.col("etf") == etf).orderBy("position").select("position", "ticker")
