"""Summaries of an ingest run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_summary(status: DataFrame) -> DataFrame:
    """Tickers per dataset and status."""
    return status.groupBy("dataset", "status").agg(F.count(F.lit(1)).alias("tickers"))


def updated_tickers(status: DataFrame) -> DataFrame:
    """The distinct tickers that were updated, sorted."""
    return status.filter("status = 'updated'").select("ticker").distinct().orderBy("ticker")
