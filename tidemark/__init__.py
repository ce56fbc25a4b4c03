"""Daily market data on Spark: ingest, keyed snapshots, event detection."""

from tidemark.operators.summary import run_summary, updated_tickers
from tidemark.plans.market import (
    DerivedEvents,
    LoadedPrices,
    PriceIngest,
    StoreIngest,
    build_etfs,
    build_sp500,
    ingest_all,
    ingest_derived_events,
    ingest_earnings,
    ingest_etf_constituents,
    ingest_etf_metadata,
    ingest_events,
    ingest_prices,
    ingest_reference,
    ingest_sectors,
    load_etf_constituents,
    load_etf_holdings,
    load_etf_metadata,
    load_events,
    load_prices,
    load_sectors,
    load_universe,
    store_fingerprint,
)
from tidemark.schemas import Config, Thresholds
from tidemark.sources.files import UniverseSnapshotMissing, data_store_manifest, write_manifest

__all__ = [
    "Config",
    "DerivedEvents",
    "LoadedPrices",
    "PriceIngest",
    "StoreIngest",
    "Thresholds",
    "UniverseSnapshotMissing",
    "build_etfs",
    "build_sp500",
    "data_store_manifest",
    "ingest_all",
    "ingest_derived_events",
    "ingest_earnings",
    "ingest_etf_constituents",
    "ingest_etf_metadata",
    "ingest_events",
    "ingest_prices",
    "ingest_reference",
    "ingest_sectors",
    "load_etf_constituents",
    "load_etf_holdings",
    "load_etf_metadata",
    "load_events",
    "load_prices",
    "load_sectors",
    "load_universe",
    "run_summary",
    "store_fingerprint",
    "updated_tickers",
    "write_manifest",
]
