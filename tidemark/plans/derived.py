"""Refreshing the derived events, in full or by the bars that are new.

Events are hashed and compared per bucket of tickers; only buckets whose hash
differs are written, so that a refresh that changes nothing writes nothing.
Beside events stands what they were derived from: the last bar of each ticker,
the batch of bars that last replaced its history, and its last bars, as many as
an event can look back on. So an incremental refresh reads only bars stored
since, however long the history is, and derives anew only tickers whose history
was replaced. Earlier events stand, as no frame looks ahead.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import bars as B
from tidemark.operators import detectors, keyed
from tidemark.plans.tables import BUCKET, DERIVED, PRICES, newest_version
from tidemark.schemas import BARS, DERIVED_TYPES, EVENTS, Thresholds
from tidemark.session import settled
from tidemark.sources.store import Batch, TableStore

# The day before all bars, for tickers of which none has been seen.
NEVER = date(1000, 1, 1)
# Longest list of tickers that is pushed to a scan as a filter.
NAMED_TICKERS = 1_000
# What events written without state were derived from.
UNKNOWN = "unknown"


def stored_last_dates(store: TableStore) -> DataFrame:
    """The last stored date per ticker, from what each batch keeps beside it."""
    lasts = store.read(PRICES, "last")
    return lasts.groupBy("ticker").agg(
        F.max("last_date").alias("last_date"), F.sum("bars").alias("bars")
    )


def _known(store: TableStore, requested: DataFrame) -> DataFrame:
    """Requested tickers with bars: their last date, and the batch that replaced their history."""
    replaced = store.replaced(store.batches(PRICES)).select(F.col("key").alias("ticker"), "by")
    lasts = stored_last_dates(store).join(requested.select("ticker"), "ticker", "left_semi")
    return lasts.join(replaced, "ticker", "left").select(
        "ticker", "last_date", F.coalesce("by", F.lit(0)).cast("bigint").alias("replaced_by")
    )


def refresh_all(
    store: TableStore,
    requested: DataFrame,
    t: Thresholds,
    run_date: date,
    ignore_created_at: bool = False,
    keep_state: bool = False,
) -> list[str]:
    """Replace all events of the requested tickers; returns the types that changed.

    Nothing is written if no type has changed. ``keep_state`` prepares for
    `refresh_new`, at the price of a second pass over the bars.
    """
    known = _known(store, requested)
    if known.isEmpty():
        if not store.exists(DERIVED):
            batch = store.new_batch(DERIVED)
            _write_events(store, batch, store.read(DERIVED))
            store.publish(batch)
        return []
    bars, _ = B.load_bars(store.read(PRICES), requested.select("position", "ticker"), adjusted=False)
    tail = _last_rows(bars, t) if keep_state else None
    found = detectors.detect_events(bars, t, run_date)
    return _replace(store, requested, found, known, tail, basis(store, t), ignore_created_at)


def _replace(
    store: TableStore,
    tickers: DataFrame,
    found: DataFrame,
    known: DataFrame,
    tail: DataFrame | None,
    settings: str,
    ignore_created_at: bool = False,
) -> list[str]:
    """Have ``found`` be all events of some tickers, written where that differs."""
    events = found.select(*EVENTS.names, F.expr(BUCKET).alias("bucket"))
    first = not store.exists(DERIVED)
    changed: set[str] = set(DERIVED_TYPES)
    if not first:
        buckets = tickers.select(F.expr(BUCKET).alias("bucket")).distinct()
        rest = keyed.without(store.read(DERIVED).join(buckets, "bucket", "left_semi"), tickers)
        events = events.unionByName(rest.select(events.columns))
        hash_column = "undated_hash" if ignore_created_at else "content_hash"
        compared = ["event_type", "bucket", "n_rows", hash_column]
        before = DERIVED.reduce["content"](store.read(DERIVED, "content")).join(buckets, "bucket", "left_semi")
        # One row per event type and bucket at most.
        differing = keyed.table_diff(before.select(compared), _content(events).select(compared)).collect()
        changed = {r["event_type"] for r in differing}
        of = {r["bucket"] for r in differing}
        events = events.filter(F.col("bucket").isin(sorted(of)))
        if not changed and tail is None:
            return []
    batch = store.new_batch(DERIVED)
    if first or changed:
        content = _write_events(store, batch, events)
        if first:
            changed = {r["event_type"] for r in content.select("event_type").distinct().collect()}
        else:
            spark = store.spark
            store.write_replaced(spark.createDataFrame([(str(b),) for b in sorted(of)], "key string"), batch)
    _write_state(store, batch, known, tail, settings if tail is not None else UNKNOWN)
    store.publish(batch)
    store.merge(DERIVED)
    return [e for e in DERIVED_TYPES if e in changed]


def refresh_new(store: TableStore, requested: DataFrame, t: Thresholds, run_date: date) -> list[str]:
    """Add the events of bars stored since the last refresh; returns their types.

    Tickers whose stored history was replaced are derived anew. After a change
    of settings, or a refresh that kept no state, all requested tickers are.
    """
    settings = basis(store, t)
    if not store.exists(DERIVED):
        return refresh_all(store, requested, t, run_date, keep_state=True)
    past = newest_version(store.read(DERIVED, "seen")).select(
        "ticker", F.col("last_date").alias("seen_date"), F.col("replaced_by").alias("seen_by"), "basis"
    )
    # Worked out once: a row for each ticker.
    known = settled(_known(store, requested).join(past, "ticker", "left"))
    is_redone = F.col("replaced_by") > F.coalesce("seen_by", F.col("replaced_by"))
    is_new = F.col("seen_date").isNull()
    is_stale = ~is_redone & (is_new | (F.col("last_date") > F.col("seen_date")))
    other, redone, since, new = known.agg(
        F.count(F.when(F.col("basis") != settings, 1)),
        F.count(F.when(is_redone, 1)),
        F.min(F.when(is_stale & ~is_new, F.col("seen_date"))),
        F.count(F.when(is_stale & is_new, 1)),
    ).first()
    if other:
        return refresh_all(store, requested, t, run_date, keep_state=True)
    changed = set()
    if since is not None or new:
        stale = known.filter(is_stale).withColumn("seen_date", F.coalesce("seen_date", F.lit(NEVER)))
        changed |= set(_add(store, stale, since, new, t, run_date, settings))
    if redone:  # none of which is among those above
        tickers = known.filter(is_redone).select(F.lit(0).cast("bigint").alias("position"), "ticker")
        bars, _ = B.load_bars(store.read(PRICES), tickers, adjusted=False)
        found = detectors.detect_events(bars, t, run_date)
        changed |= set(_replace(store, tickers, found, known.filter(is_redone), _last_rows(bars, t), settings))
    return [e for e in DERIVED_TYPES if e in changed]


def _add(
    store: TableStore, stale: DataFrame, since: date | None, new: int, t: Thresholds, run_date: date, settings: str
) -> list[str]:
    """Add the events of the bars that tickers have got since they were seen:
    ``new`` of them never, the others on ``since`` or later."""
    is_new = F.col("seen_date") == F.lit(NEVER)
    # Tickers not seen before need all their bars; a few of them are named to the scan.
    wanted = F.lit(True)
    if new <= NAMED_TICKERS:
        names = [r["ticker"] for r in stale.filter(is_new).select("ticker").collect()] if new else []
        later = F.col("date") > F.lit(since) if since else F.lit(False)
        wanted = (later | F.col("ticker").isin(names)) if names else later
    # The bounds let the scan skip what has been seen.
    stored = B.clean_bars(store.read(PRICES).filter(wanted))
    fresh = stored.join(stale.select("ticker", "seen_date"), "ticker").filter("date > seen_date")
    tails = store.read(DERIVED, "tail").join(stale.select("ticker"), "ticker", "left_semi")
    bars = (
        newest_version(tails)
        .select(*BARS.names, F.lit(True).alias("borrowed"))
        .unionByName(fresh.select(*BARS.names, F.lit(False).alias("borrowed")))
    )
    batch = store.new_batch(DERIVED)
    found = detectors.detect_events(bars, t, run_date).withColumn("bucket", F.expr(BUCKET))
    content = _write_events(store, batch, found)
    _write_state(store, batch, stale, _last_rows(bars, t), settings)
    store.publish(batch)
    types = [r["event_type"] for r in content.select("event_type").distinct().collect()]
    store.merge(DERIVED)
    return types


def basis(store: TableStore, t: Thresholds) -> str:
    """What past events rest on: the generation of stored bars, and the thresholds."""
    batches = store.batches(PRICES)
    return f"{batches[0].generation.rsplit('/', 1)[1] if batches else None} {t}"


def _last_rows(bars: DataFrame, t: Thresholds) -> DataFrame:
    newest = Window.partitionBy("ticker").orderBy(F.desc("date"))
    age = bars.withColumn("_age", F.row_number().over(newest))
    return age.filter(F.col("_age") <= detectors.lookback_rows(t)).select(*BARS.names)


def _content(events: DataFrame) -> DataFrame:
    """Rows and hashes of events per event type and bucket."""
    return keyed.fingerprint(events, ["event_type", "bucket"], also_without=["created_at"], prefix="undated")


def _write_events(store: TableStore, batch: Batch, rows: DataFrame) -> DataFrame:
    """Write events and their content hashes; returns the latter."""
    written = store.write(DERIVED, rows, batch)
    return store.write(DERIVED, _content(written).coalesce(1), batch, "content")


def _write_state(
    store: TableStore, batch: Batch, known: DataFrame, tail: DataFrame | None, settings: str
) -> None:
    version = F.lit(batch.last).cast("bigint").alias("version")
    seen = known.select("ticker", "last_date", "replaced_by", F.lit(settings).alias("basis"), version)
    store.write(DERIVED, seen, batch, "seen")
    if tail is not None:
        store.write(DERIVED, tail.withColumn("version", version), batch, "tail")
