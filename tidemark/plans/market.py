"""The public ingests and loaders.

Ingests move landed rows into the store and return the outcome per ticker as
a DataFrame (dataset, ticker, status, reason); loaders read the store. Both
take tickers as a list, or as a DataFrame (position, ticker) where there are
more than a driver should hold.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, timezone
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import bars as B
from tidemark.functions.scalars import require_columns
from tidemark.operators import events, keyed, reference, universe
from tidemark.plans import derived, tables
from tidemark.plans.tables import DERIVED, EARNINGS_ROWS, HOLDINGS, METADATA, PRICES, SECTOR_ROWS
from tidemark.schemas import (
    BARS,
    DEFAULT_START,
    DERIVED_TYPES,
    EARNINGS,
    ETF_HOLDINGS,
    ETF_METADATA,
    ETFS,
    EVENT_COLUMNS,
    EVENTS,
    LAST_DATES,
    RANKING_DAYS,
    SECTORS,
    SP500,
    STATUS,
    TOP_ETFS,
    Config,
)
from tidemark.session import prepare, settled
from tidemark.sources import files
from tidemark.sources import landing
from tidemark.sources.landing import Taken, read_landing
from tidemark.sources.store import Batch, Table, TableStore

Tickers = str | Sequence[str] | DataFrame | None

# Longest list of tickers that is sent to every executor: some 10 MB.
BROADCAST_TICKERS = 200_000
# Longest list of tickers that is pushed to the scan as a filter.
PUSHED_TICKERS = 1_000


class LoadedPrices(NamedTuple):
    df: DataFrame
    missing: DataFrame


class PriceIngest(NamedTuple):
    status: DataFrame
    rejects: DataFrame


class DerivedEvents(NamedTuple):
    updated: list[str]
    missing: DataFrame


class StoreIngest(NamedTuple):
    prices: PriceIngest
    reference: DataFrame
    events: DataFrame


def _spark() -> SparkSession:
    return prepare(SparkSession.getActiveSession() or SparkSession.builder.getOrCreate())


def _store(config: Config) -> TableStore:
    return TableStore(_spark(), config.data_dir)


def _run_date(config: Config) -> date:
    return config.run_date or datetime.now(timezone.utc).date()


def _as_date(value: date | str | None) -> date | None:
    return date.fromisoformat(value) if isinstance(value, str) else value


def _requested(config: Config, tickers: Tickers, kind: str = "all") -> DataFrame:
    asked = load_universe(kind, config=config) if tickers is None else tickers
    return keyed.unique_ordered(keyed.request_list(_spark(), asked))


def _are_few(tickers: DataFrame) -> bool:
    return tickers.limit(BROADCAST_TICKERS + 1).count() <= BROADCAST_TICKERS


def _of_tickers(rows: DataFrame, tickers: DataFrame, key: str = "ticker") -> DataFrame:
    """Rows of some tickers, found without a shuffle if those are few."""
    wanted = tickers.select(F.col("ticker").alias(key))
    if _are_few(tickers):
        wanted = F.broadcast(wanted)
    return rows.join(wanted, key, "left_semi")


class _Landed(NamedTuple):
    """Landed rows of some tickers, and the note of the files they came from."""

    rows: DataFrame
    taken: Taken | None
    tickers: DataFrame

    @property
    def is_new(self) -> bool:
        return self.taken is not None and self.taken.is_new


def _landed_for(
    store: TableStore, table: Table, config: Config, name: str, tickers: DataFrame, key: str = "ticker", whole: bool = False
) -> _Landed:
    """Rows in the files that the tickers still need, or with ``whole`` in all files."""
    spark = store.spark
    if tickers.isEmpty():
        return _Landed(read_landing(spark, config.landing_dir, name, []), None, tickers)
    taken = landing.take(store, table, config.landing_dir, [name], tickers)
    if whole:
        return _Landed(_of_tickers(read_landing(spark, config.landing_dir, name), tickers, key), taken, tickers)
    readers = {name: lambda s, folder, paths: read_landing(s, folder, name, paths)}
    new, old = taken.rows(spark, readers), taken.rows(spark, readers, old=True)
    parts = [_of_tickers(new, tickers, key)] if new is not None else []
    parts += [_of_tickers(old, taken.behind, key)] if old is not None else []
    if not parts:
        return _Landed(read_landing(spark, config.landing_dir, name, []), taken, tickers)
    return _Landed(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), taken, tickers)


def _status(dataset: str, requested: DataFrame, pending: DataFrame, done: DataFrame, reason) -> DataFrame:
    """Not pending is current; pending and done is updated; else it is skipped.

    Worked out at once, before the tables it is read from are replaced.
    """
    marked = (
        requested.select("ticker")
        .join(pending.select("ticker", F.lit(True).alias("pending")), "ticker", "left")
        .join(done.select("ticker", F.lit(True).alias("done")).distinct(), "ticker", "left")
    )
    status = F.when(F.col("pending").isNull(), "already_current").when(F.col("done"), "updated")
    status = status.otherwise("skipped")
    return settled(
        marked.select(
            F.lit(dataset).alias("dataset"),
            "ticker",
            status.alias("status"),
            F.when(status == "skipped", F.lit(reason)).alias("reason"),
        )
    )


def _put(
    store: TableStore,
    table: Table,
    new: DataFrame,
    keys: Sequence[str],
    landed: _Landed,
    replaced: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Publish new rows, one per key, in place of those of the ``replaced`` keys,
    and the note of what was read; nothing if there is neither. Returns the new
    rows as written, with all their columns, so that landed data are read once."""
    batch = store.new_batch(table)
    order = [c for c in ("position",) if c in new.columns and c not in table.schema.names]
    written = store.write_scratch(keyed.keep_last(new, keys, order) if order else new, batch, "new")
    empty = written.isEmpty()
    if empty and not landed.is_new:
        store.discard(batch)
        return store.spark.createDataFrame([], new.schema)
    if not empty:
        store.write(table, written, batch)
        if replaced is not None:
            store.write_replaced(replaced(written), batch)
    if landed.is_new:
        landing.note(store, table, batch, landed.taken, landed.tickers)
    store.publish(batch)
    store.merge(table)
    return written


# --- prices -----------------------------------------------------------------


def ingest_prices(
    tickers: Tickers = None,
    *,
    start_date: date | str | None = None,
    end_date: date | str | None = None,
    force: bool = False,
    config: Config,
    landed: DataFrame | None = None,
) -> PriceIngest:
    """Store the landed bars that are newer than each ticker's last one.

    New bars are added as a batch; stored ones are not read, as every batch
    keeps its last dates beside it, and of landed files only those are opened
    that the tickers still need. Prices may land as rows (``raw_prices``), with
    a column per ticker and field (``raw_prices_wide``) or with a file per
    ticker (``raw_prices_by_ticker``). ``force`` replaces the whole series of the
    tickers that have landed bars in range, and no other rows. ``landed``
    stands in for the landing tables, for a stream's micro-batch.
    """
    store = _store(config)
    start = _as_date(start_date) or DEFAULT_START
    end = _as_date(end_date) or _run_date(config)
    requested = _requested(config, tickers)
    taken, parts, rejects = None, [], []
    if landed is None:
        taken = landing.take(store, PRICES, config.landing_dir, list(PRICE_READERS), requested, start, end)
        new, old = taken.rows(store.spark, PRICE_READERS), taken.rows(store.spark, PRICE_READERS, old=True)
        if force:
            new, old = _all_landed_prices(store.spark, config.landing_dir), None
        if new is not None:
            usable, unusable = B.split_rejects(new)
            parts, rejects = [usable], [unusable]
        if old is not None:
            parts.append(_of_tickers(B.split_rejects(old)[0], taken.behind))
    else:
        usable, unusable = B.split_rejects(B.read_bars(landed))
        parts, rejects = [usable], [unusable]
    nothing = B.read_bars(read_landing(store.spark, config.landing_dir, "raw_prices", []))
    rejected = rejects[0] if rejects else nothing
    usable = reduce(DataFrame.unionByName, parts) if parts else None

    stored_last = derived.stored_last_dates(store)
    windows = B.fetch_windows(requested, stored_last, start, end, force)
    got = store.spark.createDataFrame([], LAST_DATES)
    if usable is not None:
        asked, scan = _scan_bounds(windows, start)
        usable = B.in_range(usable.filter(scan), end=end)
        new = B.price_increment(usable, windows, few=asked <= BROADCAST_TICKERS)
        batch = store.new_batch(PRICES)
        got = _write_bars(store, batch, new)
        is_new = taken is not None and taken.is_new
        if got.isEmpty():
            store.drop_parts(batch, ["rows", "last"])
            got = store.spark.createDataFrame([], LAST_DATES)
        elif force:
            store.write_replaced(got.select("ticker"), batch)
        if is_new:
            landing.note(store, PRICES, batch, taken, requested, start, end)
        if is_new or store.has_part(batch, "rows"):
            store.publish(batch)
    status = settled(B.price_status(windows, got, force))
    store.merge(PRICES)
    return PriceIngest(status, rejected)


def _long_prices(spark: SparkSession, landing_dir: str, paths: Sequence[str] | None) -> DataFrame:
    return B.read_bars(read_landing(spark, landing_dir, "raw_prices", paths))


def _wide_prices(spark: SparkSession, landing_dir: str, paths: Sequence[str] | None) -> DataFrame:
    """Wide deliveries, unfolded by the columns any of them has."""
    folder = f"{landing_dir}/{landing.WIDE_PRICES}"
    reader = spark.read.option("mergeSchema", True).option("basePath", folder)
    wide = reader.parquet(*paths) if paths else reader.parquet(folder)
    return B.read_bars(B.unfold(wide, B.wide_tickers(wide)))


def _prices_by_ticker(spark: SparkSession, landing_dir: str, paths: Sequence[str] | None) -> DataFrame:
    """Deliveries of one ticker each, named by their file."""
    folder = f"{landing_dir}/{landing.PRICES_BY_TICKER}"
    reader = spark.read.option("basePath", folder).option("recursiveFileLookup", True)
    rows = reader.parquet(*paths) if paths else reader.parquet(folder)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)\.(?:[a-z]+\.)?parquet$", 1)
    # Names in paths are escaped; a plus sign is itself.
    return B.read_bars(rows.withColumn("ticker", F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))))


PRICE_READERS = {
    "raw_prices": _long_prices,
    landing.WIDE_PRICES: _wide_prices,
    landing.PRICES_BY_TICKER: _prices_by_ticker,
}


def _all_landed_prices(spark: SparkSession, landing_dir: str) -> DataFrame | None:
    there = [read for name, read in PRICE_READERS.items() if files.exists(spark, f"{landing_dir}/{name}")]
    return reduce(DataFrame.unionByName, [read(spark, landing_dir, None) for read in there]) if there else None


def _scan_bounds(windows: DataFrame, start: date) -> tuple[int, Column]:
    """How many tickers are asked for, and which landed rows a scan may skip.

    Tickers that have bars bound the scan by the earliest day one of them
    still needs. Those without any need all days: a few are named, so that
    the rows of the others are skipped all the same.
    """
    known = F.col("last_date").isNotNull() & (F.col("fetch_from") > F.lit(start))
    asked, since, new = windows.agg(
        F.count(F.lit(1)), F.min(F.when(known, F.col("fetch_from"))), F.count(F.when(~known, 1))
    ).first()
    wanted = F.col("date") >= F.lit(start)
    if since is not None and new <= PUSHED_TICKERS:
        names = [r["ticker"] for r in windows.filter(~known).select("ticker").collect()] if new else []
        later = F.col("date") >= F.lit(since)
        wanted = wanted & (later | F.col("ticker").isin(names) if names else later)
    return asked, wanted


def _write_bars(store: TableStore, batch: Batch, bars: DataFrame) -> DataFrame:
    """Write a batch of bars with its last dates beside it; returns the latter."""
    return store.write(PRICES, B.last_dates(store.write(PRICES, bars, batch)), batch, "last")


def load_prices(
    tickers: str | Sequence[str] | DataFrame,
    start: date | str | None = None,
    end: date | str | None = None,
    adjusted: bool = True,
    *,
    config: Config,
) -> LoadedPrices:
    """Bars of the requested tickers, and the tickers that have none in range.

    Bars come unordered, with the ``position`` of their ticker in the request;
    order by (position, date) for the request's order.
    """
    store = _store(config)
    stored = store.read(PRICES)
    if isinstance(tickers, (list, tuple, str)):
        wanted = [tickers] if isinstance(tickers, str) else list(tickers)
        if len(wanted) <= PUSHED_TICKERS:
            stored = stored.filter(F.col("ticker").isin(wanted))
    return LoadedPrices(
        *B.load_bars(stored, keyed.request_list(store.spark, tickers), start, end, adjusted)
    )


# --- reference --------------------------------------------------------------


def ingest_sectors(tickers: Tickers = None, *, force: bool = False, config: Config) -> DataFrame:
    """Sector rows for requested tickers that have none yet, from landed info.

    ``force`` refreshes all requested tickers; those without landed info then
    lose their row. A ticker without landed info is skipped.
    """
    store = _store(config)
    requested = _requested(config, tickers)
    existing = store.read(SECTOR_ROWS)
    pending = requested if force else keyed.missing_from_snapshot(requested, existing)
    landed = _landed_for(store, SECTOR_ROWS, config, "raw_info", pending, whole=force)
    rows = reference.sector_rows(reference.parse_info(landed.rows), _run_date(config))
    replaced = (lambda _: requested.select("ticker")) if force else None
    new = _put(store, SECTOR_ROWS, rows, ["ticker"], landed, replaced)
    return _status("sectors", requested, pending, new, "no info delivered")


def ingest_etf_metadata(
    etfs: Tickers = None, *, force: bool = False, retry_missing: bool = False, config: Config
) -> DataFrame:
    """Metadata rows for requested ETFs that have none yet.

    An ETF without landed info is reported as skipped but still gets a row,
    filled from the universe. With ``retry_missing``, ETFs whose row has no
    inception date are taken up again.
    """
    store = _store(config)
    requested = _requested(config, etfs, "etfs")
    existing = store.read(METADATA)
    complete = existing.filter("inception_date IS NOT NULL") if retry_missing else existing
    pending = requested if force else keyed.missing_from_snapshot(requested, complete)
    again = force or retry_missing
    landed = _landed_for(store, METADATA, config, "raw_info", pending, whole=again)
    info = reference.parse_info(landed.rows)
    try:
        listed = files.read_etfs(store.spark, config.universe_dir)
    except files.UniverseSnapshotMissing:
        listed = store.spark.createDataFrame([], ETFS).withColumn("position", F.lit(0))
    informed = info.withColumn("informed", F.lit(True))
    rows = reference.metadata_rows(pending, info, listed, _run_date(config))
    rows = rows.join(informed.select("ticker", "informed"), "ticker", "left")
    replaced = (lambda new: (requested if force else new).select("ticker")) if again else None
    new = _put(store, METADATA, rows, ["ticker"], landed, replaced)
    return _status("etf_metadata", requested, pending, new.filter("informed"), "no info delivered")


def ingest_etf_constituents(etfs: Tickers = None, *, force: bool = False, config: Config) -> DataFrame:
    """Holdings of requested ETFs that have none yet; ``force`` replaces them.

    Where the landing table says which ``delivery`` rows belong to, an ETF has
    the rows of its newest one only. An ETF without landed holdings is skipped and keeps what it has.
    """
    store = _store(config)
    requested = _requested(config, etfs, "etfs")
    existing = store.read(HOLDINGS)
    held = existing.select(F.col("etf").alias("ticker")).distinct()
    pending = requested if force else keyed.missing_from_snapshot(requested, held)
    landed = _landed_for(store, HOLDINGS, config, "raw_holdings", pending, key="etf", whole=force)
    raw = keyed.newest_delivery(landed.rows, "etf")
    replaced = (lambda new: new.select("etf")) if force else None
    new = _put(store, HOLDINGS, reference.normalise_holdings(raw, _run_date(config)), [], landed, replaced)
    done = new.select(F.col("etf").alias("ticker")).distinct()
    return _status("etf_holdings", requested, pending, done, "no holdings delivered")


class _Delivery(NamedTuple):
    """How a stream's rows of one kind become rows of a table."""

    table: Table
    key: str
    order: str  # says which delivery of a key is newer
    keys: Sequence[str]
    rows: Callable[[DataFrame, Config], DataFrame]


def _delivered_metadata(raw: DataFrame, config: Config) -> DataFrame:
    try:
        listed = files.read_etfs(raw.sparkSession, config.universe_dir)
    except files.UniverseSnapshotMissing:
        listed = raw.sparkSession.createDataFrame([], ETFS).withColumn("position", F.lit(0))
    info = reference.parse_info(raw)
    return reference.metadata_rows(info.select("ticker"), info, listed, _run_date(config))


DELIVERIES = {
    "sectors": _Delivery(
        SECTOR_ROWS, "ticker", "position", ["ticker"], lambda raw, c: reference.sector_rows(reference.parse_info(raw), _run_date(c))
    ),
    "etf_metadata": _Delivery(METADATA, "ticker", "position", ["ticker"], _delivered_metadata),
    "etf_holdings": _Delivery(
        HOLDINGS, "etf", "delivery", [], lambda raw, c: reference.normalise_holdings(raw.drop("delivery"), _run_date(c))
    ),
    "earnings": _Delivery(
        EARNINGS_ROWS, "ticker", "delivery", ["ticker", "date"], lambda raw, c: events.normalise_earnings(raw.drop("delivery"), _run_date(c))
    ),
}


def deliver(dataset: str, landed: DataFrame, tickers: Tickers = None, *, config: Config) -> DataFrame:
    """Store rows as they are delivered, those of each key's newest delivery only.

    A delivery that is newer than what was delivered before replaces the key's
    rows as a whole; one that is not, as when a stream's batch is replayed or
    comes late, changes nothing. One without a readable row changes none.
    Rows without a key or a delivery number are left out. Returns the keys
    taken, with their ``delivery``. ``tickers`` bounds the keys, if given.
    """
    kind = DELIVERIES[dataset]
    require_columns(landed.columns, [kind.key, kind.order], f"delivered {dataset}")
    store = _store(config)
    if tickers is not None:
        landed = _of_tickers(landed, _requested(config, tickers), kind.key)
    newest = landed.groupBy(F.col(kind.key).alias("key")).agg(F.max(kind.order).cast("bigint").alias("delivery"))
    before = tables.newest_delivered(store.read(kind.table, "delivered")).withColumnRenamed("delivery", "_before")
    fresh = newest.filter("key IS NOT NULL AND delivery IS NOT NULL").join(before, "key", "left")
    fresh = settled(fresh.filter("_before IS NULL OR delivery > _before").select("key", "delivery"))
    if fresh.isEmpty():
        return fresh
    raw = landed.join(fresh.withColumnRenamed("delivery", "_delivery"), F.col(kind.key) == F.col("key"))
    raw = raw.filter(F.col(kind.order).cast("bigint") == F.col("_delivery")).select(*landed.columns)
    rows = kind.rows(raw, config)
    order = [c for c in ("position",) if c in rows.columns and c not in kind.table.schema.names]
    batch = store.new_batch(kind.table)
    written = store.write(kind.table, keyed.keep_last(rows, kind.keys, order) if kind.keys else rows, batch)
    store.write_replaced(written.select(kind.key), batch)
    store.write(kind.table, fresh, batch, "delivered")
    store.publish(batch)
    store.merge(kind.table)
    return fresh


def ingest_reference(
    tickers: Tickers = None, *, force: bool = False, config: Config
) -> DataFrame:
    """Sectors of the tickers; metadata and holdings of the ETFs among them."""
    etfs = None
    if tickers is not None:
        known = load_universe("etfs", config=config)
        asked = _requested(config, tickers)
        etfs = asked.join(known.select("ticker"), "ticker", "left_semi").select("position", "ticker")
    return reduce(
        DataFrame.unionByName,
        [
            ingest_sectors(tickers, force=force, config=config),
            ingest_etf_metadata(etfs, force=force, config=config),
            ingest_etf_constituents(etfs, force=force, config=config),
        ],
    )


def _load_snapshot(config: Config, table: Table) -> DataFrame:
    store = _store(config)
    if not store.exists(table):
        raise FileNotFoundError(f"{config.data_dir}/{table.name} not found. Run tidemark.ingest_reference")
    return store.read(table)


def load_sectors(*, config: Config) -> DataFrame:
    return _load_snapshot(config, SECTOR_ROWS)


def load_etf_metadata(*, config: Config) -> DataFrame:
    return _load_snapshot(config, METADATA)


def load_etf_holdings(etf: str, *, config: Config) -> DataFrame:
    """Holdings of one ETF; `position` is their delivered order."""
    held = _load_snapshot(config, HOLDINGS).filter(F.col("etf") == etf)
    if held.isEmpty():
        raise FileNotFoundError(f"no holdings of {etf}. Run tidemark.ingest_etf_constituents")
    return held


def load_etf_constituents(etf: str, *, config: Config) -> DataFrame:
    """Tickers one ETF holds, in weight order."""
    return reference.constituents(load_etf_holdings(etf, config=config), etf)


# --- events -----------------------------------------------------------------


def ingest_earnings(tickers: Tickers = None, *, force: bool = False, config: Config) -> DataFrame:
    """Earnings rows for requested tickers that have none yet.

    ``force`` refreshes all requested tickers. Where the landing table says
    which ``delivery`` rows belong to, a ticker has the dates of its newest one
    only. A ticker without a readable landed date is skipped.
    """
    store = _store(config)
    requested = _requested(config, tickers)
    existing = store.read(EARNINGS_ROWS)
    pending = requested if force else keyed.missing_from_snapshot(requested, existing)
    landed = _landed_for(store, EARNINGS_ROWS, config, "raw_earnings", pending, whole=force)
    raw = keyed.newest_delivery(landed.rows, "ticker")
    rows = events.normalise_earnings(raw, _run_date(config))
    replaced = (lambda _: requested.select("ticker")) if force else None
    new = _put(store, EARNINGS_ROWS, rows, ["ticker", "date"], landed, replaced)
    return _status("earnings", requested, pending, new, "no readable earnings dates delivered")


def ingest_derived_events(
    tickers: Tickers = None,
    *,
    force: bool = False,
    config: Config,
    ignore_created_at: bool = False,
    incremental: bool = False,
) -> DerivedEvents:
    """Detect drawdowns, gaps and volume spikes in the stored bars.

    All events of the requested tickers are replaced, unless none of them has
    bars. The result is published only if its content differs from the
    current one, by default also if it differs in created_at alone. Returns
    the event types that differ, and the tickers that have no bars.

    With ``incremental``, events of bars stored since the last such run are
    added instead, and earlier events keep their created_at.
    """
    store = _store(config)
    requested = _requested(config, tickers)
    missing = keyed.missing_from_snapshot(requested, derived.stored_last_dates(store))
    today = _run_date(config)
    if incremental and not force:
        changed = derived.refresh_new(store, requested, config.events, today)
    else:
        changed = derived.refresh_all(store, requested, config.events, today, ignore_created_at)
    return DerivedEvents(changed, missing)


def ingest_events(
    tickers: Tickers = None,
    *,
    force: bool = False,
    skip_earnings: bool = False,
    incremental: bool = False,
    config: Config,
) -> DataFrame:
    """Earnings, then derived events; the outcome as status rows.

    Derived events have a row per event type, and one per ticker without bars.
    """
    parts = []
    if not skip_earnings:
        parts.append(ingest_earnings(tickers, force=force, config=config))
    detected = ingest_derived_events(tickers, force=force, config=config, incremental=incremental)
    types = [
        (t, None, "updated" if t in detected.updated else "already_current", None) for t in DERIVED_TYPES
    ]
    parts.append(_spark().createDataFrame(types, STATUS))
    parts.append(
        detected.missing.select(
            F.lit("derived_events").alias("dataset"),
            "ticker",
            F.lit("skipped").alias("status"),
            F.lit("no bars stored").alias("reason"),
        )
    )
    return reduce(DataFrame.unionByName, parts)


def load_events(
    event_type: str = "all",
    tickers: str | Sequence[str] | DataFrame | None = None,
    start: date | str | None = None,
    end: date | str | None = None,
    *,
    config: Config,
) -> DataFrame:
    """Events by type, ticker and date; "all" has the columns of every type."""
    store = _store(config)
    if event_type == "earnings":
        stored = [store.read(EARNINGS_ROWS)]
    elif event_type in EVENT_COLUMNS:
        stored = [_derived(store)]
    else:
        stored = [store.read(EARNINGS_ROWS), _derived(store)]
    return events.select_events(events.union_events(*stored), event_type, tickers, start, end)


def _derived(store: TableStore) -> DataFrame:
    return store.read(DERIVED).select(*EVENTS.names)


# --- universe ---------------------------------------------------------------


def load_universe(kind: str = "all", as_of: str | None = None, *, config: Config) -> DataFrame:
    """The universe as rows (position, ticker): equities, then ETFs.

    Repeats are kept. The position orders the rows; it has gaps.
    """
    if as_of is not None:
        raise NotImplementedError("the universe has no history; pass as_of=None")
    if kind not in ("all", "sp500", "etfs"):
        raise ValueError(f"{kind!r} is no part of the universe")
    spark = _spark()
    if kind != "all":
        read = files.read_sp500 if kind == "sp500" else files.read_etfs
        return read(spark, config.universe_dir).select("position", "ticker")
    both = universe.universe_union(
        files.read_sp500(spark, config.universe_dir), files.read_etfs(spark, config.universe_dir)
    )
    # Equities keep their place; ETFs follow after any place a file can give.
    return both.select((F.col("part") * F.lit(2**60) + F.col("position")).alias("position"), "ticker")


def build_sp500(holdings_path: str, *, config: Config) -> DataFrame:
    """Write sp500.csv from holdings files; returns files that had no table."""
    spark = _spark()
    lines = files.read_holdings_lines(spark, holdings_path)
    records, no_table = universe.holdings_records(lines, files.are_few(spark, holdings_path))
    rows = universe.sp500_rows(records, _run_date(config)).orderBy("ticker")
    files.write_csv(rows.select(*SP500.names), f"{config.universe_dir}/sp500.csv")
    return no_table


def build_etfs(top_n: int = TOP_ETFS, days: int = RANKING_DAYS, *, config: Config) -> None:
    """Write etfs.csv: the candidates with the highest mean dollar volume.

    Ranks by the landed prices of the last 3 x ``days`` calendar days.
    """
    spark = _spark()
    raw = B.normalise_bars(read_landing(spark, config.landing_dir, "raw_prices"))
    daily = keyed.keep_last(raw, ["ticker", "date"], ["position"])
    candidates = files.read_etf_candidates(spark, config.universe_dir)
    ranked = universe.rank_by_dollar_volume(
        daily, candidates, _run_date(config), days, 3 * days, top_n
    )
    files.write_csv(ranked.orderBy("rank"), f"{config.universe_dir}/etfs.csv")


# --- the whole store --------------------------------------------------------


def ingest_all(
    tickers: Tickers = None,
    *,
    force: bool = False,
    start_date: date | str | None = None,
    end_date: date | str | None = None,
    skip_earnings: bool = False,
    incremental: bool = False,
    config: Config,
) -> StoreIngest:
    """Prices, then reference data, then events."""
    prices = ingest_prices(
        tickers, start_date=start_date, end_date=end_date, force=force, config=config
    )
    snapshots = ingest_reference(tickers, force=force, config=config)
    outcome = ingest_events(
        tickers, force=force, skip_earnings=skip_earnings, incremental=incremental, config=config
    )
    return StoreIngest(prices, snapshots, outcome)


def store_fingerprint(*, config: Config) -> DataFrame:
    """Rows and content hash of every table in the store.

    Equal before and after a rerun that had nothing to do.
    """
    store = _store(config)
    totals = [
        keyed.fingerprint(store.read(t)).select(F.lit(t.name).alias("table"), "n_rows", "content_hash")
        for t in tables.ALL
    ]
    return reduce(DataFrame.unionByName, totals)
