"""Price bars: normalising raw deliveries, increments, range reads, adjustment."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import adjust_ratio, nan_to_null, require_columns
from tidemark.operators.keyed import keep_last
from tidemark.schemas import BARS, RAW_PRICES

# Delivered column names and their names in the store.
RAW_TO_BAR = {
    "Date": "date",
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Volume": "volume",
    "Adj Close": "adj_close",
}
# What a bar cannot be stored without.
REQUIRED = ["ticker", "date", "close", "volume"]
PRICE_FIELDS = [c for c in RAW_TO_BAR if c != "Date"]


def read_bars(raw: DataFrame) -> DataFrame:
    """Delivered rows to bars: names, types, NaN to NULL.

    Keeps ``position`` where the delivery has one. Cells that cannot be read
    are NULL; ``reason`` says why a row cannot be stored, and is NULL if it can.
    """
    require_columns(raw.columns, ["ticker", *RAW_TO_BAR], "raw prices")
    columns, bad = [], []
    for name, kind in (("ticker", "string"), *((c, BARS[n].dataType) for c, n in RAW_TO_BAR.items())):
        c = F.col(f"`{name}`")
        if name in PRICE_FIELDS:
            value = nan_to_null(c.cast("string").try_cast("double"))
            unread = c.isNotNull() & c.cast("string").try_cast("double").isNull()
            value = value.try_cast("bigint") if name == "Volume" else value
        else:
            value = c.try_cast(kind)
            unread = c.isNotNull() & value.isNull()
        columns.append(value.alias(RAW_TO_BAR.get(name, name)))
        bad.append(F.when(unread, f"unreadable {name}"))
    position = F.col("position") if "position" in raw.columns else F.lit(0).cast("bigint")
    bars = raw.select(*columns, position.alias("position"), F.coalesce(*bad).alias("unread"))
    lacking = [F.when(F.col(c).isNull(), f"no {c}") for c in REQUIRED]
    return bars.select(*BARS.names, "position", F.coalesce("unread", *lacking).alias("reason"))


def normalise_bars(raw: DataFrame) -> DataFrame:
    """Delivered rows to bars, without those that have no close."""
    return read_bars(raw).drop("reason").filter(F.col("close").isNotNull())


def is_storable() -> Column:
    """A bar needs its key, and a volume."""
    return F.col("ticker").isNotNull() & F.col("date").isNotNull() & F.col("volume").isNotNull()


def split_rejects(bars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bars to store, and those that lack something, with their ``reason`` if known."""
    if "reason" in bars.columns:
        return bars.filter("reason IS NULL").drop("reason"), bars.filter("reason IS NOT NULL")
    return bars.filter(is_storable()), bars.filter(~is_storable())


def wide_to_long(
    wide: DataFrame, tickers: Sequence[str], date_column: str = "Date", sep: str = "|"
) -> DataFrame:
    """One column per (ticker, field) to one bar per (ticker, date).

    Column names hold ticker and field in either order. Days on which a ticker
    has no close are dropped, as are tickers that lack a column (see
    `absent_tickers`).
    """
    require_columns(wide.columns, [date_column], "wide prices")
    named = wide.withColumnRenamed(date_column, "Date")
    if not any(_wide_names(named, t, sep) for t in tickers):
        return wide.sparkSession.createDataFrame([], BARS)
    return normalise_bars(unfold(named, tickers, sep)).drop("position")


def unfold(wide: DataFrame, tickers: Sequence[str], sep: str = "|") -> DataFrame:
    """A wide delivery under the names of one with a row per ticker and day.

    Every wide row is unfolded where it is, without a shuffle. A ticker's days
    without any cell filled in are dropped. ``position`` is kept.
    """
    rows = []
    for ticker in tickers:
        names = _wide_names(wide, ticker, sep)
        if names is None:
            continue
        label = ticker.replace("\\", "\\\\").replace("'", r"\'")
        fields = [f"CAST(`{n.replace('`', '``')}` AS STRING) AS `{f}`" for f, n in names.items()]
        rows.append(f"struct('{label}' AS ticker, {', '.join(fields)})")
    position = "`position`" if "position" in wide.columns else "0L AS position"
    if not rows:
        return wide.sparkSession.createDataFrame([], RAW_PRICES)
    long = wide.selectExpr("`Date`", position, f"inline(array({', '.join(rows)}))")
    return long.filter(F.coalesce(*[F.col(f"`{f}`") for f in PRICE_FIELDS]).isNotNull())


def wide_tickers(wide: DataFrame, sep: str = "|") -> list[str]:
    """The tickers of which a wide delivery has all columns, in their order."""
    halves = [c.split(sep) for c in wide.columns if sep in c]
    named = [h for parts in halves for h in (sep.join(parts[:-1]), sep.join(parts[1:]))]
    once = dict.fromkeys(t for t in named if t not in PRICE_FIELDS)
    return [t for t in once if _wide_names(wide, t, sep)]


def _wide_names(wide: DataFrame, ticker: str, sep: str) -> dict[str, str] | None:
    """The ticker's column for each field, or None if one is absent."""
    for names in ({f: f"{ticker}{sep}{f}" for f in PRICE_FIELDS}, {f: f"{f}{sep}{ticker}" for f in PRICE_FIELDS}):
        if set(names.values()) <= set(wide.columns):
            return names
    return None


def absent_tickers(wide: DataFrame, tickers: Sequence[str], sep: str = "|") -> list[str]:
    """Tickers of which a wide delivery has not all columns."""
    return [t for t in tickers if _wide_names(wide, t, sep) is None]


def last_dates(bars: DataFrame) -> DataFrame:
    """The newest date and the number of bars of each ticker."""
    return bars.groupBy("ticker").agg(
        F.max("date").alias("last_date"), F.count(F.lit(1)).alias("bars")
    )


def fetch_windows(
    requested: DataFrame, last: DataFrame, start: date, end: date, force: bool = False
) -> DataFrame:
    """For each requested ticker, the dates to take: the day after its last to end.

    A ticker without bars, and every one under ``force``, starts at ``start``.
    """
    known = requested.join(last.select("ticker", "last_date"), "ticker", "left")
    from_last = F.lit(None).cast("date") if force else F.date_add("last_date", 1)
    return known.select(
        "position",
        "ticker",
        "last_date",
        F.coalesce(from_last, F.lit(start)).alias("fetch_from"),
        F.lit(end).alias("fetch_to"),
    )


def price_increment(raw_bars: DataFrame, windows: DataFrame, few: bool = False) -> DataFrame:
    """Delivered bars inside their ticker's window, one per (ticker, date).

    With ``few`` windows, known to fit in memory, bars are filtered where they
    are read. Otherwise copies are dropped first: what then meets the windows
    is at most a bar per day of any ticker, however often it was delivered.
    """
    spans = windows.select("ticker", "fetch_from", "fetch_to")
    inside = F.col("date").between(F.col("fetch_from"), F.col("fetch_to"))
    keys, order = ["ticker", "date"], ["position"]
    if few:
        wanted = keep_last(raw_bars.join(F.broadcast(spans), "ticker").filter(inside), keys, order)
    else:
        wanted = keep_last(raw_bars, keys, order).join(spans, "ticker").filter(inside)
    return wanted.select(*BARS.names)


def price_status(windows: DataFrame, taken: DataFrame, force: bool = False) -> DataFrame:
    """What an ingest did for each requested ticker.

    ``taken`` holds the tickers that got new bars. One whose last bar is at the
    end of the request is current; one that has bars, but got none of those
    still lacking, has no new bars, which on a quiet day is no failure.
    """
    outcome = windows.join(taken.select("ticker", F.lit(True).alias("taken")), "ticker", "left")
    known = F.lit(False) if force else F.col("last_date").isNotNull()
    status = (
        F.when(F.col("taken"), "updated")
        .when(known & (F.col("last_date") >= F.col("fetch_to")), "already_current")
        .when(known, "no_new_bars")
        .otherwise("skipped")
    )
    return outcome.select(
        F.lit("prices").alias("dataset"),
        "ticker",
        status.alias("status"),
        F.when(status == "skipped", F.lit("no bars delivered in range")).alias("reason"),
    )


def in_range(df: DataFrame, start: date | str | None = None, end: date | str | None = None) -> DataFrame:
    """Rows with start <= date <= end; either end may be open."""
    if start is not None:
        df = df.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col("date") <= F.lit(end).cast("date"))
    return df


def clean_bars(bars: DataFrame) -> DataFrame:
    """Bars with NaN read as NULL, whoever wrote them."""
    doubles = {f.name for f in BARS if f.dataType.typeName() == "double"}
    return bars.selectExpr(
        *[f"nanvl({c}, CAST(NULL AS DOUBLE)) AS {c}" if c in doubles else c for c in BARS.names]
    )


def adjust(bars: DataFrame) -> DataFrame:
    """Scale open, high, low and close by adj_close / close."""
    ratio = adjust_ratio(F.col("adj_close"), F.col("close"))
    scaled = {c: (F.col(c) * ratio).alias(c) for c in ("open", "high", "low", "close")}
    return bars.select(*[scaled.get(c, F.col(c)) for c in bars.columns])


def load_bars(
    bars: DataFrame,
    requested: DataFrame,
    start: date | str | None = None,
    end: date | str | None = None,
    adjusted: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Bars of the requested tickers, and the requested tickers without any.

    A ticker requested twice gives its bars twice. ``position`` stays on the
    bars, so that a caller can put them in request order.
    """
    found = in_range(clean_bars(bars), start, end)
    out = found.join(requested.select("position", "ticker"), "ticker").select("position", *BARS.names)
    missing = requested.join(found.select("ticker").distinct(), "ticker", "left_anti").select(
        "position", "ticker"
    )
    return (adjust(out) if adjusted else out), missing
