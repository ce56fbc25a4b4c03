"""Column expressions. All are built-in Spark functions; none is a UDF."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: 1 to 6 characters, letters, digits and dashes, no leading dash.
TICKER_PATTERN = r"^[A-Z0-9][A-Z0-9\-]{0,5}$"

# Fixed value: what the name of a weight column contains.
WEIGHT_NAME = re.compile("percent|weight", re.IGNORECASE)

SECONDS_PER_DAY = 86400
# Seconds either side of 1970 that fit a nanosecond clock (years 1677 to 2262).
MAX_EPOCH_SECONDS = 9_223_372_036


def clean_ticker(raw: Column) -> Column:
    """Feed spelling to store spelling: ``brk.b`` becomes ``BRK-B``."""
    dashed = F.upper(F.translate(raw, ".", "-"))
    return F.regexp_replace(dashed, r"^\s+|\s+$", "")


def is_ticker(c: Column) -> Column:
    return c.rlike(TICKER_PATTERN)


def nan_to_null(c: Column) -> Column:
    """Missing doubles are NULL here; NaN would win every max and comparison."""
    return F.nanvl(c, F.lit(None).cast("double"))


def ratio_change(value: Column, base: Column) -> Column:
    """value / base - 1. Over a zero base: plus or minus infinity, 0/0 is NULL."""
    return (
        F.when(base != 0, value / base - 1)
        .when((base == 0) & (value > 0), F.lit(float("inf")))
        .when((base == 0) & (value < 0), F.lit(float("-inf")))
    )


def zscore(value: Column, mean: Column, std: Column) -> Column:
    """Distance from the mean in standard deviations; NULL unless std > 0."""
    return F.when(std > 0, (value - mean) / std)


def adjust_ratio(adj_close: Column, close: Column) -> Column:
    """Factor from raw to adjusted prices, 1.0 where it is undefined."""
    return F.coalesce(F.try_divide(adj_close, close), F.lit(1.0))


def first_text(*cols: Column) -> Column:
    """The first value that is neither NULL nor empty; else the last one."""
    *texts, fallback = cols
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in texts], fallback)


def epoch_date(seconds: Column) -> Column:
    """Epoch seconds, as text or number, to a UTC date.

    NULL for missing, empty, zero, unparseable and out-of-range values.
    """
    s = seconds.cast("string").try_cast("double")
    in_range = s.between(-MAX_EPOCH_SECONDS, MAX_EPOCH_SECONDS) & (s != 0)
    day = F.floor(s / SECONDS_PER_DAY).cast("int")
    return F.when(in_range, F.date_from_unix_date(day))


def utc_day(c: Column) -> Column:
    """A timestamp, or text that may hold one, to its UTC day; bad text is NULL.

    Text without an offset is read in the session zone, which `prepare` pins
    to UTC.
    """
    instant = F.try_to_timestamp(c.cast("string"))
    day = F.floor(F.unix_seconds(instant) / SECONDS_PER_DAY).cast("int")
    return F.date_from_unix_date(day)


def find_column(columns: Sequence[str], names: Iterable[str]) -> str | None:
    """The first column whose lower-cased name is one of names."""
    lowered = {}
    for c in columns:
        lowered.setdefault(c.lower(), c)
    found = [lowered[n] for n in names if n in lowered]
    return min(found, key=list(columns).index, default=None)


def find_weight_column(columns: Sequence[str]) -> str | None:
    """The first column whose name speaks of a percentage or a weight."""
    for column in columns:
        if WEIGHT_NAME.search(column):
            return column
    return None


def require_columns(columns: Sequence[str], required: Iterable[str], what: str) -> None:
    """Fail at plan time, naming every column that is absent."""
    missing = [c for c in required if c not in columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")
