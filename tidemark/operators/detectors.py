"""Event detectors: window expressions over each ticker's bars.

Bars are unique by (ticker, date), so a ticker never has more rows than the
calendar has days: about 250 a year, a few megabytes for any listed history,
however large the whole table is. `series.split_series` cuts series finer
where that is still too much for one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import nan_to_null, ratio_change, zscore
from tidemark.operators.series import SERIES, split_series
from tidemark.schemas import DERIVED_TYPES, EVENT_COLUMNS, EVENTS, SOURCE_DERIVED, Thresholds


#: Longest peak window that is taken as a frame, row by row.
FRAME_ROWS = 128


def lookback_rows(t: Thresholds) -> int:
    """How many earlier rows an event on a bar can depend on."""
    return max(t.drawdown_window_days - 1, t.volume_spike_window_days, 1)


def mark_bars(
    bars: DataFrame, types: Sequence[str], t: Thresholds, series: Sequence[str] = ("ticker",)
) -> DataFrame:
    """Add what the detectors of the given event types look at.

    - drawdowns: the rolling peak's date, and the fall of adj_close from it
    - gaps: the previous row's close, and the open relative to it
    - volume_spikes: mean and sample deviation of volume over the rows before,
      and the z-score; NULL unless the full number of volumes is there

    All frames are taken in one step, over one sort of each series; only a long
    peak window takes further sorts, but no exchange. Volumes are summed as
    integers, so that mean and deviation do not depend on what stands before
    their frame; running sums of squares hold volumes up to some 10^16.
    """
    in_order = Window.partitionBy(*series).orderBy("date")
    frames, marks, columns = [], [], bars.columns
    if "drawdowns" in types:
        # One maximum gives peak and date together: it ranks by price, then by
        # the earlier date. NULL prices rank lowest, so they are never a peak.
        ranked = F.struct(F.col("adj_close").alias("price"), F.expr("-unix_date(date)").alias("earliness"))
        if t.drawdown_window_days <= FRAME_ROWS:
            peak = F.max(ranked).over(in_order.rowsBetween(1 - t.drawdown_window_days, 0))
        else:
            bars, peak = _sliding_max(bars, ranked, t.drawdown_window_days, series)
        frames.append(peak.alias("_peak"))
        marks.append(F.expr("date_from_unix_date(-_peak.earliness)").alias("peak_date"))
        marks.append(ratio_change(F.col("adj_close"), F.col("_peak.price")).alias("drawdown_pct"))
    if "gaps" in types:
        frames.append(F.lag("close").over(in_order).alias("prior_close"))
        marks.append(F.col("prior_close"))
        marks.append(ratio_change(F.col("open"), F.col("prior_close")).alias("gap_pct"))
    if "volume_spikes" in types:
        n = t.volume_spike_window_days
        square = F.col("volume").cast("decimal(19,0)") * F.col("volume").cast("decimal(19,0)")
        summed = {
            "_volumes": F.count("volume"),
            "_sum": F.sum(F.col("volume").cast("decimal(38,0)")),
            "_squares": F.sum(square.cast("decimal(38,0)")),
        }
        # What was summed up to the row before, less what was n rows earlier:
        # both frames only grow, so that a row costs the same for any n.
        for name, total in summed.items():
            until, past = (
                F.coalesce(total.over(in_order.rowsBetween(Window.unboundedPreceding, to)), F.lit(0)) for to in (-1, -n - 1)
            )
            frames.append((until - past).cast("bigint" if name == "_volumes" else "decimal(38,0)").alias(name))
        full = f"_volumes = {n}"
        spread = f"CAST({n} * _squares AS DECIMAL(38, 0)) - CAST(_sum * _sum AS DECIMAL(38, 0))"
        mean, std = F.expr(f"CAST(_sum AS DOUBLE) / {n}"), F.expr(f"sqrt(CAST({spread} AS DOUBLE) / {n * (n - 1)}.0D)")
        marks.append(F.when(F.expr(full), mean).alias("trailing_mean"))
        marks.append(F.when(F.expr(full), std).alias("trailing_std"))
        marks.append(F.when(F.expr(full), zscore(F.col("volume"), mean, std)).alias("volume_zscore"))
    return bars.select("*", *frames).select(*columns, *marks)


def _sliding_max(bars: DataFrame, value: Column, rows: int, series: Sequence[str]) -> tuple[DataFrame, Column]:
    """Bars with what is needed for the maximum over the last ``rows`` rows, and that maximum.

    Series are cut into blocks of that many rows, with running maxima from both
    ends; a frame is the end of one block and the beginning of the next, so that
    its maximum is the larger of two values, however many rows it has.
    """
    in_order = Window.partitionBy(*series).orderBy("date")
    block = F.floor((F.row_number().over(in_order) - 1) / rows)
    blocks = Window.partitionBy(*series, "_block")
    to_here = (Window.unboundedPreceding, 0)
    cut = bars.withColumn("_block", block)
    cut = cut.withColumn("_up", F.max(value).over(blocks.orderBy("date").rowsBetween(*to_here)))
    cut = cut.withColumn("_down", F.max(value).over(blocks.orderBy(F.desc("date")).rowsBetween(*to_here)))
    return cut, F.greatest("_up", F.lag("_down", rows - 1).over(in_order))


def event_tests(t: Thresholds) -> dict[str, str]:
    """Per event type, the SQL test a marked bar must pass; NULL does not."""
    return {
        "drawdowns": f"drawdown_pct <= -{t.drawdown_threshold_pct}D",
        "gaps": f"abs(gap_pct) >= {t.gap_threshold_pct}D",
        "volume_spikes": f"volume_zscore >= {t.volume_spike_zscore}D",
    }


def _event_columns(event_type: str, t: Thresholds, run_date: date, columns: Sequence[str]) -> list[str]:
    """SQL for the columns of an event, from a marked bar; foreign ones are NULL."""
    given = {
        "event_type": f"'{event_type}'",
        "source": f"'{SOURCE_DERIVED}'",
        "created_at": f"DATE'{run_date}'",
        "zscore_threshold": f"{t.volume_spike_zscore}D",
    }
    if event_type == "drawdowns":
        given |= {"window_days": f"{t.drawdown_window_days}", "threshold_pct": f"{t.drawdown_threshold_pct}D"}
    elif event_type == "gaps":
        given |= {"threshold_pct": f"{t.gap_threshold_pct}D"}
    else:
        given |= {"window_days": f"{t.volume_spike_window_days}"}
    own = EVENT_COLUMNS[event_type]
    out = []
    for name in columns:
        value = given.get(name, name) if name in own else "NULL"
        out.append(f"CAST({value} AS {EVENTS[name].dataType.simpleString()}) AS {name}")
    return out


def _detect(event_type, inputs, lookback, bars, t, run_date, split_rows) -> DataFrame:
    cut, series = _series(_numbers(bars).select("ticker", "date", *inputs), lookback, split_rows)
    hits = _own_rows(mark_bars(cut, [event_type], t, series)).filter(event_tests(t)[event_type])
    return hits.selectExpr(*_event_columns(event_type, t, run_date, EVENT_COLUMNS[event_type]))


def drawdowns(bars: DataFrame, t: Thresholds, run_date: date, split_rows: int | None = None) -> DataFrame:
    """A row for every day at or below the drawdown threshold."""
    return _detect("drawdowns", ["adj_close"], t.drawdown_window_days - 1, bars, t, run_date, split_rows)


def gaps(bars: DataFrame, t: Thresholds, run_date: date, split_rows: int | None = None) -> DataFrame:
    """A row for every open that is far from the previous close."""
    return _detect("gaps", ["open", "close"], 1, bars, t, run_date, split_rows)


def volume_spikes(bars: DataFrame, t: Thresholds, run_date: date, split_rows: int | None = None) -> DataFrame:
    """A row for every volume far above its trailing mean."""
    return _detect("volume_spikes", ["volume"], t.volume_spike_window_days, bars, t, run_date, split_rows)


def detect_events(bars: DataFrame, t: Thresholds, run_date: date, split_rows: int | None = None) -> DataFrame:
    """All three detectors in one pass: one shuffle and one sort of the bars.

    Each bar yields its events by exploding the hits, in the common layout.
    Bars that come as ``borrowed`` are looked back on but yield none.
    """
    needed = _numbers(bars).select("ticker", "date", "open", "close", "volume", "adj_close", *_flag(bars))
    cut, series = _series(needed, lookback_rows(t), split_rows)
    marked = _own_rows(mark_bars(cut, DERIVED_TYPES, t, series))
    # The key stays out of the exploded part, so that a filter on ticker can
    # move below the windows, to the scan.
    key = ["ticker", "date"]
    others = [c for c in EVENTS.names if c not in key]
    hits = []
    for event_type, test in event_tests(t).items():
        columns = ", ".join(_event_columns(event_type, t, run_date, others))
        hits.append(f"CASE WHEN {test} THEN struct({columns}) END")
    found = marked.selectExpr(*key, f"inline(filter(array({', '.join(hits)}), hit -> hit IS NOT NULL))")
    return found.select(*EVENTS.names)


def _numbers(bars: DataFrame) -> DataFrame:
    """The bars with NaN read as NULL, as the loader does."""
    doubles = [f.name for f in bars.schema if f.dataType.typeName() == "double"]
    return bars.withColumns({c: nan_to_null(F.col(c)) for c in doubles})


def _series(bars: DataFrame, lookback: int, split_rows: int | None) -> tuple[DataFrame, list[str]]:
    if split_rows is None or _flag(bars):
        return bars, ["ticker"]
    return split_series(bars, lookback, split_rows), SERIES


def _flag(bars: DataFrame) -> list[str]:
    return [c for c in bars.columns if c == "borrowed"]


def _own_rows(marked: DataFrame) -> DataFrame:
    """Without the rows that were only borrowed for their look-back."""
    return marked.filter(~F.col("borrowed")) if _flag(marked) else marked
