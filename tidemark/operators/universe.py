"""Universe lists: cleaning a holdings file, ranking ETFs, the ordered union."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import clean_ticker, is_ticker
from tidemark.schemas import (
    ETF_CANDIDATES,
    ETFS,
    RANKING_DAYS,
    RANKING_LOOKBACK_DAYS,
    SOURCE_ETFS,
    SOURCE_SP500,
    SP500,
    TOP_ETFS,
)

# One field of a CSV line that was given a leading comma.
_FIELD = ',("[^"]*(?:""[^"]*)*"[^,]*|[^,]*)'


def _strip_quoted(line: Column) -> Column:
    return F.regexp_replace(line, '"[^"]*"', "")


def _n_fields(line: Column) -> Column:
    bare = _strip_quoted(line)
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def _fields(line: Column) -> Column:
    """A CSV line as an array of texts; empty fields are NULL."""

    def unquoted(field: Column) -> Column:
        inner = F.regexp_replace(field, '^"([^"]*(?:""[^"]*)*)"', "$1")
        text = F.when(field.startswith('"'), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(field)
        return F.nullif(text, F.lit(""))

    return F.transform(F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), 1), unquoted)


def holdings_records(lines: DataFrame, few_files: bool = False) -> tuple[DataFrame, DataFrame]:
    """Holdings lines (path, place, line) to records, and files without a table.

    Each file starts with an unspecified number of prelude lines; its table
    begins at the first line that starts with ``Ticker,``. Columns are found
    by that header, which may differ from file to file. Lines with more
    fields than the header, or with an unclosed quote, are skipped.

    Work is by line, so a large file is read by many tasks. Only the place of
    each header is gathered per file. With ``few_files``, known to be so few
    that a row for each fits in memory, these are sent to where the lines are
    read; else both meet by path, where a skewed file is split by Spark.
    """
    line = F.regexp_replace("line", "^\uFEFF", "")
    lines = lines.select("path", "place", line.alias("line"))
    starting = lines.filter(F.col("line").startswith("Ticker,"))
    headers = starting.groupBy("path").agg(F.min(F.struct("place", "line")).alias("header"))
    no_table = (
        lines.select("path")
        .distinct()
        .join(F.broadcast(headers) if few_files else headers, "path", "left_anti")
        .select("path", F.lit("no line begins with the column Ticker").alias("reason"))
    )
    with_header = headers.select(
        "path",
        F.col("header.place").alias("header_place"),
        _fields(F.col("header.line")).alias("names"),
        _n_fields(F.col("header.line")).alias("n_names"),
    )

    def field(name: str) -> Column:
        at = F.array_position("names", name)
        return F.when(at > 0, F.try_element_at("fields", at.cast("int")))

    records = (
        lines.filter(F.trim("line") != "")
        .join(F.broadcast(with_header) if few_files else with_header, "path")
        .filter(F.col("place") > F.col("header_place"))
        .filter((_n_fields(F.col("line")) <= F.col("n_names")) & ~_strip_quoted(F.col("line")).contains('"'))
        .withColumn("fields", _fields(F.col("line")))
        .select(
            "path",
            field("Ticker").alias("raw_ticker"),
            field("Name").alias("name"),
            field("Sector").alias("sector"),
            field("Asset Class").alias("asset_class"),
            field("Weight (%)").try_cast("double").alias("weight_pct"),
        )
    )
    return records, no_table


def equities(records: DataFrame) -> DataFrame:
    """Records that are equities and have a ticker, with the ticker cleaned."""
    return records.filter("asset_class = 'Equity' and raw_ticker is not null").withColumn(
        "ticker", clean_ticker(F.col("raw_ticker"))
    )


def sp500_rows(records: DataFrame, run_date: date) -> DataFrame:
    """Equity records with a valid ticker, as universe rows."""
    valid = equities(records).filter(is_ticker(F.col("ticker")))
    return valid.select(
        "ticker",
        "name",
        "sector",
        "weight_pct",
        F.lit(SOURCE_SP500).alias("source"),
        F.lit(run_date).alias("retrieved_at"),
    ).select(*SP500.names)


def ticker_rejects(records: DataFrame) -> DataFrame:
    """Equity records whose ticker is malformed."""
    return equities(records).filter(~is_ticker(F.col("ticker")))


def rank_by_dollar_volume(
    bars: DataFrame,
    candidates: DataFrame,
    run_date: date,
    days: int = RANKING_DAYS,
    lookback_days: int = RANKING_LOOKBACK_DAYS,
    top_n: int = TOP_ETFS,
) -> DataFrame:
    """The candidates with the highest mean close x volume, ranked from 1.

    The mean is over a ticker's last ``days`` bars that have both values, out
    of the last ``lookback_days`` calendar days. Ties go by ticker. Ranks are
    given after the cut to ``top_n`` rows, so the one-task sort is of those.
    """
    recent = bars.filter(
        (F.col("date") > F.date_sub(F.lit(run_date), lookback_days)) & (F.col("date") <= F.lit(run_date))
    ).select("ticker", "date", "close", "volume")
    usable = recent.dropna(subset=["close", "volume"]).join(
        candidates.select("ticker"), "ticker", "left_semi"
    )
    newest = Window.partitionBy("ticker").orderBy(F.desc("date"))
    means = (
        usable.withColumn("age", F.row_number().over(newest))
        .filter(F.col("age") <= days)
        .groupBy("ticker")
        .agg(F.avg(F.col("close") * F.col("volume")).alias("avg_dollar_volume"))
    )
    top = means.orderBy(F.desc("avg_dollar_volume"), "ticker").limit(top_n)
    order = Window.orderBy(F.desc("avg_dollar_volume"), "ticker")
    return (
        top.withColumn("rank", F.row_number().over(order))
        .join(candidates.select(*ETF_CANDIDATES.names), "ticker", "left")
        .withColumn("source", F.lit(SOURCE_ETFS))
        .withColumn("retrieved_at", F.lit(run_date))
        .select(*ETFS.names)
    )


def universe_union(sp500: DataFrame, etfs: DataFrame) -> DataFrame:
    """Equities followed by ETFs as rows (part, position, ticker).

    Both need a ``position``. Repeats are kept; order is by part, position.
    """
    return (
        sp500.select(F.lit(0).alias("part"), "position", "ticker")
        .unionByName(etfs.select(F.lit(1).alias("part"), "position", "ticker"))
    )
