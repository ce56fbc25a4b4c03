"""Keyed tables: request lists, anti joins, upserts and change detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def request_list(
    spark: SparkSession, tickers: str | Sequence[str] | DataFrame, column: str = "ticker"
) -> DataFrame:
    """A request as rows (position, ticker).

    Takes one ticker, a Python list, or a DataFrame that already has both
    columns, which is the way to ask for more tickers than a driver should hold.
    """
    if isinstance(tickers, DataFrame):
        return tickers.select("position", column)
    names = [tickers] if isinstance(tickers, str) else list(tickers)
    return spark.createDataFrame(list(enumerate(names)), f"position bigint, {column} string")


def unique_ordered(requested: DataFrame, column: str = "ticker") -> DataFrame:
    """Drop repeats, keeping the first position of each value."""
    return requested.groupBy(column).agg(F.min("position").alias("position")).select("position", column)


def missing_from_snapshot(requested: DataFrame, existing: DataFrame, key: str = "ticker") -> DataFrame:
    """Requested rows whose key the snapshot does not hold."""
    return requested.join(existing.select(key).distinct(), key, "left_anti").select(requested.columns)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one that sorts last by ``order``, then by its other columns.

    So the result does not depend on the order of rows that arrive. The limit on row_number is applied on both sides of the shuffle, so the
    copies of a hot key are cut to one row per task before they travel.
    """
    others = [f.name for f in df.schema if f.name not in {*keys, *order} and _is_orderable(f.dataType)]
    latest = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(f"`{c}`") for c in [*order, *others]])
    return df.withColumn("_rank", F.row_number().over(latest)).filter("_rank = 1").drop("_rank")


def _is_orderable(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.MapType, T.VariantType))


def newest_delivery(raw: DataFrame, key: str, column: str = "delivery") -> DataFrame:
    """The rows of each key's newest delivery, which replaces earlier ones as a whole.

    Without a delivery column all rows are one delivery; rows without a value
    in it are older than all others. The newest per key is an aggregate of one
    row per key, so that a key's rows only meet to be filtered.
    """
    if column not in raw.columns:
        return raw
    newest = raw.groupBy(F.col(key).alias("_key")).agg(F.max(column).alias("_newest"))
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col(column).eqNullSafe(F.col("_newest"))
    return raw.join(newest, same, "left_semi").drop(column)


def without(existing: DataFrame, refreshed: DataFrame, column: str = "ticker") -> DataFrame:
    """Existing rows whose value is not being refreshed."""
    return existing.join(refreshed.select(column), column, "left_anti").select(existing.columns)


def merge_snapshot(
    existing: DataFrame,
    new: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    refreshed: DataFrame | None = None,
    refreshed_column: str = "ticker",
) -> DataFrame:
    """Upsert: drop the refreshed values' old rows, add the new rows, keep last.

    A refreshed value without new rows thus loses its old ones. New rows may
    carry a ``position`` to order those that share a key.
    """
    base = existing
    if refreshed is not None:
        base = without(existing, refreshed, refreshed_column)
    position = F.col("position") if "position" in new.columns else F.lit(0)
    both = base.select(*columns, F.lit(0).alias("_new"), F.lit(0).cast("bigint").alias("_position")).unionByName(
        new.select(*columns, F.lit(1).alias("_new"), position.cast("bigint").alias("_position"))
    )
    return keep_last(both, keys, ["_new", "_position"]).select(*columns)


def table_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with ``copies`` = new minus old.

    Empty when the tables hold the same rows. One aggregation does both
    directions and combines before the shuffle.
    """
    columns = old.columns
    signed = old.withColumn("_copy", F.lit(-1)).unionByName(
        new.select(*columns).withColumn("_copy", F.lit(1))
    )
    return signed.groupBy(*columns).agg(F.sum("_copy").alias("copies")).filter("copies <> 0")


def fingerprint(
    df: DataFrame, by: Sequence[str] = (), also_without: Sequence[str] = (), prefix: str = "other"
) -> DataFrame:
    """Row count and an order-free content hash, for the table or per group.

    A row's hash is an xxHash64 of its values, sorted by column name, behind a
    mark for each NULL, so that a NULL and a value never stand for each other.
    The hashes are added up in a decimal, as a bigint total would overflow.
    With ``also_without``, ``<prefix>_hash`` leaves those columns out, in the
    same pass.
    """

    def total(columns: Sequence[str]) -> Column:
        values = [F.col(f"`{c}`") for c in columns]
        marks = F.concat(*[F.when(v.isNull(), "1").otherwise("0") for v in values])
        hashed = F.xxhash64(marks, *[_hashable(df, c) for c in columns])
        return F.coalesce(F.sum(hashed.cast("decimal(20,0)")).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))

    columns = sorted(df.columns)
    out = [F.count(F.lit(1)).alias("n_rows"), total(columns).alias("content_hash")]
    if also_without:
        out.append(total([c for c in columns if c not in also_without]).alias(f"{prefix}_hash"))
    return df.groupBy(*by).agg(*out)


def _hashable(df: DataFrame, name: str) -> Column:
    """The column in a form that is hashed by value: -0.0 as 0.0, any NaN as one."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.when(column == 0, F.lit(0.0)).when(F.isnan(column), F.lit(float("nan"))).otherwise(column)
    return column


def portable_fingerprint(df: DataFrame) -> DataFrame:
    """Row count and a content hash that other engines can work out as well.

    A row's text holds each value, texts behind their length, and a mark for
    NULL, so that no two rows share one. The first 60 bits of its MD5 are added
    up in a decimal, as a bigint total would overflow.
    """

    def marked(name: str) -> Column:
        text = F.col(f"`{name}`").cast("string")
        if isinstance(df.schema[name].dataType, T.StringType):
            text = F.concat(F.length(text).cast("string"), F.lit(":"), text)
        return F.coalesce(text, F.lit("null"))

    digest = F.substring(F.md5(F.concat_ws(",", *[marked(c) for c in sorted(df.columns)])), 1, 15)
    row_hash = F.conv(digest, 16, 10).cast("bigint").cast("decimal(20,0)")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(row_hash), F.lit(0)).cast("decimal(38,0)").alias("content_hash"),
    )
