"""Market data as seen in the generated test tables.

These views adapt the given tables to the operators; they are not operators.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# One more than the largest payload of a trade.
PAYLOAD = 10**15

_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is inferred once per path."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _trades(
    spark: SparkSession, sf_dir: str, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Line items as trades; the date bounds reach the scan.

    Order key and payload (price cents, quantity, discount) go into one
    decimal: its min and max are the first and last trade of a day, found by
    hash aggregation, where a struct would need a sort.
    """
    lines = table(spark, sf_dir, "lineitem")
    if start is not None:
        lines = lines.filter(f"l_shipdate >= TIMESTAMP_NTZ'{start}'")
    if end is not None:
        lines = lines.filter(f"l_shipdate < TIMESTAMP_NTZ'{end + timedelta(days=1)}'")
    payload = (
        "CAST(l_extendedprice * 100 + 0.5D AS BIGINT) * 100000"
        " + CAST(l_quantity AS BIGINT) * 100 + CAST(l_discount * 100 + 0.5D AS BIGINT)"
    )
    return lines.selectExpr(
        "l_partkey",
        "l_suppkey",
        "CAST(l_shipdate AS DATE) AS date",
        "l_extendedprice / l_quantity AS price",
        "l_quantity AS quantity",
        f"CAST(l_orderkey * 8 + l_linenumber AS DECIMAL(20, 0)) * {PAYLOAD} + ({payload}) AS packed",
    )


def _to_bars(trades: DataFrame, *keys: str) -> DataFrame:
    daily = trades.groupBy(*keys, "date").agg(
        F.min("packed").alias("first"),
        F.max("packed").alias("last"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.sum("quantity").alias("volume"),
    )
    unpacked = daily.selectExpr(
        "*",
        f"CAST(first % {PAYLOAD} AS BIGINT) AS opening",
        f"CAST(last % {PAYLOAD} AS BIGINT) AS closing",
    )
    closed = "closing div 100000 / 100.0D / (closing div 100 % 1000)"
    return unpacked.selectExpr(
        *keys,
        "date",
        "opening div 100000 / 100.0D / (opening div 100 % 1000) AS open",
        "high",
        "low",
        f"{closed} AS close",
        "CAST(volume AS BIGINT) AS volume",
        f"{closed} * (1 - closing % 100 / 100.0D) AS adj_close",
    )


def bars(
    spark: SparkSession, sf_dir: str, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Daily bars per brand."""
    brands = table(spark, sf_dir, "part").selectExpr("p_partkey AS l_partkey", "p_brand AS ticker")
    return _to_bars(_trades(spark, sf_dir, start, end).join(brands, "l_partkey"), "ticker")


def etf_bars(
    spark: SparkSession, sf_dir: str, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Daily bars per supplier; trades are rolled up before they meet the names."""
    daily = _to_bars(_trades(spark, sf_dir, start, end), "l_suppkey")
    names = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS l_suppkey", "s_name AS ticker")
    return daily.join(names, "l_suppkey").drop("l_suppkey")


def etf_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS s_nationkey", "n_name")
    return table(spark, sf_dir, "supplier").join(nations, "s_nationkey").selectExpr(
        "s_name AS ticker", "concat('Fund ', s_suppkey) AS name", "n_name AS category"
    )


def raw_holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A region's nations, held by their share of the customers' balance."""
    nations = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    regions = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    balance = F.expr("sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS cents")
    by_nation = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(balance)
    held = by_nation.join(nations, "c_nationkey").join(regions, "n_regionkey")
    totals = held.groupBy("n_regionkey").agg(F.sum("cents").alias("total"))
    return held.join(totals, "n_regionkey").selectExpr(
        "r_name AS etf",
        "CAST(c_nationkey AS BIGINT) AS position",
        "n_name AS Symbol",
        "concat('Holding of ', n_name) AS Name",
        "cents / total AS `Holding Percent`",
    )


def raw_earnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signups as earnings, their time given as local time at UTC-5."""
    return (
        table(spark, sf_dir, "events")
        .filter("event_type = 'signup'")
        .selectExpr(
            "CAST(user_id AS STRING) AS ticker",
            "event_id AS position",
            "concat(ts, '-05:00') AS `Earnings Date`",
            "if(value >= 50, 'amc', 'bmo') AS `Event Time`",
        )
    )


def raw_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Info documents per user, made from the props of their events."""
    events = table(spark, sf_dir, "events").selectExpr(
        "*", "CAST(get_json_object(props, '$.k') AS BIGINT) AS k"
    )
    fields = [
        "if(k % 3 != 0, event_type, NULL) AS sector",
        "if(k % 4 != 0, concat('Industry ', k), NULL) AS industry",
        "if(k % 2 = 0, 'ETF', 'EQUITY') AS quoteType",
        "if(k % 5 = 0, '', concat('Long ', k)) AS longName",
        "if(k % 7 != 0, concat('Short ', k), NULL) AS shortName",
        "k * 86400 AS fundInceptionDate",
        "event_id AS firstTradeDateEpochUtc",
    ]
    return events.selectExpr(
        "CAST(user_id AS STRING) AS ticker",
        f"to_json(struct({', '.join(fields)})) AS info_json",
        "event_id AS position",
    )


def dirty_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as holdings records whose tickers need cleaning."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "concat(lower(substr(p_type, 1, 4)), '.', p_size) AS raw_ticker",
        "p_name AS name",
        "p_brand AS sector",
        "if(p_partkey % 4 = 0, 'Cash', 'Equity') AS asset_class",
        "p_retailprice AS weight_pct",
    )
