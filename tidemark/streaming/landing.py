"""Delivery of landed rows as streams instead of by rescans.

The reading position is kept in a checkpoint, so each run reads only the
files that have landed since the last one.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pyspark.sql import types as T

from tidemark.plans.market import Tickers, deliver, ingest_prices
from tidemark.schemas import RAW_EARNINGS, RAW_HOLDINGS, RAW_INFO, RAW_PRICES, Config
from tidemark.session import prepare


def stream_prices(
    spark: SparkSession,
    tickers: Tickers = None,
    *,
    start_date: date | None = None,
    end_date: date | None = None,
    config: Config,
    checkpoint: str,
) -> StreamingQuery:
    """Ingest the price files that are new in the landing folder, then stop.

    Every micro-batch is one `ingest_prices`, which takes only days after a
    ticker's last stored one; a batch that is replayed after a failure thus
    adds nothing twice.
    """
    landed = prepare(spark).readStream.schema(RAW_PRICES).parquet(f"{config.landing_dir}/raw_prices")

    def store_batch(batch: DataFrame, _: int) -> None:
        ingest_prices(
            tickers, start_date=start_date, end_date=end_date, config=config, landed=batch
        )

    return (
        landed.writeStream.foreachBatch(store_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _numbered(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema, T.StructField("delivery", T.LongType())])


# Landing table of each dataset, and the columns its files must have.
SNAPSHOTS = {
    "sectors": ("raw_info", RAW_INFO),
    "etf_metadata": ("raw_info", RAW_INFO),
    "etf_holdings": ("raw_holdings", _numbered(RAW_HOLDINGS)),
    "earnings": ("raw_earnings", _numbered(RAW_EARNINGS)),
}


def stream_snapshot(
    spark: SparkSession, dataset: str, tickers: Tickers = None, *, config: Config, checkpoint: str
) -> StreamingQuery:
    """Take what is new of a dataset in the landing folder, then stop.

    Every micro-batch is one `deliver`: of each key the newest delivery counts,
    by the number that is kept beside the stored rows, so that a batch that is
    replayed, or comes after a newer one, changes nothing.
    """
    name, schema = SNAPSHOTS[dataset]
    landed = prepare(spark).readStream.schema(schema).parquet(f"{config.landing_dir}/{name}")

    def store_batch(batch: DataFrame, _: int) -> None:
        deliver(dataset, batch, tickers, config=config)

    return (
        landed.writeStream.foreachBatch(store_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
