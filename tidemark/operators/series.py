"""Cutting long series into chunks that windows can run over independently."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SERIES = ["ticker", "chunk"]

# Width of the date blocks that chunks are put together from.
BLOCK_DAYS = 32


def split_series(bars: DataFrame, lookback: int, split_rows: int) -> DataFrame:
    """Bars with ``chunk`` and ``borrowed``, for windows over (ticker, chunk).

    A series is cut every ``split_rows`` rows or so, at block borders. Each
    chunk also borrows the blocks before it that hold the ``lookback`` rows
    its first row needs, so row frames of that depth come out exactly as over
    the whole series. Only the counts per (ticker, block) are windowed by
    ticker: one row per month of history, whatever the size of the series.
    """
    if split_rows < lookback:
        # Keeps borrowing within the two chunks that follow a block.
        raise ValueError(f"split_rows {split_rows} is below the look-back of {lookback} rows")
    block = F.floor(F.unix_date("date") / BLOCK_DAYS).alias("block")
    counts = bars.groupBy("ticker", block).agg(F.count(F.lit(1)).alias("n"))

    by_block = Window.partitionBy("ticker").orderBy("block")
    by_cut = Window.partitionBy("ticker").orderBy("cut")
    by_chunk = Window.partitionBy("ticker").orderBy("chunk")
    ends = F.col("starts") + F.col("n")

    def start_of(distance: int):
        return F.min("starts").over(by_chunk.rangeBetween(distance, distance))

    placed = (
        counts.withColumn("starts", F.sum("n").over(by_block) - F.col("n"))
        .withColumn("cut", F.floor(F.col("starts") / split_rows))
        .withColumn("chunk", F.dense_rank().over(by_cut))
        .select(
            "ticker",
            "block",
            F.col("chunk").alias("own"),
            F.array_compact(
                F.array(
                    "chunk",
                    F.when(start_of(1) - ends < lookback, F.col("chunk") + 1),
                    F.when(start_of(2) - ends < lookback, F.col("chunk") + 2),
                )
            ).alias("chunks"),
        )
    )
    return (
        bars.withColumn("block", block)
        .join(placed, ["ticker", "block"])
        .withColumn("chunk", F.explode("chunks"))
        .select(*bars.columns, "chunk", (F.col("chunk") != F.col("own")).alias("borrowed"))
    )
