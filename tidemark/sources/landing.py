"""Landing tables: raw rows as an outside feed has delivered them.

Which files an ingest has taken is kept in a ledger beside the table it filled:
their path, length and time, the days they hold, the days that were wanted, and
the number of the batch; and for each ticker the last batch it was asked for in.
So a rerun opens only files that are new. A file is opened again only for days
it was not asked for, or for tickers that were not asked for when it was taken.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import RAW_EARNINGS, RAW_HOLDINGS, RAW_INFO, RAW_PRICES
from tidemark.sources import files
from tidemark.sources.store import Batch, Table, TableStore

SCHEMAS = {
    "raw_prices": RAW_PRICES,
    "raw_info": RAW_INFO,
    "raw_holdings": RAW_HOLDINGS,
    "raw_earnings": RAW_EARNINGS,
}
#: Prices may also land with a column per ticker and field, or with a file per ticker.
WIDE_PRICES, PRICES_BY_TICKER = "raw_prices_wide", "raw_prices_by_ticker"

_FILE = ["path", "length", "modified"]
LANDED = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        *(T.StructField(c, T.DateType()) for c in ("low", "high", "taken_from", "taken_to")),
        T.StructField("number", T.LongType()),
    ]
)
ASKED = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("through", T.LongType())])

Reader = Callable[[SparkSession, str, Sequence[str]], DataFrame]


def newest_landed(df: DataFrame) -> DataFrame:
    others = [f.name for f in LANDED if f.name not in _FILE]
    newest = df.groupBy(*_FILE).agg(F.max_by(F.struct(*others), "number").alias("_newest"))
    return newest.select(*_FILE, "_newest.*")


def newest_asked(df: DataFrame) -> DataFrame:
    return df.groupBy("ticker").agg(F.max("through").alias("through"))


def read_landing(spark: SparkSession, landing_dir: str, name: str, paths: Sequence[str] | None = None) -> DataFrame:
    """A landing table, or some of its files, with the columns it was delivered
    with; an empty one if there are none."""
    folder = f"{landing_dir}/{name}"
    if paths is None and files.exists(spark, folder):
        return spark.read.parquet(folder)
    if paths:
        return spark.read.option("basePath", folder).parquet(*paths)
    return spark.createDataFrame([], SCHEMAS.get(name, RAW_PRICES))


def _plain(path):
    """A path as every reader of Spark gives it, however many slashes follow the scheme."""
    return F.regexp_replace(path, r"^([A-Za-z0-9+.-]+):/+", "$1:/")


def _decoded(path):
    """A file's path as the listing has it; rows come with it escaped."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path, length and time of every Parquet file in a folder; none is opened."""
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(folder)
    )
    return found.select("path", "length", F.col("modificationTime").alias("modified"))


class Taken(NamedTuple):
    """What an ingest has to read: files not taken yet, and files taken before
    some of its tickers were asked for, with those tickers."""

    new: dict[str, list[str]]
    old: dict[str, list[str]]
    behind: DataFrame | None
    files: DataFrame | None  # the new ones, as listed
    landing_dir: str

    @property
    def is_new(self) -> bool:
        """Whether there is anything to note in the ledger."""
        return any(self.new.values()) or self.behind is not None

    def rows(self, spark: SparkSession, readers: dict[str, Reader], old: bool = False) -> DataFrame | None:
        """Rows of the new files, or those of old files of the tickers they were not taken for."""
        chosen = self.old if old else self.new
        parts = [read(spark, self.landing_dir, chosen[name]) for name, read in readers.items() if chosen.get(name)]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None


def take(
    store: TableStore,
    table: Table,
    landing_dir: str,
    names: Sequence[str],
    tickers: DataFrame,
    start: date | None = None,
    end: date | None = None,
) -> Taken:
    """Which landed files the tickers still need, by the ledger of a table."""
    spark = store.spark
    there = [name for name in names if files.exists(spark, f"{landing_dir}/{name}")]
    if not there:
        return Taken({}, {}, None, None, landing_dir)
    listed = reduce(
        DataFrame.unionByName,
        [list_files(spark, f"{landing_dir}/{name}").withColumn("name", F.lit(name)) for name in there],
    )
    known = newest_landed(store.read(table, "landed"))
    complete = F.col("number").isNotNull()
    if start is not None:
        complete &= F.coalesce((F.col("low") >= F.col("taken_from")) | (F.lit(start) >= F.col("taken_from")), F.lit(True))
        complete &= F.coalesce((F.col("high") <= F.col("taken_to")) | (F.lit(end) <= F.col("taken_to")), F.lit(True))
    marked = listed.join(known, _FILE, "left").withColumn("complete", complete)
    fresh = marked.filter("NOT complete")
    latest = known.agg(F.max("number")).first()[0] or 0
    through = tickers.select("ticker").join(newest_asked(store.read(table, "asked")), "ticker", "left")
    behind = through.filter(F.coalesce("through", F.lit(0)) < latest)
    least = behind.agg(F.min(F.coalesce("through", F.lit(0)))).first()[0]
    wanted = F.col("complete") & (F.col("number") > least) if least is not None else F.lit(False)
    new, old = {}, {}
    # Only what is about to be read: Spark's readers need the names too.
    for r in marked.filter(~F.col("complete") | wanted).select("name", "path", "complete").collect():
        (old if r["complete"] else new).setdefault(r["name"], []).append(r["path"])
    return Taken(new, old, None if least is None else behind.select("ticker"), fresh.select(*_FILE), landing_dir)


def note(
    store: TableStore,
    table: Table,
    batch: Batch,
    taken: Taken,
    tickers: DataFrame,
    start: date | None = None,
    end: date | None = None,
) -> None:
    """Write the ledger beside a batch that was made from what was taken."""
    number = F.lit(batch.last).cast("bigint")
    if any(taken.new.values()):
        noted = taken.files
        if start is not None:
            days = [
                store.spark.read.option("basePath", f"{taken.landing_dir}/{name}")
                .parquet(*paths)
                .select(_plain(_decoded(F.col("_metadata.file_path"))).alias("_plain"), F.col("Date").cast("string").try_cast("date").alias("day"))
                for name, paths in taken.new.items()
            ]
            days = reduce(DataFrame.unionByName, days)
            days = days.groupBy("_plain").agg(F.min("day").alias("low"), F.max("day").alias("high"))
            noted = noted.withColumn("_plain", _plain("path")).join(days, "_plain", "left")
        else:
            noted = noted.withColumns({c: F.lit(None).cast("date") for c in ("low", "high")})
        bounds = {"taken_from": F.lit(start).cast("date"), "taken_to": F.lit(end).cast("date"), "number": number}
        store.write(table, noted.withColumns(bounds).coalesce(1), batch, "landed")
    asked = tickers if any(taken.new.values()) else taken.behind
    store.write(table, asked.select("ticker", number.alias("through")).filter("ticker IS NOT NULL"), batch, "asked")
