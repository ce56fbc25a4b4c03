"""Input tables, frames cut off from their lineage, and code for the workers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import prepare, shared_folder

_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows and bytes of text that go to a Python worker at once; whole texts wait there and in Spark.
BATCH_ROWS, BATCH_BYTES = "1000", "16m"


def ready(spark: SparkSession) -> SparkSession:
    """The session set up, and this package sent to its Python workers once."""
    context = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    if context.applicationId not in _shipped:
        _ship(context)
        _shipped.add(context.applicationId)
    return prepare(spark)


def _ship(context: SparkContext) -> None:
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark_package.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    whole = os.path.join(folder, name)
                    out.write(whole, os.path.relpath(whole, os.path.dirname(top)))
    context.addPyFile(path)


def stored(df: DataFrame) -> DataFrame:
    """The frame written to the folder all executors share, and read back.

    Later steps start from the files, so that a lost executor costs nothing
    that is behind them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/step-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
