"""Session settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings results depend on; safe on any session.

    Days are UTC days, so the session time zone is UTC.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only where the cluster names none, and the session is local, is one made.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        current = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(current)
    return current


def settled(df: DataFrame) -> DataFrame:
    """The frame computed once and kept in the folder all executors see.

    It stays valid whatever becomes of the tables it was made from.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def local_session(app: str, cpus: str | int = "*", memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
