"""Plain files: universe CSVs, holdings files with a prelude, manifests."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import BARS, ETF_CANDIDATES, ETFS, SP500
from tidemark.session import settled, shared_folder


# Some 10 MB of headers.
FEW_FILES = 20_000
# Longest CSV that one task writes.
ONE_FILE_ROWS = 1_000_000
# Longest file that one task reads for its hash, and what it reads of a longer one.
CHUNK_BYTES = 128 << 20
# Names of files that the text reader unpacks.
COMPRESSED = r"(?i)\.(bz2|deflate|gz|lz4|snappy|zst)$"
# A piece of a long file: its number, the block it is in, and its place there.
PIECE = "number int, block long, place long, content binary"


class UniverseSnapshotMissing(FileNotFoundError):
    """A universe file is absent; `build_sp500` and `build_etfs` write them."""


def _hadoop(spark: SparkSession, path: str):
    """The path as a Hadoop object, and the file system it is on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _hadoop(spark, path)
    return fs.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder, sorted; none if it does not exist."""
    target, fs = _hadoop(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a folder; 0 if it does not exist."""
    target, fs = _hadoop(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def create_empty(spark: SparkSession, path: str) -> None:
    target, fs = _hadoop(spark, path)
    fs.create(target, False).close()


def remove(spark: SparkSession, path: str) -> None:
    target, fs = _hadoop(spark, path)
    fs.delete(target, True)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A universe CSV, with ``position`` for the order of its lines."""
    if not exists(spark, path):
        raise UniverseSnapshotMissing(
            f"{path} not found. Run tidemark.build_sp500 and tidemark.build_etfs"
        )
    rows = spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)
    return rows.select(F.monotonically_increasing_id().alias("position"), "*")


def read_sp500(spark: SparkSession, universe_dir: str) -> DataFrame:
    return read_csv(spark, f"{universe_dir}/sp500.csv", SP500)


def read_etfs(spark: SparkSession, universe_dir: str) -> DataFrame:
    return read_csv(spark, f"{universe_dir}/etfs.csv", ETFS)


def read_etf_candidates(spark: SparkSession, universe_dir: str) -> DataFrame:
    return read_csv(spark, f"{universe_dir}/etf_candidates.csv", ETF_CANDIDATES)


def write_csv(df: DataFrame, path: str) -> None:
    """A table as CSV with a header: one part file, or as many as it has
    partitions if it is longer than a task should write."""
    rows = settled(df)
    if rows.limit(ONE_FILE_ROWS + 1).count() <= ONE_FILE_ROWS:
        rows = rows.coalesce(1)
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def are_few(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds so few files that a row for each can be broadcast."""
    target, fs = _hadoop(spark, path)
    return fs.exists(target) and fs.getContentSummary(target).getFileCount() <= FEW_FILES


def read_holdings_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of holdings files as (path, place, line).

    ``place`` orders the lines of a file: the block of the file they are in,
    then their order inside it. Large files are split over tasks.
    """
    text = spark.read.option("recursiveFileLookup", True).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("path"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("place"),
        F.col("value").alias("line"),
    )


def data_store_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Relative path, size and SHA-256 of every file under a folder, unordered.

    Files whose name starts with ``_`` or ``.`` are not data and are left out.
    A file is one row; one longer than ``CHUNK_BYTES`` is read by many tasks,
    and hashed at the call. The text reader would unpack compressed files, so
    these are one row at any length, and refused by Spark with an error above 2 GB.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], "path string, size_bytes bigint, sha256 string")
    target, fs = _hadoop(spark, path)
    root = fs.makeQualified(target).toUri().getPath().rstrip("/") + "/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    relative = F.substring_index(F.col("path"), root, -1).alias("path")
    size_bytes = F.col("length").alias("size_bytes")
    # Both are columns of the listing, so that a file is opened on one side only.
    is_long = (F.col("_metadata.file_size") > CHUNK_BYTES) & ~F.col("_metadata.file_name").rlike(COMPRESSED)
    listed = files.where(is_long).select(F.col("_metadata.file_path").alias("file"), relative, size_bytes)
    if listed.isEmpty():
        return files.select(relative, size_bytes, F.sha2("content", 256).alias("sha256"))
    short = files.where(~is_long).select(relative, size_bytes, F.sha2("content", 256).alias("sha256"))
    text = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(path)
    return short.unionByName(_hash_by_chunks(listed, text.where(is_long)))


def _hash_by_chunks(listed: DataFrame, text: DataFrame) -> DataFrame:
    """Path, size and SHA-256 of long files, from their listing and their lines.

    A hash takes the bytes of a file in order, but need not do so in one task.
    All blocks are read side by side into pieces; then, round by round, a task
    for each file takes its hash over one more chunk, from the state that the
    round before has left. So a task reads a chunk, however long the file is.
    """
    spark = listed.sparkSession
    folder = f"{shared_folder(spark).rstrip('/')}/chunks-{uuid.uuid4().hex}"
    # One row for each long file, the longest first.
    number = F.row_number().over(Window.orderBy(F.desc("size_bytes"), "file")) - 1
    listed = settled(listed.select(number.alias("number"), "*"))

    lines = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("line"),
    )
    numbered = lines.join(F.broadcast(listed.select("file", "number")), "file").select("number", "block", "line")
    pieces = numbered.mapInArrow(_joined_lines(), f"{PIECE}, size long")
    a_round = F.expr(f"CAST(block DIV {CHUNK_BYTES} AS INT)")
    pieces.withColumn("round", a_round).write.partitionBy("round").parquet(f"{folder}/pieces")
    pieces = spark.read.schema(f"{PIECE}, size long, round int").parquet(f"{folder}/pieces")

    # Lines come without a byte order mark before the first, and all with a
    # line feed, which the last need not have had.
    sizes = pieces.groupBy("number").agg(F.sum("size").alias("size"))
    missing = (F.col("size_bytes") - F.coalesce("size", F.lit(0))).alias("missing")
    listed = settled(listed.join(sizes, "number", "left").select("number", "path", "size_bytes", missing))
    changed = listed.where(~F.col("missing").isin(-1, 0, 2, 3)).first()
    if changed:
        raise OSError(f"{changed.path} was not read whole: {changed.missing} bytes are missing")
    marks = listed.where("missing >= 2").selectExpr(
        "number", "0L AS block", "-1L AS place", "X'EFBBBF' AS content", "3L AS size", "0 AS round"
    )
    pieces = pieces.unionByName(marks)

    rounds = listed.groupBy(F.expr(f"CAST((size_bytes - 1) DIV {CHUNK_BYTES} AS INT)").alias("last")).count().collect()
    states = listed.selectExpr("number", "-1L AS block", "size_bytes AS place", "CAST(NULL AS BINARY) AS content")
    for k in range(max(r["last"] for r in rounds) + 1):
        chunk = pieces.where(F.col("round") == k).select(states.columns)
        going_on = sum(r["count"] for r in rounds if r["last"] >= k)
        fed = (
            states.where("place > 0")
            .unionByName(chunk)
            .repartitionById(going_on, "number")
            .sortWithinPartitions("number", "block", "place")
        )
        fed.mapInArrow(_fed_to_hash(), PIECE).write.parquet(f"{folder}/states/{k}")
        states = spark.read.schema(PIECE).parquet(f"{folder}/states/{k}")

    ended = spark.read.schema(PIECE).option("recursiveFileLookup", True).parquet(f"{folder}/states").where("place = 0")
    sha256 = F.lower(F.hex("content")).alias("sha256")
    hashed = settled(listed.join(ended, "number").select("path", "size_bytes", sha256))
    remove(spark, folder)
    return hashed


def _joined_lines():
    """Lines as (number, block, line) to ``PIECE`` and its size: the lines of a
    block that come in one batch, each with its line feed."""

    def join(batches):
        import numpy as np
        import pyarrow as pa

        place = 0
        for batch in batches:
            number, block = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            cuts = np.flatnonzero((np.diff(number) != 0) | (np.diff(block) != 0)) + 1
            for start, stop in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if start == stop:
                    continue
                content = b"\n".join([*batch.column(2).slice(start, stop - start).to_pylist(), b""])
                row = ([number[start]], [block[start]], [place], [content], [len(content)])
                types = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(row, types, strict=True)],
                    ["number", "block", "place", "content", "size"],
                )
                place += 1

    return join


def _fed_to_hash():
    """Each file's state, ``PIECE`` with block -1 and the bytes to go as place,
    then its next pieces in order, to its next state; to the digest at the end.

    The state is OpenSSL's SHA256_CTX, from the library that hashlib is made with.
    """

    def feed(batches):
        import _hashlib
        import ctypes

        import pyarrow as pa

        crypto = ctypes.CDLL(_hashlib.__file__)
        crypto.SHA256_Update.argtypes = [ctypes.c_void_p, ctypes.c_char_p, ctypes.c_size_t]
        state, digest = ctypes.create_string_buffer(112), ctypes.create_string_buffer(32)

        def row(number, left):
            if left == 0:
                crypto.SHA256_Final(digest, state)
            values = ([number], [-1], [left], [digest.raw if left == 0 else state.raw])
            types = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(values, types, strict=True)], ["number", "block", "place", "content"]
            )

        current = None
        for batch in batches:
            for i in range(batch.num_rows):
                number, block, place, content = (c[i].as_py() for c in batch.columns)
                if block == -1:
                    if current is not None:
                        yield row(current, left)
                    current, left = number, place
                    if content is None:
                        crypto.SHA256_Init(state)
                    else:
                        state.raw = content
                    continue
                if number != current:
                    raise ValueError(f"a piece of file {number} has no state to go on from")
                content = content[:left]
                crypto.SHA256_Update(state, content, len(content))
                left -= len(content)
        if current is not None:
            yield row(current, left)

    return feed


def write_manifest(spark: SparkSession, path: str, target: str) -> None:
    """Write the manifest of a folder as CSV, by path.

    The hashes are written first: sorting samples its input, and would read
    and hash all files again.
    """
    unsorted = f"{target.rstrip('/')}.unsorted"
    data_store_manifest(spark, path).write.mode("overwrite").parquet(unsorted)
    write_csv(spark.read.parquet(unsorted).orderBy("path"), target)
    remove(spark, unsorted)


def read_ticker_files(spark: SparkSession, path: str) -> DataFrame:
    """Bars from a folder with one Parquet file per ticker, named after it.

    Such files hold nanosecond dates, which Spark reads as numbers only where
    the session says so; that changes other reads too and is left to the caller.
    """
    if spark.conf.get("spark.sql.legacy.parquet.nanosAsLong") != "true":
        raise ValueError("set spark.sql.legacy.parquet.nanosAsLong to true to read per-ticker files")
    schema = T.StructType(
        [T.StructField("date", T.LongType())]
        + [f for f in BARS if f.name not in ("ticker", "date")]
    )
    rows = spark.read.schema(schema).parquet(path)
    ticker = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.parquet$", 1)
    day = F.date_from_unix_date(F.floor(F.col("date") / (86400 * 10**9)).cast("int"))
    return rows.select(
        ticker.alias("ticker"), day.alias("date"), *[c for c in BARS.names if c not in ("ticker", "date")]
    )
