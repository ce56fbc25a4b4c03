from __future__ import annotations

import gzip
import hashlib
import random

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import RUN_DATE, rows

import tidemark as tm
from tidemark.operators import universe
from tidemark.sources import files

HOLDINGS = (
    "﻿Fund Holdings\r\n"
    'As of,"Jan 01, 2024"\r\n'
    "\r\n"
    "Ticker,Name,Sector,Asset Class,Weight (%)\r\n"
    'brk.b,"Berkshire ""B"", Inc",Financials,Equity,1.5\r\n'
    "AAPL,Apple,Tech,Equity,7.25\r\n"
    "-,Placeholder,Tech,Equity,0.1\r\n"
    ",Nameless,Tech,Equity,0.1\r\n"
    "USD,Dollars,Cash,Cash,0.3\r\n"
    "BAD,Too,Many,Equity,1,2,3\r\n"
    "SHORT,Few\r\n"
    "NOWT,Weightless,Tech,Equity,n/a\r\n"
)
OTHER_ORDER = "Ticker,Asset Class,Weight (%),Sector,Name,Extra\nMSFT,Equity,6,Tech,Microsoft,\n"


@pytest.fixture
def feed(spark, tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    (folder / "a.csv").write_bytes(HOLDINGS.encode())
    (folder / "b.csv").write_bytes(OTHER_ORDER.encode())
    (folder / "c.csv").write_bytes(b"no table here\n")
    return str(folder)


def test_holdings_files_are_read_by_their_header(spark, feed):
    records, no_table = universe.holdings_records(files.read_holdings_lines(spark, feed))
    assert [r.path.rsplit("/", 1)[1] for r in no_table.collect()] == ["c.csv"]
    assert rows(universe.sp500_rows(records, RUN_DATE), "ticker", "name", "sector", "weight_pct") == [
        ("AAPL", "Apple", "Tech", 7.25),
        ("BRK-B", 'Berkshire "B", Inc', "Financials", 1.5),
        ("MSFT", "Microsoft", "Tech", 6.0),
        ("NOWT", "Weightless", "Tech", None),
    ]
    assert rows(universe.ticker_rejects(records), "ticker") == [("-",)]


def test_a_large_holdings_file_is_read_by_many_tasks(spark, tmp_path):
    names = [f"T{i}" for i in range(5000)]
    lines = ["prelude"] * 50 + ["Ticker,Name,Sector,Asset Class,Weight (%)"]
    lines += [f"{n},Name {n},Tech,Equity,1" for n in names]
    (tmp_path / "big.csv").write_text("\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        text = files.read_holdings_lines(spark, str(tmp_path))
        assert text.rdd.getNumPartitions() > 4
        records, _ = universe.holdings_records(text)
        assert rows(universe.sp500_rows(records, RUN_DATE), "ticker") == sorted((n,) for n in names)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_build_sp500_writes_a_universe_file(spark, feed, tmp_path):
    config = tm.Config(str(tmp_path), str(tmp_path), str(tmp_path / "universe"), run_date=RUN_DATE)
    tm.build_sp500(feed, config=config)
    listed = files.read_sp500(spark, config.universe_dir)
    assert rows(listed, "position", "ticker", "name", "retrieved_at")[1] == (
        1,
        "BRK-B",
        'Berkshire "B", Inc',
        RUN_DATE,
    )


def test_manifest_hashes_every_file(spark, tmp_path):
    (tmp_path / "x" / "y").mkdir(parents=True)
    (tmp_path / "x" / "y" / "b.bin").write_bytes(b"two")
    (tmp_path / "x" / "a.bin").write_bytes(b"one")
    (tmp_path / "x" / "_hidden").write_bytes(b"no")
    found = tm.data_store_manifest(spark, str(tmp_path / "x")).collect()
    assert [tuple(r) for r in found] == [
        (name, 3, hashlib.sha256(data).hexdigest()) for name, data in (("a.bin", b"one"), ("y/b.bin", b"two"))
    ]
    assert tm.data_store_manifest(spark, str(tmp_path / "absent")).isEmpty()
    tm.write_manifest(spark, str(tmp_path / "x"), str(tmp_path / "manifest"))
    written = spark.read.option("header", True).csv(str(tmp_path / "manifest"))
    assert rows(written, "path", "size_bytes") == [("a.bin", "3"), ("y/b.bin", "3")]


def test_manifest_hashes_long_files_in_chunks(spark, tmp_path, monkeypatch):
    some = random.Random(1).randbytes
    lines = "".join(f"{i},line {i}\r\n" for i in range(5000)).encode()
    contents = {
        "ends.csv": lines,
        "goes on.csv": lines + b"no line feed",
        "marked.csv": b"\xef\xbb\xbf" + lines,
        "marked 100%+ü.csv": b"\xef\xbb\xbf" + lines + b"\xef\xbb\xbf\n\xef\xbb\xbf",
        "y/any bytes": some(150_001),
        "y/the same bytes": some(20_000) * 4,
        "line feeds": b"\n" * 50_000,
        "one line": b"\r\0" * 30_000,
        "longest short": some(20_000),
        "shortest long": some(20_001),
        "packed.csv.GZ": gzip.compress(some(30_000)),
        "packed.csv.gz": gzip.compress(some(30_000)),
        "_hidden": lines,
    }
    contents["y/z/the same bytes"] = contents["y/the same bytes"]
    contents["y/z/as many bytes"] = some(80_000)
    for name, data in contents.items():
        path = tmp_path / "x" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    del contents["_hidden"]
    monkeypatch.setattr(files, "CHUNK_BYTES", 20_000, raising=False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    # No longer file may be a row.
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "40000")
    try:
        found = tm.data_store_manifest(spark, str(tmp_path / "x"))
        assert found.dtypes == [("path", "string"), ("size_bytes", "bigint"), ("sha256", "string")]
        assert rows(found) == sorted(
            ((name, len(data), hashlib.sha256(data).hexdigest()) for name, data in contents.items()), key=repr
        )
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_ticker_files_with_nanosecond_dates_are_read(spark, tmp_path):
    schema = pa.schema(
        [("date", pa.timestamp("ns"))]
        + [(c, pa.float64()) for c in ("open", "high", "low", "close")]
        + [("volume", pa.int64()), ("adj_close", pa.float64())]
    )
    frame = pd.DataFrame({"date": pd.to_datetime(["2024-01-02", "1969-12-31"]), "volume": [7, 8]})
    for name in ("open", "high", "low", "close", "adj_close"):
        frame[name] = 1.5
    table = pa.Table.from_pandas(frame, schema=schema, preserve_index=False)
    pq.write_table(table, tmp_path / "BRK-B.parquet", version="2.6")
    with pytest.raises(ValueError, match="nanosAsLong"):
        files.read_ticker_files(spark, str(tmp_path))
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    try:
        found = files.read_ticker_files(spark, str(tmp_path))
        assert [(t, str(d), v) for t, d, v in rows(found, "ticker", "date", "volume")] == [
            ("BRK-B", "1969-12-31", 8),
            ("BRK-B", "2024-01-02", 7),
        ]
    finally:
        spark.conf.unset("spark.sql.legacy.parquet.nanosAsLong")


def test_headers_are_sent_to_the_lines(spark, feed):
    def plan(few):
        records, _ = universe.holdings_records(files.read_holdings_lines(spark, feed), few)
        return records._jdf.queryExecution().executedPlan().toString()

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(False)
        sent = plan(True)
        assert "BroadcastHashJoin" in sent and "SortMergeJoin" not in sent
        assert files.are_few(spark, feed) and not files.are_few(spark, feed + "/absent")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_long_csv_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    rows_ = spark.range(20).selectExpr("CAST(id AS STRING) AS ticker", "'n' AS name", "'c' AS category").repartition(4)
    for most, parts in ((20, 1), (19, 4)):
        monkeypatch.setattr(files, "ONE_FILE_ROWS", most)
        path = tmp_path / f"etf_candidates{most}.csv"
        files.write_csv(rows_, str(path))
        assert len(list(path.glob("part-*"))) == parts
        assert files.read_csv(spark, str(path), files.ETF_CANDIDATES).count() == 20
