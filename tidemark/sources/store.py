"""The data store: Parquet tables made of batches that are only ever added.

A batch holds rows and, where it replaces stored ones, the keys whose rows in
all earlier batches no longer count. Reading subtracts them, so that replacing
one key writes that key's rows only. Batches of like size are merged, each row
being copied a number of times that grows with the logarithm of their number.
Layout:

    <table>/g000001/<part>/batch=000007/          rows, and small tables beside them
    <table>/g000001/<part>/batch=000002-000006/   what batches 2 to 6 were merged into
    <table>/g000001/_published/000007             marker: the batch counts

The marker is written last, so readers never see half a write and a job that
dies leaves nothing but an unmarked folder. A merged batch counts instead of
those in its range. Published files are never changed: a job may read a table
and publish to it. Frames read earlier stay valid until their table has been
merged, or started anew, twice; then the files they were made from go.

One writer per table at a time is assumed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import files

MARKERS = "_published"
MAX_RECORDS_PER_FILE = 20_000_000
KEPT_GENERATIONS = 2
#: Batches of like size that are merged, and the bytes below which all are alike.
FAN, LIKE_BYTES = 4, 1 << 20
#: Keys that a batch replaces, and the number of the batch that did.
REPLACED = "replaced"
_REPLACED = T.StructType([T.StructField("key", T.StringType()), T.StructField("by", T.LongType())])


@dataclass(frozen=True)
class Table:
    """A table of the store: what its rows hold and how they are laid out.

    ``key`` is an SQL expression over the rows: batches replace rows by it.
    ``parts`` are small tables beside the rows, with their schemas; those in
    ``keyed`` have the key too and lose the same rows. ``reduce`` says how a
    part's rows of several batches become those of one.
    """

    name: str
    schema: T.StructType
    key: str
    sort: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    spread: bool = False
    parts: dict[str, T.StructType] = field(default_factory=dict)
    keyed: tuple[str, ...] = ("rows",)
    reduce: dict[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)

    def part_schema(self, part: str) -> T.StructType:
        return self.schema if part == "rows" else self.parts[part]


@dataclass(frozen=True)
class Batch:
    """A set of rows of a table that is published at once; it may stand for several."""

    generation: str
    first: int
    last: int

    @property
    def name(self) -> str:
        return f"{self.last:06d}" if self.first == self.last else f"{self.first:06d}-{self.last:06d}"

    @classmethod
    def named(cls, generation: str, name: str) -> Batch:
        ends = [int(n) for n in name.split("-")]
        return cls(generation, ends[0], ends[-1])

    def part(self, name: str) -> str:
        return f"{self.generation}/{name}/batch={self.name}"

    @property
    def marker(self) -> str:
        return f"{self.generation}/{MARKERS}/{self.name}"

    def stands_for(self, other: Batch) -> bool:
        return self != other and self.first <= other.first and other.last <= self.last


def to_merge(sizes: Sequence[int]) -> int:
    """How many of the newest batches to merge, given all sizes, oldest first.

    Sizes are in levels of powers of ``FAN``. The newest batches up to a level
    are merged if what they become is above it, so that a row climbs a level
    each time it is copied; small ones also if there are ``FAN`` of them.
    """

    def level(size: int) -> int:
        n, bound = 0, LIKE_BYTES * FAN
        while size >= bound:
            n, bound = n + 1, bound * FAN
        return n

    levels = [level(s) for s in sizes]
    found = 0
    for up_to in range(max(levels, default=-1) + 1):
        run = 0
        while run < len(levels) and levels[-1 - run] <= up_to:
            run += 1
        climbs = level(sum(sizes[len(sizes) - run :])) > up_to
        if (run >= FAN and (climbs or up_to == 0)) or (found and climbs and run > found):
            found = run
    return found


@dataclass(frozen=True)
class TableStore:
    spark: SparkSession
    root: str

    # --- reading ---

    def _published(self, generation: str) -> list[Batch]:
        names = files.children(self.spark, f"{generation}/{MARKERS}")
        return [Batch.named(generation, name) for name in names]

    def batches(self, table: Table) -> list[Batch]:
        """Batches that count, oldest first, of the newest generation that has any."""
        base = f"{self.root}/{table.name}"
        for name in reversed(files.children(self.spark, base)):
            published = self._published(f"{base}/{name}")
            if published:
                counting = [b for b in published if not any(o.stands_for(b) for o in published)]
                return sorted(counting, key=lambda b: b.first)
        return []

    def exists(self, table: Table) -> bool:
        """Whether the table has ever been written, be it without a row."""
        return bool(self._with_part(self.batches(table), "rows"))

    def read(self, table: Table, part: str = "rows") -> DataFrame:
        """The current rows of a part; an empty table if there are none."""
        return self.read_batches(table, self.batches(table), part)

    def read_batches(self, table: Table, batches: Sequence[Batch], part: str = "rows") -> DataFrame:
        """What some batches of one generation, in a row, make a part."""
        schema = table.part_schema(part)
        written = self._with_part(batches, part)
        replacing = self._with_part(batches, REPLACED) if part in table.keyed else []
        # Only batches before the newest that replaces anything can lose rows.
        whole = [b for b in written if not replacing or b.last >= replacing[-1].last]
        older = [b for b in written if b not in whole]
        out = self._read(whole, part, schema) if whole or not older else None
        if older:
            numbered = T.StructType([*schema, T.StructField("batch", T.StringType())])
            rows = self._read(older, part, numbered)
            number = F.substring_index("batch", "-", -1).cast("bigint")
            gone = self.replaced(replacing)
            rows = rows.withColumn("_key", F.expr(f"CAST({table.key} AS STRING)"))
            rows = rows.join(gone.withColumnRenamed("key", "_key"), "_key", "left")
            rows = rows.filter(F.col("by").isNull() | (F.col("by") <= number)).select(*schema.names)
            out = rows if out is None else out.unionByName(rows)
        return out

    def has_part(self, batch: Batch, part: str) -> bool:
        return files.exists(self.spark, batch.part(part))

    def _with_part(self, batches: Sequence[Batch], part: str) -> list[Batch]:
        """The batches that have a part; one listing, however many there are."""
        if not batches:
            return []
        written = set(files.children(self.spark, f"{batches[0].generation}/{part}"))
        return [b for b in batches if f"batch={b.name}" in written]

    def _read(self, batches: Sequence[Batch], part: str, schema: T.StructType) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{batches[0].generation}/{part}")
        return reader.parquet(*[b.part(part) for b in batches]).select(*schema.names)

    def replaced(self, batches: Sequence[Batch]) -> DataFrame:
        """Each key that some batches replace, and the newest batch that did."""
        rows = self._read(self._with_part(batches, REPLACED), REPLACED, _REPLACED)
        return rows.groupBy("key").agg(F.max("by").alias("by"))

    # --- writing ---

    def new_batch(self, table: Table, replace: bool = False) -> Batch:
        """An unused batch: after the current ones, or in a new generation."""
        base = f"{self.root}/{table.name}"
        current = self.batches(table)
        if current and not replace:
            generation = current[-1].generation
            taken = [
                Batch.named(generation, name.removeprefix("batch=")).last
                for part in files.children(self.spark, generation)
                for name in files.children(self.spark, f"{generation}/{part}")
            ]
            return Batch(generation, max(taken) + 1, max(taken) + 1)
        generations = files.children(self.spark, base)
        last = int(generations[-1][1:]) if generations else 0
        return Batch(f"{base}/g{last + 1:06d}", 1, 1)

    def write(self, table: Table, df: DataFrame, batch: Batch, part: str = "rows") -> DataFrame:
        """Write one part of an unpublished batch and read it back.

        Rows are sorted in the partitions they were computed in. Where the table
        is ``spread`` they are range partitioned on the sort columns first: this
        spreads a hot key over files and gives every file narrow statistics to
        prune by, but runs the last stage twice to find the ranges.
        """
        schema = table.part_schema(part)
        df = df.select(*schema.names)
        if part == "rows" and table.sort:
            if table.spread:
                df = df.repartitionByRange(*table.sort)
            df = df.sortWithinPartitions(*table.sort)
        writer = df.write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        if part == "rows" and table.partition_by:
            writer = writer.partitionBy(*table.partition_by)
        writer.parquet(batch.part(part))
        return self._read([batch], part, schema)

    def write_scratch(self, df: DataFrame, batch: Batch, part: str) -> DataFrame:
        """Write rows beside a batch that are no part of the table, and read them back."""
        df.write.parquet(batch.part(part))
        return self.spark.read.schema(df.schema).parquet(batch.part(part))

    def write_replaced(self, keys: DataFrame, batch: Batch) -> None:
        """Have a batch replace the rows of some keys (the only column of ``keys``)."""
        named = keys.select(F.col(keys.columns[0]).cast("string").alias("key")).filter("key IS NOT NULL").distinct()
        named.withColumn("by", F.lit(batch.last).cast("bigint")).write.parquet(batch.part(REPLACED))

    def publish(self, batch: Batch) -> None:
        """Make a batch count, and delete what nobody should read any more."""
        files.create_empty(self.spark, batch.marker)
        table, newest = batch.generation.rsplit("/", 1)
        older = [g for g in files.children(self.spark, table) if g < newest]
        for generation in older[: 1 - KEPT_GENERATIONS]:
            files.remove(self.spark, f"{table}/{generation}")
        if batch.first < batch.last:
            published = self._published(batch.generation)
            for b in published:  # merged before this time
                if any(o.stands_for(b) for o in published if o != batch):
                    files.remove(self.spark, b.marker)
                    self._remove_parts(b)

    def discard(self, batch: Batch) -> None:
        """Delete what was written of a batch that is not to be published."""
        if not files.children(self.spark, f"{batch.generation}/{MARKERS}"):
            files.remove(self.spark, batch.generation)
            return
        self._remove_parts(batch)

    def _remove_parts(self, batch: Batch) -> None:
        self.drop_parts(batch, [p for p in files.children(self.spark, batch.generation) if p != MARKERS])

    def drop_parts(self, batch: Batch, parts: Sequence[str]) -> None:
        """Delete some of what was written of a batch that is not yet published."""
        for part in parts:
            files.remove(self.spark, batch.part(part))

    def replace(self, table: Table, df: DataFrame) -> None:
        """Write a table whole and publish it."""
        batch = self.new_batch(table, replace=True)
        self.write(table, df, batch)
        self.publish(batch)

    def append(self, table: Table, df: DataFrame, replaced: DataFrame | None = None) -> None:
        """Publish rows beside the current ones, in place of those of ``replaced`` keys."""
        batch = self.new_batch(table)
        self.write(table, df, batch)
        if replaced is not None:
            self.write_replaced(replaced, batch)
        self.publish(batch)

    def merge(self, table: Table) -> Batch | None:
        """Merge the newest batches if enough of them are of like size."""
        batches = self.batches(table)
        if len(batches) < FAN:
            return None
        sizes = [max(files.size(self.spark, b.part("rows")), 1) for b in batches]
        count = to_merge(sizes)
        return self.merge_newest(table, count) if count else None

    def merge_newest(self, table: Table, count: int) -> Batch:
        """Write the newest batches as one that counts instead of them; one alone stays as it is."""
        some = self.batches(table)[-count:]
        if len(some) < 2:
            return some[0]
        merged = Batch(some[0].generation, some[0].first, some[-1].last)
        self._remove_parts(merged)  # of a merge that died
        for part in ("rows", *table.parts):
            if self._with_part(some, part):
                rows = self.read_batches(table, some, part)
                self.write(table, table.reduce.get(part, lambda df: df)(rows), merged, part)
        if self._with_part(some, REPLACED):
            self.replaced(some).write.parquet(merged.part(REPLACED))
        self.publish(merged)
        return merged
