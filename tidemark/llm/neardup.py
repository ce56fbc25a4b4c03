"""Near duplicates by a multi-index Hamming join of b-bit MinHash signatures.

A document is the set of its distinct five-word shingles. Documents of one set
form a class, and one of them stands for it. A class has a signature of 35
positions of 16 bits. Pairs whose signatures differ in at most 20 positions are
found without fail: cut into 7 chunks of 5 positions, some chunk of such a pair
differs in at most 2 positions, so that for some choice of 3 positions in it
both have the same values. Every choice in every chunk is a key (70 of them),
and a pair meets in at least one. Two sets of Jaccard similarity 0.75 differ in
more than 20 positions with a probability of about 1 in 100,000.

Only links between components matter, so pairs are not all listed. First each
class is compared with one class of each of its keys, the key's centre, and
the confirmed links give components. Then all pairs that share a key but no
component are compared. To spare most of these, sets are banded by size, and a
class is left out if in no band the sets of other components hold enough of its
shingles: its similarity to all of them is below 0.75 for certain. What is left
is compared by bits that stand for the commonest shingles, which bounds the
similarity closely. No join lists the pairs of a large group. Links are
confirmed on full sets of 64-bit shingle hashes, with 100 * common >= 75 * all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.data import stored
from tidemark.llm.graph import components
from tidemark.llm.textbuf import NOT_SPACE, draws, find_words, freed, mix, ngrams, per_text, pieces, text_bytes

SHINGLE_WORDS = 5
CHUNKS, CHUNK_SIZE, CHUNK_ERRORS = 7, 5, 2
POSITIONS = CHUNKS * CHUNK_SIZE
MAX_DISTANCE = CHUNKS * (CHUNK_ERRORS + 1) - 1
#: Links need 100 * common >= PERCENT * all.
PERCENT = 75
#: Shingles of a group that get a bit, and members of a block.
BITS, BLOCK_MEMBERS = 256, 1024
#: Sizes of sets are banded by powers of this.
BAND = 1.02
#: Up to so many ids a filter of texts by id is broadcast; beyond, texts are shuffled.
BROADCAST_IDS = 2_000_000

_CHOICES = [
    [chunk * CHUNK_SIZE + p for p in kept]
    for chunk in range(CHUNKS)
    for kept in combinations(range(CHUNK_SIZE), CHUNK_SIZE - CHUNK_ERRORS)
]
_ODD = draws(POSITIONS, 71) | np.uint64(1)
_ADD = draws(POSITIONS, 72)


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and where each begins.

    A text with fewer words than a shingle has its whole sequence as one; a
    null or blank text has none.
    """
    data, offsets = text_bytes(column)
    words = find_words(data, offsets, NOT_SPACE)
    texts = len(offsets) - 1
    values, docs = ngrams(words, SHINGLE_WORDS)
    bounds = per_text(values, docs, texts)
    counts = np.diff(words.first)
    sets = []
    for i in range(texts):
        if counts[i] >= SHINGLE_WORDS:
            sets.append(np.unique(values[bounds[i] : bounds[i + 1]], sorted=True))
        elif counts[i]:
            a, b = words.first[i], words.first[i + 1]
            with np.errstate(over="ignore"):
                whole = (words.hash[a:b] * (draws(SHINGLE_WORDS, 5)[: b - a] | np.uint64(1))).sum(dtype=np.uint64)
            sets.append(mix(np.array([whole + np.uint64(b - a)], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), starts


def signatures(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """16 bits of the minimum under each hash function; zeros for empty sets."""
    out = np.zeros((len(starts) - 1, POSITIONS), np.uint16)
    filled = np.flatnonzero(np.diff(starts))
    if len(filled):
        with np.errstate(over="ignore"):
            for p in range(POSITIONS):
                least = np.minimum.reduceat(values * _ODD[p] + _ADD[p], starts[:-1][filled])
                out[filled, p] = (mix(least) >> np.uint64(48)).astype(np.uint16)
    return out


def set_hashes(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that tell sets apart."""
    total = np.zeros((2, len(values) + 1), np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(mix(values + np.uint64(1)), out=total[0, 1:])
        np.cumsum(mix(values ^ np.uint64(0x5851F42D4C957F2D)), out=total[1, 1:])
        h = total[:, starts[1:]] - total[:, starts[:-1]]
    return h[0].view(np.int64), h[1].view(np.int64)


def _fixed(rows: np.ndarray) -> pa.Array:
    """Equally long binary values, one per row."""
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        values, starts = shingles(piece.column("text"))
        h1, h2 = set_hashes(values, starts)
        yield pa.RecordBatch.from_arrays(
            [
                piece.column("id"),
                piece.column("text_hash"),
                pa.array(np.diff(starts), pa.int64()),
                pa.array(h1),
                pa.array(h2),
                _fixed(signatures(values, starts)),
            ],
            names=["id", "text_hash", "n_shingles", "h1", "h2", "signature"],
        )


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        values, starts = shingles(piece.column("text"))
        h1, h2 = set_hashes(values, starts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(h1), pa.array(h2), pa.array([values[a:b].tobytes() for a, b in zip(starts, starts[1:])], pa.binary())],
            names=["h1", "h2", "shingles"],
        )


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 5000):
            batch = whole.slice(at, 5000)
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16)
            values = values.reshape(-1, POSITIONS).astype(np.uint64)
            keys = np.empty((len(values), len(_CHOICES)), np.uint64)
            for k, choice in enumerate(_CHOICES):
                word = np.full(len(values), k, np.uint64)
                for p in choice:
                    word = (word << np.uint64(16)) | values[:, p]
                keys[:, k] = mix(word)
            node = np.repeat(batch.column("node").to_numpy(), len(_CHOICES))
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(node)], names=["key", "node"])


def _near_enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, POSITIONS)
            for c in ("signature_a", "signature_b")
        )
        kept = pa.array((a != b).sum(axis=1) <= MAX_DISTANCE)
        yield batch.select(["a", "b"]).filter(kept)


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for x, y in zip(batch.column("shingles_a"), batch.column("shingles_b")):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            if min(len(x), len(y)) * 100 < PERCENT * max(len(x), len(y)):
                kept.append(False)
                continue
            at = np.searchsorted(x, y)
            common = int((x[np.minimum(at, len(x) - 1)] == y).sum())
            kept.append(100 * common >= PERCENT * (len(x) + len(y) - common))
        yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of each class."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            some = batch.slice(at, 500)
            sets = some.column("shingles").to_pylist()
            sizes = [len(s) // 8 for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.frombuffer(b"".join(sets), np.int64)),
                    pa.array(np.repeat(some.column("node").to_numpy(), sizes)),
                    pa.array(np.repeat(some.column("component").to_numpy(), sizes)),
                ],
                names=["shingle", "node", "component"],
            )


def _close(table: pa.Table) -> pa.Table:
    """Pairs of the two blocks that the bits allow."""
    node, component, n, rest, block = (table.column(c).to_numpy() for c in ("node", "component", "n", "rest", "block"))
    words = [c for c in table.column_names if c.startswith("bits")]
    bits = np.stack([table.column(c).to_numpy() for c in words], axis=1).view(np.uint64)
    lo = block == table.column("lo")[0].as_py()
    hi = block == table.column("hi")[0].as_py()
    out: list[np.ndarray] = [np.zeros((0, 2), np.int64)]
    others = np.flatnonzero(hi)
    for x in np.flatnonzero(lo):
        common = np.bitwise_count(bits[others] & bits[x]).sum(axis=1) + np.minimum(rest[others], rest[x])
        fits = (100 + PERCENT) * common >= PERCENT * (n[others] + n[x])
        fits &= component[others] != component[x]
        found = node[others[fits]]
        out.append(np.stack([np.minimum(found, node[x]), np.maximum(found, node[x])], axis=1))
    pairs = np.unique(np.concatenate(out), axis=0)
    return pa.table({"a": pa.array(pairs[:, 0].copy()), "b": pa.array(pairs[:, 1].copy())})


class _Join:
    """The steps over one collection; all intermediate tables are written."""

    def __init__(self, docs: DataFrame):
        kind = docs.schema["id"].dataType.simpleString()
        self.docs = docs
        self.signed = stored(
            docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
                freed(_signed), f"id {kind}, text_hash long, n_shingles long, h1 long, h2 long, signature binary"
            )
        )
        filled = self.signed.filter("n_shingles > 0 AND id IS NOT NULL")
        classes = filled.groupBy("h1", "h2", "n_shingles").agg(
            F.min("id").alias("id"), F.first("signature").alias("signature")
        )
        self.classes = stored(classes.withColumn("node", F.monotonically_increasing_id()))

    def keys(self) -> DataFrame:
        return self.classes.select("node", "signature").mapInArrow(_keys, "key long, node long")

    def near(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose signatures are within the distance."""
        signature = self.classes.select("node", "signature")
        a = signature.toDF("a", "signature_a")
        b = signature.toDF("b", "signature_b")
        return pairs.join(a, "a").join(b, "b").mapInArrow(_near_enough, "a long, b long")

    def sets(self, nodes: DataFrame) -> DataFrame:
        """``node`` and ``shingles``, the sorted hashes, of the classes of ``nodes``."""
        wanted = self.classes.join(nodes, "node", "left_semi").select("node", "id", "h1", "h2")
        ids = wanted.select("id").distinct()
        ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
        texts = self.docs.join(ids, "id", "left_semi").select("text")
        full = texts.mapInArrow(freed(_full_sets), "h1 long, h2 long, shingles binary")
        # Rows of one id may differ in text; of equal sets one is enough.
        return full.join(wanted.select("node", "h1", "h2"), ["h1", "h2"]).dropDuplicates(["node"]).select("node", "shingles")

    def confirmed(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        a = sets.toDF("a", "shingles_a")
        b = sets.toDF("b", "shingles_b")
        return pairs.join(a, "a").join(b, "b").mapInArrow(_confirmed, "a long, b long")

    def star_links(self) -> DataFrame:
        """Confirmed links of each class with the centres of its keys."""
        keys = self.keys()
        centres = (
            keys.groupBy("key")
            .agg(F.min(F.struct(F.xxhash64("node").alias("order"), "node")).alias("centre"), F.count("*").alias("n"))
            .filter("n > 1")
            .select("key", F.col("centre.node").alias("a"))
        )
        pairs = keys.join(centres, "key").filter("a <> node").select("a", F.col("node").alias("b")).distinct()
        pairs = stored(self.near(pairs))
        touched = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        return stored(self.confirmed(pairs, stored(self.sets(touched))))

    def labels(self) -> DataFrame:
        """``node`` and ``component`` of the classes that have a link."""
        links = self.star_links()
        labels = components(links)
        keyed = self._labelled(self.keys(), labels)
        mixed = self._mixed(keyed).select("key")
        open_keys = stored(keyed.join(mixed, "key", "left_semi").select("key", "node"))
        sets = stored(self.sets(open_keys.select("node").distinct()))
        more = self.cross_links(open_keys, labels, sets)
        return labels if more is None or more.isEmpty() else components(links.unionAll(more))

    def _labelled(self, keyed: DataFrame, labels: DataFrame) -> DataFrame:
        own = F.coalesce("component", "node").alias("component")
        return keyed.join(labels, "node", "left").select("key", "node", own)

    def _mixed(self, keyed: DataFrame) -> DataFrame:
        """Keys that more than one component has."""
        ends = keyed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        return ends.filter("lo <> hi")

    def cross_links(self, open_keys: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame | None:
        """Confirmed links between components, of all pairs that share a key."""
        keyed = self._labelled(open_keys, labels)
        open_keys = stored(keyed.join(self._mixed(keyed).select("key"), "key", "left_semi"))
        left = open_keys.select("node", "component").distinct()
        band = F.floor(F.log(F.col("n_shingles")) / math.log(BAND)).cast("int")
        sized = self.classes.select("node", F.col("n_shingles").alias("n"), band.alias("band"))
        left = stored(left.join(sized, "node"))
        open_to = self.open_bands(left, sets)
        left = stored(left.join(open_to.select("node").distinct(), "node", "left_semi"))
        if left.isEmpty():
            return None
        left = left.join(self.groups(open_keys, left), "node")
        pairs = self.close_pairs(stored(left), sets)
        return stored(self.confirmed(stored(self.near(pairs)), sets))

    def groups(self, open_keys: DataFrame, left: DataFrame) -> DataFrame:
        """``node`` and ``group``: what hangs together over shared keys."""
        keyed = open_keys.select("key", "node").join(left.select("node"), "node", "left_semi")
        first = keyed.groupBy("key").agg(F.min("node").alias("a"))
        edges = keyed.join(first, "key").select("a", F.col("node").alias("b")).filter("a <> b").distinct()
        return components(edges).withColumnRenamed("component", "group")

    def close_pairs(self, left: DataFrame, sets: DataFrame) -> DataFrame:
        """Pairs of a group but of different components that may be linked.

        The shingles that most sets of a group have get a bit each. Two sets
        have as many of these in common as bits, and of other shared shingles
        no more than the one with fewer of them has. Members of a group are
        dealt to blocks of bounded size, and each pair of blocks is compared
        by bits in one task.
        """
        spread = left.join(sets, "node").select("node", "component", "shingles").mapInArrow(
            _spread, "shingle long, node long, component long"
        )
        spread = spread.join(left.select("node", "group"), "node")
        shared = spread.groupBy("group", "shingle").agg(
            F.count("*").alias("holders"), F.min("component").alias("lo"), F.max("component").alias("hi")
        )
        order = Window.partitionBy("group").orderBy(F.desc("holders"), "shingle")
        shared = shared.filter("lo <> hi").select("group", "shingle", "holders")
        top = shared.withColumn("bit", F.row_number().over(order) - 1).filter(f"bit < {BITS}").select("group", "shingle", "bit")
        words = [
            F.bit_or(F.when(F.floor(F.col("bit") / 64) == k, F.expr("shiftleft(1L, bit % 64)")).otherwise(0)).alias(f"bits{k}")
            for k in range(BITS // 64)
        ]
        members = (
            spread.join(shared.join(top, ["group", "shingle"], "left"), ["group", "shingle"])
            .groupBy("group", "node")
            .agg(F.sum(F.col("bit").isNull().cast("int")).alias("rest"), *words)
            .join(left.select("node", "component", "n"), "node")
        )
        members = stored(members)
        blocks = members.groupBy("group").agg(F.ceil(F.count("*") / BLOCK_MEMBERS).cast("int").alias("blocks"))
        dealt = members.join(blocks, "group").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        dealt = dealt.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
        return dealt.groupBy("group", "lo", "hi").applyInArrow(_close, "a long, b long")

    def open_bands(self, left: DataFrame, sets: DataFrame) -> DataFrame:
        """``node`` and ``other_band``: sizes of classes in other components
        which, by the shingles they have among them, a node may be linked with.

        Sets of n and m shingles are only linked if 175 * common >= 75 * (n + m).
        """
        spread = left.join(sets, "node").select("node", "component", "shingles").mapInArrow(
            _spread, "shingle long, node long, component long"
        )
        spread = spread.join(left.select("node", "n", "band"), "node")
        holders = spread.groupBy("shingle", F.col("band").alias("other_band")).agg(
            F.min("component").alias("lo"), F.max("component").alias("hi")
        )
        least = F.pow(F.lit(BAND), F.col("other_band")) * (1 - 1e-9)
        reach = math.ceil(math.log(100 / PERCENT) / math.log(BAND)) + 1
        shared = spread.join(holders, "shingle").filter(
            (F.abs(F.col("band") - F.col("other_band")) <= reach)
            & ((F.col("lo") != F.col("component")) | (F.col("hi") != F.col("component")))
        )
        counts = shared.groupBy("node", "n", "other_band").agg(F.count("*").alias("common"))
        return counts.filter((100 + PERCENT) * F.col("common") >= PERCENT * (F.col("n") + least)).select("node", "other_band")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Near-duplicate groups of whole texts.

    Returns one row per input row: ``id_column``, ``n_shingles``,
    ``component_id`` (the smallest id reachable over links) and ``kept`` (it is
    its own ``component_id``). Null, empty and blank texts have no shingles and
    link with nothing. Rows without an id have no ``component_id``, link with
    nothing and are kept. Rows of one id with different texts are documents of
    their own that share a name; repeated rows are all returned. Other columns
    of ``docs`` are not read.
    """
    out = _grouped(docs, id_column, text_column)
    return out.select(F.col("id").alias(id_column), "n_shingles", "component_id", "kept")


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, all columns.

    A row is told by its id and a hash of its text.
    """
    dropped = _grouped(docs, id_column, text_column).filter("NOT kept").select("id", "text_hash").distinct()
    dropped = stored(dropped)
    few = dropped.count() <= BROADCAST_IDS
    same = (docs[id_column] == dropped["id"]) & (F.xxhash64(docs[text_column].cast("string")) == dropped["text_hash"])
    return docs.join(F.broadcast(dropped) if few else dropped, same, "left_anti")


def _grouped(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    join = _Join(rows)
    labels = join.labels()
    classes = join.classes.join(labels, "node", "left").select(
        "h1", "h2", "n_shingles", "id", F.coalesce("component", "node").alias("component")
    )
    smallest = classes.groupBy("component").agg(F.min("id").alias("component_id"))
    named = classes.join(smallest, "component").select("h1", "h2", "n_shingles", "component_id")
    out = join.signed.select("id", "text_hash", "n_shingles", "h1", "h2").join(named, ["h1", "h2", "n_shingles"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(
        "id",
        "text_hash",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
