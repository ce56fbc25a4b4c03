"""The trie of conversation prefixes: one row per distinct beginning.

Turns are numbered and reduced to hashes; a prefix has the exclusive or of the
hashes of its turns, which hold their numbers. Grouping the prefixes gives the
nodes with their members. What is summed over subtrees comes from tables of
nodes: the distinct digests of a shard get the slots of a minimal perfect hash,
each slot keeps its digest, so that a digest that is not in the shard is told
apart, values are scattered into flat arrays, and sums run through an array of
parent slots, deepest nodes first.

A shard consists of whole subtrees. Nodes that more than ``room`` turns are at
or below are the top of the trie; every subtree under it has at most ``room``
nodes, and a task takes many, a bounded number at a time. What they pass on is
added up per parent before the top, whose size is checked, is summed as the
last shard. ``room`` grows with the corpus, so that the top has at most some
thousand nodes of each depth however many conversations there are.

No task holds all turns of a conversation or all members of a node: turns are
numbered within ranges and prefixes hashed within blocks of turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.data import stored
from tidemark.llm.textbuf import mix

#: Turns whose numbers share all but so many bits are hashed together.
BLOCK_BITS = 8
#: A subtree outside the top has at most so many turns, or this share of all.
LEAST_ROOM, ROOM_SHARE = 2_000, 10_000
#: Nodes of the top; if there are more, subtrees get more room.
TOP_NODES = 500_000
#: Rows of a shard, and ids of members that are written together.
SHARD_ROWS, CHUNK_IDS = 100_000, 4_096

_NODE = ["depth", "p1", "p2"]


def numbered(conversations: DataFrame) -> DataFrame:
    """Turns as ``conv_id``, ``pos`` from 1, hashes ``h1``, ``h2``, ``h3`` and ``bytes`` of the text.

    A conversation's turns stand in the order of ``turn`` (nulls first), then
    role and text. A null role or text is empty; repeated rows are turns of
    their own; rows without ``conv_id`` belong to no conversation. Other columns
    are not read.
    """
    rows = conversations.filter("conv_id IS NOT NULL").select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    # Ranges may cut a conversation; what sorts by the beginning of a text sorts by the text.
    ranges = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32))
    placed = stored(
        ranges.sortWithinPartitions("conv_id", "turn", "role", "text").select(
            "conv_id",
            F.monotonically_increasing_id().alias("at"),
            F.xxhash64("role", "text").alias("h1"),
            F.xxhash64(F.lit(1), "text", "role").alias("h2"),
            F.xxhash64(F.lit(2), F.length("role"), "role", "text").alias("h3"),
            F.octet_length("text").cast("long").alias("bytes"),
        )
    ).withColumn("range", F.shiftright("at", 33))
    parts = placed.groupBy("conv_id", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv_id", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("conv_id", "range").orderBy("at"))
    return (
        placed.withColumn("inside", inside)
        .join(parts, ["conv_id", "range"])
        .select("conv_id", (F.col("inside") + F.col("before")).alias("pos"), "h1", "h2", "h3", "bytes")
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and ids of conversations that begin with another one's turns.

    Conversation c gets the first h turns of conversation c - c % 5, h being the
    unsigned crc32 of the decimal c modulo 9, then its own turns after its first
    h. All ids stay, also those left without turns.
    """
    lengths = turns.groupBy("conv_id").agg(F.max("pos").alias("own"))
    other = lengths.select(F.col("conv_id").alias("base"), F.col("own").alias("others"))
    h = F.crc32(F.col("conv_id").cast("string")) % 9
    members = (
        lengths.select("conv_id", "own", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("base"))
        .join(other, "base", "left")
        .select("conv_id", "base", "own", "h", F.least("h", F.coalesce("others", F.lit(0))).alias("taken"))
    )
    members = stored(members)
    # A long conversation's turns meet its row in blocks.
    block = F.shiftright("pos", BLOCK_BITS)
    blocks = members.select(
        "conv_id", "h", "taken", F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright("own", BLOCK_BITS))).alias("block")
    )
    own = turns.withColumn("block", block).join(blocks, ["conv_id", "block"]).filter("pos > h")
    begun = members.filter("taken > 0").select(F.col("conv_id").alias("to"), F.col("base").alias("conv_id"), "taken")
    first = turns.filter("pos <= 8").join(begun, "conv_id").filter("pos <= taken")
    rest = ["h1", "h2", "h3", "bytes"]
    return own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), *rest).unionByName(
        first.select(F.col("to").alias("conv_id"), "pos", *rest)
    ), members.select("conv_id")


def prefixes(turns: DataFrame) -> DataFrame:
    """Each turn with the digest ``p1``, ``p2`` of the prefix it ends, that of the
    one before (``q1``, ``q2``), its ``depth``, and ``below``: turns from it on."""
    hashed = turns.select(
        "conv_id",
        F.col("pos").cast("long").alias("depth"),
        F.shiftright(F.col("pos").cast("long"), BLOCK_BITS).alias("block"),
        F.xxhash64("pos", "h1", "h2").alias("x1"),
        F.xxhash64("h2", "pos", "h1").alias("x2"),
        "h3",
        "bytes",
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    blocks = hashed.groupBy("conv_id", "block").agg(
        F.bit_xor("x1").alias("b1"), F.bit_xor("x2").alias("b2"), F.max("depth").alias("to")
    )
    whole = Window.partitionBy("conv_id")
    before = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "conv_id",
        "block",
        F.coalesce(F.bit_xor("b1").over(before), F.lit(0)).alias("b1"),
        F.coalesce(F.bit_xor("b2").over(before), F.lit(0)).alias("b2"),
        F.max("to").over(whole).alias("length"),
    )
    running = hashed.select("*", F.bit_xor("x1").over(inside).alias("r1"), F.bit_xor("x2").over(inside).alias("r2"))
    p1, p2 = (F.col(r).bitwiseXOR(F.col(b)) for r, b in (("r1", "b1"), ("r2", "b2")))
    return running.join(blocks, ["conv_id", "block"]).select(
        "conv_id",
        "depth",
        p1.alias("p1"),
        p2.alias("p2"),
        p1.bitwiseXOR(F.col("x1")).alias("q1"),
        p2.bitwiseXOR(F.col("x2")).alias("q2"),
        "h3",
        "bytes",
        (F.col("length") - F.col("depth") + 1).alias("below"),
    )


class NodeTable:
    """Slots 0 to n - 1 for n distinct digests, by levels of bit arrays.

    On each level the digests that are alone in their place take it; the others
    go on to the next. A slot is the number of taken places before one's own.
    """

    def __init__(self, depth: np.ndarray, p1: np.ndarray, p2: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # places taken; taken before them
        n = len(depth)
        self.depth, self.p1, self.p2 = (np.zeros(n, np.int64) for _ in range(3))
        left, taken = np.arange(n), 0
        while len(left):
            size = 2 * len(left) + 1
            place = self._place(len(self.levels), size, depth[left], p1[left], p2[left])
            alone = np.bincount(place, minlength=size) == 1
            self.levels.append((alone, taken + np.cumsum(alone) - alone))
            here = alone[place]
            slot = self.levels[-1][1][place[here]]
            for kept, given in ((self.depth, depth), (self.p1, p1), (self.p2, p2)):
                kept[slot] = given[left[here]]
            taken += int(here.sum())
            left = left[~here]
            if len(self.levels) > 200:
                raise ValueError("a digest is in the shard more than once")

    @staticmethod
    def _place(level: int, size: int, depth: np.ndarray, p1: np.ndarray, p2: np.ndarray) -> np.ndarray:
        key = p1.astype(np.uint64) ^ mix(p2.astype(np.uint64) + depth.astype(np.uint64) + np.uint64(level))
        return (mix(key + np.uint64(level)) % np.uint64(size)).astype(np.int64)

    def find(self, depth: np.ndarray, p1: np.ndarray, p2: np.ndarray) -> np.ndarray:
        """Slots of digests; -1 where a slot keeps another one."""
        out = np.full(len(depth), -1, np.int64)
        left = np.arange(len(depth))
        for level, (alone, before) in enumerate(self.levels):
            place = self._place(level, len(alone), depth[left], p1[left], p2[left])
            here = alone[place]
            out[left[here]] = before[place[here]]
            left = left[~here]
        known = np.flatnonzero(out >= 0)
        slot = out[known]
        other = (self.depth[slot] != depth[known]) | (self.p1[slot] != p1[known]) | (self.p2[slot] != p2[known])
        out[known[other]] = -1
        return out


_NUMBERS = [*_NODE, "q1", "q2", "conv_id", "n_convs", "bytes", "n_children", "n_leaves", "saved_tokens"]
_SUMMED = "depth long, p1 long, p2 long, q1 long, q2 long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def _sum_up(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
    """A shard's nodes with what their subtrees sum up to.

    ``n_children``, ``n_leaves`` and ``saved_tokens`` come in as what other
    shards pass on. A node whose parent is not in the shard has no
    ``parent_conv_id``.
    """
    table = NodeTable(rows["depth"], rows["p1"], rows["p2"])
    slot = table.find(rows["depth"], rows["p1"], rows["p2"])
    flat = {}
    for name in _NUMBERS:
        flat[name] = np.zeros(len(slot), np.int64)
        flat[name][slot] = rows[name]
    parent = table.find(flat["depth"] - 1, flat["q1"], flat["q2"])
    parent[flat["depth"] == 0] = -1
    children, leaves, saved = flat["n_children"], flat["n_leaves"], flat["saved_tokens"]
    np.add.at(children, parent[parent >= 0], 1)
    leaves += children == 0
    saved += (flat["n_convs"] - 1) * flat["bytes"]
    order = np.argsort(-flat["depth"], kind="stable")
    for some in np.split(order, np.flatnonzero(np.diff(flat["depth"][order])) + 1):
        some = some[parent[some] >= 0]
        np.add.at(leaves, parent[some], leaves[some])
        np.add.at(saved, parent[some], saved[some])
    flat["parent_conv_id"] = flat["conv_id"][np.maximum(parent, 0)]
    names = [f.split()[0] for f in _SUMMED.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(flat[n], pa.int64(), mask=(parent < 0) if n == "parent_conv_id" else None) for n in names], names=names
    )


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards of whole subtrees from rows sorted by the top of their subtree."""
    kept: list[pa.RecordBatch] = []

    def out(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts)
        return _sum_up({n: rows.column(n).to_numpy().astype(np.int64) for n in _NUMBERS})

    for batch in batches:
        if not batch.num_rows:
            continue
        tops = [batch.column(n).to_numpy() for n in ("t1", "t2")]
        begins = np.flatnonzero((np.diff(tops[0]) != 0) | (np.diff(tops[1]) != 0)) + 1
        if kept:
            last = [kept[-1].column(n)[-1].as_py() for n in ("t1", "t2")]
            if last != [int(t[0]) for t in tops]:
                begins = np.concatenate([[0], begins])
        if len(begins) and sum(b.num_rows for b in kept) + batch.num_rows >= SHARD_ROWS:
            cut = int(begins[-1])
            parts = [*kept, *([batch.slice(0, cut)] if cut else [])]
            if parts:
                yield out(parts)
            kept = [batch.slice(cut)]
        else:
            kept.append(batch)
    if kept:
        yield out(kept)


def _ends(rows: DataFrame) -> DataFrame:
    """SHA-256 of the comma-joined ids of each node's rows, in numeric order.

    Ids are joined in ranges first; a hash can only be fed in order, so a node's
    pieces of some thousand ids each then pass one task, a piece at a time.
    """

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            node = np.stack([batch.column(n).to_numpy() for n in _NODE])
            ids = batch.column("conv_id")
            begins = np.concatenate([[0], np.flatnonzero((np.diff(node) != 0).any(0)) + 1])
            cuts = np.union1d(begins, np.arange(0, batch.num_rows, CHUNK_IDS))
            lists = pa.ListArray.from_arrays(pa.array(np.append(cuts, batch.num_rows), pa.int32()), pc.cast(ids, pa.string()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n).take(pa.array(cuts)) for n in _NODE), ids.take(pa.array(cuts)), pc.binary_join(lists, ",")],
                names=[*_NODE, "first", "joined"],
            )

    def feed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done = []
            columns = [batch.column(n).to_pylist() for n in (*_NODE, "joined")]
            for *key, joined in zip(*columns):
                if key == node:
                    digest.update(b"," + joined.encode())
                    continue
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(joined.encode())
            yield _rows(done)
        if node is not None:
            yield _rows([(*node, digest.hexdigest())])

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done)) or [[]] * 4
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[*_NODE, "ends_sha256"])

    shape = "depth long, p1 long, p2 long"
    joined = (
        rows.select(*_NODE, F.col("conv_id").cast("long").alias("conv_id"))
        .repartitionByRange(*_NODE, "conv_id")
        .sortWithinPartitions(*_NODE, "conv_id")
        .mapInArrow(join_ids, f"{shape}, first long, joined string")
    )
    return (
        joined.repartition(*_NODE).sortWithinPartitions(*_NODE, "first").mapInArrow(feed, f"{shape}, ends_sha256 string")
    )


def prefix_trie(turns: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """Nodes of the trie of all conversations, the root included.

    ``turns`` as ``numbered`` gives them; ``members``: ``conv_id`` of all
    conversations, if some have no turns. Ids are integers. Returns per node
    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the
    root), ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes of the
    subtree), ``saved_tokens`` (over the subtree, bytes of each node's last text
    for every member but one), ``ends_sha256`` (of the ids of members that end
    there) and the digest ``p1``, ``p2``. Without any conversation there is no
    node. Prefixes are told apart by 128 bits; that all members of a node have
    the same parent and the same last turn is checked by a further hash, and a
    difference raises an error.
    """
    turns = turns.withColumn("conv_id", F.col("conv_id").cast("long"))
    rows = stored(prefixes(turns))
    ids = (turns if members is None else members).select(F.col("conv_id").cast("long").alias("conv_id"))
    ids = ids.filter("conv_id IS NOT NULL").distinct()
    lengths = ids.join(rows.filter("below = 1").select("conv_id", *_NODE), "conv_id", "left")
    ends = _ends(lengths.fillna(0, _NODE))
    root = ids.select(
        "conv_id",
        *(F.lit(0).cast("long").alias(n) for n in (*_NODE, "q1", "q2", "h3", "bytes")),
        F.lit(0).cast("long").alias("below"),
    )
    same = ["q1", "q2", "h3", "bytes"]
    nodes = (
        rows.unionByName(root)
        .groupBy(*_NODE)
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.count("*").alias("n_convs"),
            F.sum("below").alias("below"),
            *(F.min(n).alias(n) for n in same),
            F.max(F.struct(*same)).alias("other"),
        )
    )
    equal = F.struct(*same) == F.col("other")
    nodes = nodes.select(
        *_NODE,
        F.when(equal, F.col("conv_id")).otherwise(F.raise_error(F.lit("two prefixes have one digest"))).alias("conv_id"),
        *["n_convs", "below", "q1", "q2", "bytes"],
        *(F.lit(0).cast("long").alias(n) for n in ("n_children", "n_leaves", "saved_tokens")),
    )
    nodes = stored(nodes.withColumn("below", F.when(F.col("depth") == 0, F.lit(None)).otherwise(F.col("below"))))
    room = max(LEAST_ROOM, (nodes.filter("depth = 1").agg(F.sum("below")).first()[0] or 0) // ROOM_SHARE)
    while (top_size := nodes.filter(_top(room)).count()) > TOP_NODES:
        room *= 4
    del top_size
    # The first node of each conversation that is not in the top is the top of its subtree.
    top = F.broadcast(nodes.filter(_top(room)).select(*_NODE, F.lit(True).alias("in_top")))
    under = (
        rows.join(top, _NODE, "left")
        .filter("in_top IS NULL")
        .groupBy("conv_id")
        .agg(F.min(F.struct("depth", "p1", "p2")).alias("t"), F.max("depth").alias("to"))
        .select(
            "conv_id",
            F.col("t.p1").alias("t1"),
            F.col("t.p2").alias("t2"),
            F.explode(F.sequence(F.shiftright("t.depth", BLOCK_BITS), F.shiftright("to", BLOCK_BITS))).alias("block"),
        )
    )
    light = nodes.filter(~_top(room)).withColumn("block", F.shiftright("depth", BLOCK_BITS)).join(under, ["conv_id", "block"])
    light = (
        light.select("t1", "t2", *_NUMBERS)
        .repartition("t1", "t2")
        .sortWithinPartitions("t1", "t2")
        .mapInArrow(_shards, _SUMMED)
    )
    light = stored(light)
    passed_on = (
        light.filter("parent_conv_id IS NULL")
        .groupBy(F.col("q1").alias("p1"), F.col("q2").alias("p2"), (F.col("depth") - 1).alias("depth"))
        .agg(F.count("*").alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
    )
    heavy = nodes.filter(_top(room)).join(passed_on, _NODE, "left")
    given = {"n_children": "c", "n_leaves": "l", "saved_tokens": "s"}
    heavy = heavy.select(
        *(F.coalesce(given[n], F.lit(0)).cast("long").alias(n) if n in given else F.col(n) for n in _NUMBERS),
        *(F.lit(0).cast("long").alias(t) for t in ("t1", "t2")),
    )
    heavy = stored(heavy.coalesce(1).mapInArrow(_shards, _SUMMED))
    parents = F.broadcast(
        heavy.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("above"))
    )
    light = light.join(parents, ["q1", "q2"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    out = heavy.unionByName(light.drop("above")).join(ends, _NODE, "left")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        "p1",
        "p2",
    )


def _top(room: int):
    return F.col("below").isNull() | (F.col("below") > room)


ORACLE = """
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base, count(*) AS own,
           xor(list_reduce(
               list_prepend(CAST(4294967295 AS BIGINT),
                            list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
               lambda crc, byte: list_reduce(
                   [xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda x, bit: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 9 AS h
    FROM turns GROUP BY conv_id
), members AS (
    SELECT c.conv_id, c.base, c.h, least(c.h, coalesce(b.own, 0)) AS taken
    FROM convs c LEFT JOIN convs b ON b.conv_id = c.base
), rebuilt AS (
    SELECT m.conv_id, t.pos - m.h + m.taken AS pos, t.role, t.text FROM members m JOIN turns t USING (conv_id) WHERE t.pos > m.h
    UNION ALL
    SELECT m.conv_id, t.pos, t.role, t.text FROM members m JOIN turns t ON t.conv_id = m.base WHERE t.pos <= m.taken
), hashed AS (
    SELECT conv_id, pos, octet_length(encode(text)) AS bytes, sha256(length(role) || ':' || role || text) AS said FROM rebuilt
), paths AS (
    SELECT conv_id, pos AS depth, bytes, sha256(string_agg(said, '') OVER w) AS path,
           sha256(string_agg(said, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS parent,
           pos = max(pos) OVER (PARTITION BY conv_id) AS last
    FROM hashed WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
    UNION ALL
    SELECT conv_id, 0, 0, '', NULL, conv_id NOT IN (SELECT conv_id FROM rebuilt) FROM members
), nodes AS (
    SELECT depth, path, any_value(coalesce(parent, '')) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
           (count(*) - 1) * any_value(bytes) AS saved,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256
    FROM paths GROUP BY depth, path
), children AS (
    SELECT depth - 1 AS depth, parent AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), below AS (  -- each node beside those on the way to it, itself included, as its smallest member has them
    SELECT a.depth, a.path, sum(n.saved) AS saved_tokens, count(*) FILTER (WHERE c.n_children IS NULL) AS n_leaves
    FROM nodes n JOIN paths a ON a.conv_id = n.conv_id AND a.depth <= n.depth
    LEFT JOIN children c ON c.depth = n.depth AND c.path = n.path
    GROUP BY a.depth, a.path
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, b.n_leaves,
       b.saved_tokens, n.ends_sha256
FROM nodes n JOIN below b USING (depth, path) LEFT JOIN children c USING (depth, path)
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.parent
"""
