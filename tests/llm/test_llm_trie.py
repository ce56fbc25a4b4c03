import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import ODD_TEXTS, frame

from tidemark.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, p1 string"


def rebuilt(rows):
    """Conversations as lists of (role, text), rebuilt in the way of the query."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def plain_trie(conversations):
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved, out = {}, {}, []
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[p] for p in children[path]) or 1
        size = len(path[-1][1].encode()) if path else 0
        saved[path] = (len(members[path]) - 1) * size + sum(saved[p] for p in children[path])
        ends = ",".join(map(str, sorted(c for c in members[path] if len(conversations[c]) == len(path))))
        parent = min(members[path[:-1]]) if path else None
        out.append(
            (min(members[path]), len(path), parent, len(members[path]), len(children[path]), leaves[path], saved[path])
            + (hashlib.sha256(ends.encode()).hexdigest(),)
        )
    return sorted(out, key=repr)


def run(spark, rows):
    turns, members = trie.rebuilt(trie.numbered(frame(spark, rows, SCHEMA)))
    return sorted((tuple(r)[:8] for r in trie.prefix_trie(turns, members).collect()), key=repr)


def conversations(seed, convs, longest, words):
    random.seed(seed)
    rows = []
    for c in range(convs):
        for turn in range(random.randint(0, longest)):
            rows.append((c, turn, random.choice(["user", "assistant"]), random.choice(words)))
    return rows


def test_odd_rows(spark):
    rows = [(c, t, r, x) for c, t, r, x in zip([0, 1, 2, 3, 4, 5] * 2, [0, None, 2] * 4, [None, "user"] * 6, ODD_TEXTS)]
    rows += [(7, None, "a", "x"), (7, 1, "b", "y"), (7, 1, "b", "y"), (7, 1, "a", "y"), (None, 1, "user", "no id")]
    rows += [(-3, 1, "u", "minus"), (-5, 0, "u", "x"), (-5, 1, "u", "x"), (11, 0, "user", "long " * 50_000)]
    assert run(spark, rows) == plain_trie(rebuilt(rows))
    assert run(spark, []) == []


@pytest.mark.parametrize("room, shard", [(2_000, 100_000), (20, 30), (0, 1)])
def test_equal_to_brute_force_whatever_the_shards(spark, monkeypatch, room, shard):
    monkeypatch.setattr(trie, "LEAST_ROOM", room)
    monkeypatch.setattr(trie, "ROOM_SHARE", 10**9)
    monkeypatch.setattr(trie, "SHARD_ROWS", shard)
    rows = conversations(1, 300, 9, ["a", "b", "é"])
    rows += [(1000 + c, t, "user", "same") for c in range(100) for t in range(6)]  # a large group of copies
    rows += [(5000, t, "user", f"turn {t % 3}") for t in range(600)] + [(5005, t, "user", f"turn {t % 3}") for t in range(500)]
    assert run(spark, rows) == plain_trie(rebuilt(rows))


def test_top_that_is_too_large_gives_subtrees_more_room(spark, monkeypatch):
    monkeypatch.setattr(trie, "LEAST_ROOM", 1)
    monkeypatch.setattr(trie, "TOP_NODES", 3)
    rows = conversations(2, 60, 6, ["a", "b"])
    assert run(spark, rows) == plain_trie(rebuilt(rows))


def test_ids_of_a_large_node_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_IDS", 7)
    rows = [(c, 0, "user", "same") for c in range(500)]
    assert run(spark, rows) == plain_trie(rebuilt(rows))


def test_without_rebuilding(spark):
    rows = conversations(3, 40, 5, ["a", "b"])
    own = defaultdict(list)
    for c, _, role, text in rows:
        own[c].append((role, text))
    got = trie.prefix_trie(trie.numbered(frame(spark, rows, SCHEMA))).collect()
    assert sorted((tuple(r)[:8] for r in got), key=repr) == plain_trie(own)


def test_slots_are_minimal_and_strangers_are_told_apart():
    random.seed(4)
    values = np.array(random.sample(range(-(10**15), 10**15), 30_000), np.int64)
    depth, p1, p2 = values[:10_000] % 7, values[:10_000], values[10_000:20_000]
    table = trie.NodeTable(depth, p1, p2)
    assert sorted(table.find(depth, p1, p2).tolist()) == list(range(10_000))
    assert (table.find(depth, p1, values[20_000:]) == -1).all()
    assert (table.find(depth + 1, p1, p2) == -1).all()
    assert trie.NodeTable(depth[:0], p1[:0], p2[:0]).find(depth, p1, p2).max() == -1
    with pytest.raises(ValueError):
        trie.NodeTable(np.array([1, 1]), np.array([2, 2]), np.array([3, 3]))


def test_one_digest_for_two_prefixes_is_an_error(spark):
    rows = trie.numbered(frame(spark, [(1, 0, "user", "a"), (2, 0, "user", "b")], SCHEMA))
    from pyspark.sql import functions as F

    with pytest.raises(Exception, match="two prefixes have one digest"):
        trie.prefix_trie(rows.withColumn("h1", F.lit(5).cast("long")).withColumn("h2", F.lit(6).cast("long"))).collect()


def test_query_equals_brute_force(spark):
    from tidemark.llm.queries import op11_prefix_trie

    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in op11_prefix_trie(spark, path).collect()), key=repr) == plain_trie(rebuilt(rows))
