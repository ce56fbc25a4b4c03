import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from helpers import ODD_TEXTS, SPACED, frame, words

from tidemark.llm import neardup


def shingle_set(text):
    w = words(text, SPACED)
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))


def expected(rows):
    """Brute force over all pairs of rows with an id."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
            continue
        common = len(sets[a] & sets[b])
        if 100 * common >= 75 * len(sets[a] | sets[b]):
            parent[find(a)] = find(b)
    out = []
    for k, (i, _) in enumerate(rows):
        members = [rows[m][0] for m in range(len(rows)) if find(m) == find(k)]
        component = None if i is None else min(members)
        out.append((i, len(sets[k]), component, i is None or i == component))
    return sorted(map(repr, out))


def edited(base, share, vocabulary, rng):
    return " ".join(rng.choice(vocabulary) if rng.random() < share else w for w in base)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(400)]
    out = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    number = 100
    for size, copies in ((60, 60), (200, 25), (12, 10), (6, 5), (1000, 6)):
        base = [rng.choice(vocabulary) for _ in range(size)]
        for _ in range(copies):
            out.append((number, edited(base, rng.choice([0, 0.005, 0.01, 0.02, 0.03, 0.05, 0.08]), vocabulary, rng)))
            number += 1
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    out += [(number + k, " ".join([passage, *rng.choices(vocabulary, k=rng.randint(5, 200))])) for k in range(40)]
    # Cut step by step, so that neighbours are linked but the ends are not.
    chain = rng.choices(vocabulary, k=120)
    out += [(number + 100 + k, " ".join(chain[k * 8 : k * 8 + 80])) for k in range(6)]
    # Without an id; twice the same; one id with two texts.
    out += [(None, out[20][1]), out[20], (999, "a b c d e f g"), (999, "h i j k l m n o")]
    rng.shuffle(out)
    return out


def test_groups_are_those_of_brute_force(spark, rows):
    got = neardup.near_duplicates(frame(spark, rows)).collect()
    assert sorted(map(repr, map(tuple, got))) == expected(rows)


def test_small_blocks_and_few_bits_change_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", 7)
    monkeypatch.setattr(neardup, "BITS", 64)
    monkeypatch.setattr(neardup, "BROADCAST_IDS", 0)
    got = neardup.near_duplicates(frame(spark, rows)).collect()
    assert sorted(map(repr, map(tuple, got))) == expected(rows)


def test_rows_that_are_dropped(spark, rows):
    kept = neardup.drop_near_duplicates(frame(spark, rows)).collect()
    want = [r for r in expected(rows) if r.endswith("True)")]
    assert len(kept) == len(want)
    assert kept[0].asDict().keys() == {"doc_id", "text", "id", "label"}


def test_every_pair_within_the_distance_shares_a_key():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 16, (2000, neardup.POSITIONS), dtype=np.uint16)
    b = a.copy()
    for row in b:
        at = rng.choice(neardup.POSITIONS, neardup.MAX_DISTANCE, replace=False)
        row[at] += 1
    keys = []
    for rows in (a, b):
        batch = pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(rows))), pa.array([r.tobytes() for r in rows], pa.binary())], names=["node", "signature"]
        )
        out = pa.Table.from_batches(neardup._keys([batch])).column("key").to_numpy().reshape(len(rows), -1)
        keys.append(out)
    assert all(set(x) & set(y) for x, y in zip(*keys))


def test_no_rows(spark):
    assert neardup.near_duplicates(frame(spark, [])).collect() == []
    alone = neardup.near_duplicates(frame(spark, [(5, "just one text of some words")])).collect()
    assert [tuple(r) for r in alone] == [(5, 2, 5, True)]


def test_components_of_paths_stars_and_rings(spark):
    from tidemark.llm.graph import components

    rng = random.Random(1)
    names = rng.sample(range(10_000), 400)
    edges = [(names[k], names[k + 1]) for k in range(150)] + [(names[200], names[k]) for k in range(201, 260)]
    edges += [(names[260 + k], names[260 + (k + 1) % 40]) for k in range(40)] + [(7, 7), (None, 3), (names[0], names[1])]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {}
    for group in (names[:151], names[200:260], names[260:300], [7]):
        for n in group:
            want[n] = min([*group])
    assert {n: c for n, c in got.items() if n != 7 or 7 in want} == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
