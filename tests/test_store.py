"""Batches, replaced keys, merging."""

from __future__ import annotations

import random

import pytest
from conftest import rows

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import store as S
from tidemark.sources.store import Batch, Table, TableStore, to_merge

PAIRS = Table(
    "pairs",
    T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())]),
    "k",
    sort=("k", "v"),
    parts={"sums": T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType())])},
    keyed=("rows", "sums"),
    reduce={"sums": lambda df: df.groupBy("k").agg(F.sum("n").alias("n"))},
)


def add(store, data, replaced=()):
    batch = store.new_batch(PAIRS)
    written = store.write(PAIRS, store.spark.createDataFrame(data, PAIRS.schema), batch)
    store.write(PAIRS, written.groupBy("k").agg(F.count("*").alias("n")), batch, "sums")
    if replaced:
        store.write_replaced(store.spark.createDataFrame([(k,) for k in replaced], "k string"), batch)
    store.publish(batch)
    return batch


def sums(store):
    return rows(store.read(PAIRS, "sums").groupBy("k").agg(F.sum("n")))


@pytest.mark.parametrize("seed", range(2))
def test_replaced_keys_and_merges_agree_with_brute_force(spark, tmp_path, seed):
    rng = random.Random(seed)
    store, want = TableStore(spark, str(tmp_path)), []
    for step in range(9):
        data = [(rng.choice("ABCDE"), rng.randint(0, 99)) for _ in range(rng.randint(0, 6))]
        gone = rng.sample("ABCDE", rng.choice([0, 0, 1, 2]))
        add(store, data, gone)
        want = [r for r in want if r[0] not in gone] + data
        batches = store.batches(PAIRS)
        if rng.random() < 0.5 and len(batches) > 1:
            store.merge_newest(PAIRS, rng.randint(2, len(batches)))
        assert rows(store.read(PAIRS)) == sorted(want, key=repr)
        counted = {k: sum(r[0] == k for r in want) for k, _ in want}
        assert sums(store) == sorted(counted.items())


def test_an_unpublished_merge_counts_for_nothing_and_is_made_anew(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    first, second = add(store, [("A", 1)]), add(store, [("B", 2)], ["A"])
    half = Batch(first.generation, 1, 2)
    store.write(PAIRS, store.read_batches(PAIRS, [first]), half)
    assert store.batches(PAIRS) == [first, second] and rows(store.read(PAIRS)) == [("B", 2)]
    assert store.merge_newest(PAIRS, 2) == half
    assert store.batches(PAIRS) == [half] and rows(store.read(PAIRS)) == [("B", 2)]
    third = add(store, [("A", 3)])
    assert third.last == 3 and rows(store.read(PAIRS)) == [("A", 3), ("B", 2)]


def test_a_batch_alone_is_left_as_it_is(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    only = add(store, [("A", 1)])
    assert store.merge_newest(PAIRS, 1) == only and store.merge_newest(PAIRS, 5) == only
    assert store.merge(PAIRS) is None and rows(store.read(PAIRS)) == [("A", 1)]


def test_frames_stay_valid_through_the_next_merge(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    add(store, [("A", 1)])
    add(store, [("B", 2)])
    early = store.read(PAIRS)
    store.merge_newest(PAIRS, 2)
    assert rows(early) == [("A", 1), ("B", 2)]
    assert store.replaced(store.batches(PAIRS)).isEmpty()


def grow(sizes):
    """Batches after each arrival, and how many bytes were copied in all."""
    have, most, copied = [], 0, 0
    for size in sizes:
        have.append(size)
        n = to_merge(have)
        if n:
            copied += sum(have[-n:])
            have[-n:] = [sum(have[-n:])]
        most = max(most, len(have))
    return have, most, copied


def test_batches_of_like_size_are_merged():
    assert to_merge([]) == 0 and to_merge([1]) == 0
    unit = S.LIKE_BYTES
    have, most, copied = grow([unit] * 1000)
    assert sum(have) == 1000 * unit and most <= 16
    assert copied <= 6 * 1000 * unit  # a row is copied once a level
    # A large first load is not copied for small increments.
    have, _, copied = grow([10_000 * unit] + [unit] * 500)
    assert have[0] == 10_000 * unit and copied <= 6 * 500 * unit
    have, most, _ = grow([1] * 64)  # small ones count as alike
    assert len(have) <= 4 and most <= 4
    rng = random.Random(1)
    _, most, _ = grow([rng.choice([1, unit, 20 * unit, 300 * unit]) for _ in range(2000)])
    assert most <= 40
