import random

import pyarrow as pa
import pytest
from helpers import ODD_TEXTS, frame, words

from tidemark.llm import decontaminate
from tidemark.llm.data import table
from tidemark.llm.textbuf import ALNUM, find_words, text_bytes

SF = "/root/testdata/sf0.001"


def least_edits(item, text):
    """Edit distance to the best stretch, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (w != x)))
        row = new
    return min(row)


def test_occurrences_in_the_test_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    got = decontaminate.find_items(table(spark, SF, "documents"), table(spark, SF, "benchmark")).collect()
    want = set()
    for d, text in docs:
        own = words(text)
        have = {tuple(own[k : k + 2]) for k in range(len(own))}
        for i, item in items:
            w = words(item)
            pairs = [tuple(w[k : k + 2]) in have for k in range(len(w) - 1)]
            if sum(pairs) >= len(w) // 4:  # else there are too many edits
                edits = least_edits(w, own)
                if edits <= len(w) // 4:
                    want.add((d, i, edits))
    assert {(r["doc_id"], r["item_id"], r["edits"]) for r in got} == want and want


def edit(item, edits, vocabulary, rng):
    out = list(item)
    for _ in range(edits):
        at, kind = rng.randrange(len(out)), rng.random()
        if kind < 0.5:
            out[at] = rng.choice(vocabulary)
        elif kind < 0.75:
            out.insert(at, rng.choice(vocabulary))
        else:
            del out[at]
    return out


def test_edited_items_are_found(spark):
    rng = random.Random(3)
    vocabulary = [f"v{k}" for k in range(300)] + ["the", "of"] * 60
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(10, 90)))) for k in range(150)]
    for share, least in ((0, 1.0), (0.1, 0.97), (0.2, 0.9)):
        docs, want = [], set()
        for k, text in items:
            item = words(text)
            found = edit(item, int(share * len(item)), vocabulary, rng)
            docs.append((k, " ".join([*rng.choices(vocabulary, k=50), *found, *rng.choices(vocabulary, k=30)]).upper()))
            if least_edits(item, words(docs[-1][1])) <= len(item) // 4:
                want.add((k, k))
        got = decontaminate.find_items(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
        got = {(r["doc_id"], r["item_id"]) for r in got.collect()}
        assert len(got & want) >= least * len(want)
        assert got <= {(d, i) for d, t in docs for i, x in items if least_edits(words(x), words(t)) <= len(words(x)) // 4}


@pytest.mark.parametrize("length", [8, 9, 16, 17, 18, 32, 33, 34, 37, 64, 66, 128, 256])
@pytest.mark.parametrize("share", [0.1, 0.2, 0.25])
def test_recall_at_each_length_and_edit_share(length, share):
    rng = random.Random(4)
    vocabulary = [f"v{k}" for k in range(3000)] + ["the", "of"] * 60
    items = [(i, rng.choices(vocabulary, k=length)) for i in range(60)]
    index = decontaminate.ItemIndex([(i, " ".join(w)) for i, w in items])
    docs = [
        " ".join([*rng.choices(vocabulary, k=rng.randrange(40)), *edit(w, int(share * length), vocabulary, rng), *rng.choices(vocabulary, k=20)])
        for _, w in items * 4
    ]
    data, offsets = text_bytes(pa.array(docs))
    found = {(t, i) for t, i, *_ in index.occurrences(find_words(data, offsets, ALNUM))}
    assert sum((k, k % 60) in found for k in range(240)) >= 0.96 * 240


def test_unchanged_items_are_found_at_every_place():
    rng = random.Random(8)
    vocabulary = [f"v{k}" for k in range(3000)] + ["the", "of"] * 60
    lengths = [*range(1, 20), 31, 32, 33, 34, 47, 63, 64, 65, 66, 90, 127, 128, 129, 130, 200]
    items = [(n, " ".join(rng.choices(vocabulary, k=n))) for n in lengths]
    index = decontaminate.ItemIndex(items)
    for before in range(17):
        docs = [" ".join([*rng.choices(vocabulary, k=before), text, *rng.choices(vocabulary, k=9)]) for _, text in items]
        data, offsets = text_bytes(pa.array(docs))
        found = {(t, i) for t, i, edits, _ in index.occurrences(find_words(data, offsets, ALNUM)) if edits == 0}
        assert {(k, k) for k in range(len(items))} <= found


def test_odd_rows(spark):
    items = [(1, None), (2, ""), (3, "one two three"), (4, "word " * 3000), (5, "one two three")]
    items = spark.createDataFrame(items, "item_id int, text string")
    docs = [*enumerate(ODD_TEXTS), (None, "zero One, two; THREE four"), (90, "one two or three"), (91, "word " * 3100)]
    got = decontaminate.find_items(frame(spark, docs), items).collect()
    found = {(r["doc_id"], r["item_id"], r["edits"], r["first_word"]) for r in got}
    assert found == {(10, 3, 0, 0), (11, 3, 0, 0), (10, 5, 0, 0), (11, 5, 0, 0), (None, 3, 0, 1), (None, 5, 0, 1), (91, 4, 0, 0)}
    kept = decontaminate.drop_contaminated(frame(spark, docs), items)
    assert kept.columns == ["doc_id", "text", "id", "label"]
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(10), 90]
    assert decontaminate.find_items(frame(spark, []), items).collect() == []
    assert decontaminate.find_items(frame(spark, docs), items.limit(0)).collect() == []


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    whole = sorted(map(tuple, decontaminate.find_items(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 300)
    assert sorted(map(tuple, decontaminate.find_items(docs, items).collect())) == whole


def test_one_block_is_held_at_a_time(spark, monkeypatch):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    kept = sorted(r["doc_id"] for r in decontaminate.drop_contaminated(docs, items).collect())
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 1500)
    found, rest = decontaminate.find_items(docs, items), decontaminate.drop_contaminated(docs, items)
    for frame_ in (found, rest):
        assert frame_._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert sorted(r["doc_id"] for r in rest.collect()) == kept


@pytest.mark.parametrize("between", ["\n", "-", ".", "\t\t"])
def test_blocks_are_bounded_whatever_stands_between_words(spark, monkeypatch, between):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 1000)
    items = [(i, between.join(f"w{i}x{k}" for k in range(400))) for i in range(10)]
    blocks = list(decontaminate._blocks(decontaminate._items(spark.createDataFrame(items, "item_id long, text string"), "item_id", "text")))
    assert len(blocks) == 4 and [last for _, last in blocks] == [False, False, False, True]
