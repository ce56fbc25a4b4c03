"""Benchmark passages in documents, by CGK embeddings and bit sampling.

Texts are sequences of lower-case words. The CGK embedding walks along a
sequence: at each step it emits the word it stands on and goes on by 0 or 1
words, as a random bit of the step and the word says. Two sequences within a
small edit distance soon walk in step again after an edit, so that their
embeddings agree in most steps: edit distance becomes Hamming distance. Of
several walks, several samples of few steps each are hashed; windows of a
document and of an item with an equal sample are candidates. Windows begin at
every word of an item that leaves room for a sample, and in a document at every
t-th word, where t grows with the size of the items looked for, so that each
occurrence of the shortest item of a size, too, holds three windows or more that
begin at the same word of the item. Candidates are confirmed by the exact
edit distance between the item and the best stretch of the document there.

Items are a query set: they are taken in blocks of bounded size, and each block
is looked up in all windows of all documents within one pass over the texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.data import stored
from tidemark.llm.textbuf import ALNUM, Words, draws, find_words, freed, mix, pieces, text_bytes

#: Words of items looked up in one pass; items beyond form further blocks.
BLOCK_WORDS = 400_000
#: An occurrence may differ in one of so many words of the item, edits counted.
WORDS_PER_EDIT = 4
#: Items with fewer words must occur unchanged.
SHORT_WORDS = 8
SAMPLES, SAMPLED_STEPS = 6, 3
#: By the least size of a class: from one window of a document to the next, and walks.
#: Larger classes have an eighth of their size, and the walks of the last.
#: Chosen so that of occurrences with the most edits 98 % are found at every length.
WINDOWS = {8: (1, 2), 16: (2, 2), 32: (2, 2), 64: (8, 2)}
MAX_STEPS = 64
#: Slots of a filter per key, as a power of two, and slots at most.
FILTER_SPARE, FILTER_BITS = 6, 24


def allowed_edits(words: int) -> int:
    return words // WORDS_PER_EDIT if words >= SHORT_WORDS else 0


@dataclass
class _Class:
    """Items of lengths in [size, 2 * size): their walks and samples."""

    size: int
    stride: int
    walks: int
    steps: int
    samples: list[list[int]]  # steps of each sample
    keys: list[list[np.ndarray]] = field(default_factory=list)  # by walk and sample, sorted
    owners: list[list[np.ndarray]] = field(default_factory=list)  # item << 32 | offset
    filters: list[list[np.ndarray]] = field(default_factory=list)
    filter_bits: int = 0


def _samples(steps: int, seed: int) -> list[list[int]]:
    """Steps of each sample: one in each part of a span from the start, spans of different lengths."""
    random = np.random.default_rng(seed)
    out = []
    for k in range(SAMPLES):
        part = steps * (0.6 + 0.4 * k / (SAMPLES - 1)) / SAMPLED_STEPS
        out.append([int((i + random.random()) * part) for i in range(SAMPLED_STEPS)])
    return out


def _walk(words: np.ndarray, starts: np.ndarray, samples: list[list[int]], walk: int) -> dict[int, np.ndarray]:
    """The words emitted at the sampled steps, for each start; ``words`` has entries to spare."""
    bits = mix(words + draws(walk + 1, 301)[walk])
    at = starts.astype(np.int64)
    wanted = {j for s in samples for j in s}
    out = {}
    for j in range(max(wanted) + 1):
        if j in wanted:
            out[j] = words[at]
        at += ((bits[at] >> np.uint64(j)) & np.uint64(1)).view(np.int64)
    return out


_ODD = draws(SAMPLED_STEPS, 302) | np.uint64(1)


def _sample_keys(emitted: dict[int, np.ndarray], steps: list[int]) -> np.ndarray:
    key = emitted[steps[0]] * _ODD[0]
    for k, j in enumerate(steps[1:], 1):
        key = key + emitted[j] * _ODD[k]
    return key * np.uint64(0x9E3779B97F4A7C15)


class ItemIndex:
    """The samples of a block of items."""

    def __init__(self, items: list[tuple[object, str | None]]):
        self.ids = [i for i, _ in items]
        data, offsets = text_bytes(pa.array([t for _, t in items], pa.string()))
        words = find_words(data, offsets, ALNUM)
        self.words = [words.hash[a:b] for a, b in zip(words.first, words.first[1:])]
        self.lists = [w.tolist() for w in self.words]
        self.short: dict[int, dict[int, list[int]]] = {}  # by length, by key: items
        self.classes: list[_Class] = []
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(self.words):
            if len(w) >= SHORT_WORDS:
                by_size.setdefault(1 << (len(w).bit_length() - 1), []).append(i)
            elif len(w):
                self.short.setdefault(len(w), {}).setdefault(int(_run_keys(w, len(w))[0]), []).append(i)
        for size, members in sorted(by_size.items()):
            self.classes.append(self._class(size, members))

    def _class(self, size: int, members: list[int]) -> _Class:
        steps = min(size * 3 // 2, MAX_STEPS)
        stride, walks = WINDOWS.get(size, (size // 8, WINDOWS[max(WINDOWS)][1]))
        found = _Class(size, stride, walks, steps, _samples(steps, size))
        flat, starts, owners, base = [], [], [], 0
        for i in members:
            w = self.words[i]
            # Walks need about half as many words as steps, short samples less.
            # More beginnings than the stride, so that several meet a document's windows.
            offsets = np.arange(max(len(w) - steps * 3 // 8, 2 * found.stride))
            starts.append(base + offsets)
            owners.append((np.int64(i) << 32) | offsets)
            flat += [w, draws(steps + 1, i + 1000)]
            base += len(w) + steps + 1
        flat, starts, owners = np.concatenate(flat), np.concatenate(starts), np.concatenate(owners)
        found.filter_bits = min(max(len(starts).bit_length() + FILTER_SPARE, 10), FILTER_BITS)
        for walk in range(found.walks):
            emitted = _walk(flat, starts, found.samples, walk)
            keys = [_sample_keys(emitted, s) for s in found.samples]
            orders = [np.argsort(k, kind="stable") for k in keys]
            found.keys.append([k[o] for k, o in zip(keys, orders)])
            found.owners.append([owners[o] for o in orders])
            filters = []
            for k in keys:
                present = np.zeros(1 << found.filter_bits, bool)
                present[k >> np.uint64(64 - found.filter_bits)] = True
                filters.append(np.packbits(present))
            found.filters.append(filters)
        return found

    def candidates(self, words: Words) -> np.ndarray:
        """Distinct rows (text, item, first word of the item in the text's words)."""
        n = len(words.hash)
        found = []
        for size, table in self.short.items():
            keys = _run_keys(words.hash, size)
            wanted = np.array(sorted(table), np.uint64)
            at = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
            places = np.flatnonzero(wanted[at] == keys)
            # Of a text's places of a key the first is enough.
            _, firsts = np.unique(words.doc[places] * len(wanted) + at[places], return_index=True)
            rows = [(words.doc[p], i, p) for p in places[firsts].tolist() for i in table[int(keys[p])]]
            found.append(np.array(rows, np.int64).reshape(-1, 3))
        within = np.arange(n) - words.first[:-1][words.doc] if n else np.zeros(0, np.int64)
        for c in self.classes:
            starts = np.flatnonzero(within % c.stride == 0)
            padded = np.concatenate([words.hash, draws(c.steps + 1, 7)])
            for walk in range(c.walks):
                emitted = _walk(padded, starts, c.samples, walk)
                for s, steps in enumerate(c.samples):
                    key = _sample_keys(emitted, steps)
                    slot = key >> np.uint64(64 - c.filter_bits)
                    bit = np.uint8(128) >> (slot & np.uint64(7)).astype(np.uint8)
                    maybe = np.flatnonzero(c.filters[walk][s][slot >> np.uint64(3)] & bit)
                    if not len(maybe):
                        continue
                    keys, owners = c.keys[walk][s], c.owners[walk][s]
                    lo = np.searchsorted(keys, key[maybe], "left")
                    hi = np.searchsorted(keys, key[maybe], "right")
                    many = hi - lo
                    place = np.repeat(starts[maybe], many)
                    rank = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many)
                    item, offset = owners[rank] >> 32, owners[rank] & 0xFFFFFFFF
                    found.append(np.stack([words.doc[place], item, place - offset], axis=1))
        if not found:
            return np.zeros((0, 3), np.int64)
        return np.unique(np.concatenate(found), axis=0)

    def occurrences(self, words: Words) -> list[tuple[int, int, int, int]]:
        """(text, item, edits, first word) of the best confirmed occurrence of each item in each text."""
        out: dict[tuple[int, int], tuple[int, int]] = {}
        rows = self.candidates(words).tolist()
        at = 0
        while at < len(rows):
            text, item, start = rows[at]
            edits = allowed_edits(len(self.words[item]))
            last = start
            at += 1  # starts that lie close together are looked at as one stretch
            while at < len(rows) and rows[at][:2] == [text, item] and rows[at][2] <= last + edits + 1:
                last = rows[at][2]
                at += 1
            a, b = int(words.first[text]), int(words.first[text + 1])
            own = self.words[item]
            if start == last and start >= a and np.array_equal(words.hash[start : min(start + len(own), b)], own):
                out[text, item] = min((0, start - a), out.get((text, item), (1, 0)))
                continue
            low, high = max(a, start - edits), min(b, last + len(self.words[item]) + edits)
            if high <= low:
                continue
            there = set(words.hash[low:high].tolist())
            if sum(w not in there for w in self.lists[item]) > edits:  # each takes an edit
                continue
            distance, first = best_stretch(self.words[item], words.hash[low:high])
            best = (distance, low + first - a)
            if distance <= edits and best < out.get((text, item), (edits + 1, 0)):
                out[text, item] = best
        return [(text, item, *best) for (text, item), best in out.items()]


def _run_keys(words: np.ndarray, size: int) -> np.ndarray:
    """A key of every run of ``size`` words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    odd = draws(SHORT_WORDS, 303) | np.uint64(1)
    key = words[:n] * odd[0]
    for k in range(1, size):
        key = key + words[k : k + n] * odd[k]
    return mix(key)


def best_stretch(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """The least edit distance between ``item`` and any stretch of ``text``, and where that begins.

    Substitutions, insertions and deletions of words cost 1. Of equally good
    stretches the one that ends first counts, of those the longest.
    """
    n = len(text)
    steps = np.arange(n + 1)
    # The distance above the start of the stretch, so that smaller is better in both.
    scale = n + 2
    row = steps.astype(np.int64)  # nothing of the item used: distance 0, begins here
    for word in item:
        diagonal = row[:-1] + np.where(text == word, 0, scale)
        new = row + scale
        new[1:] = np.minimum(new[1:], diagonal)
        row = np.minimum.accumulate(new - steps * scale) + steps * scale
    best = row // scale
    end = int(np.argmin(best))
    return int(best[end]), int(row[end] % scale)


#: A word as it is found in texts, whatever stands between words.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _blocks(items: DataFrame) -> Iterator[tuple[ItemIndex, bool]]:
    """Each block, and whether it is the last; built when it is asked for."""
    block: list[tuple[object, str | None]] = []
    words = 0
    rows = items.toLocalIterator()
    row = next(rows, None)
    while row is not None:
        block.append((row["id"], row["text"]))
        words += len(_WORD.findall(row["text"] or "")) + 1
        row = next(rows, None)
        if words >= BLOCK_WORDS or row is None:
            whole, block, words = block, [], 0
            yield ItemIndex(whole), row is None


def _items(items: DataFrame, item_column: str, text_column: str) -> DataFrame:
    return items.select(F.col(item_column).alias("id"), F.col(text_column).cast("string").alias("text"))


def find_items(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """Which items occur in which documents.

    Returns ``id_column``, ``item_column``, ``edits`` (words to substitute,
    insert or delete; at most a quarter of the item's), ``item_words``,
    ``similarity`` (1 - edits / item_words) and ``first_word``, one row per
    input row and item, for the best occurrence. Null or empty texts and items
    have no words and never match; rows without an id are looked at like
    others, and repeated rows and items give repeated results. Other columns
    are not read.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    item_type = items.schema[item_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    schema = f"id {kind}, item {item_type}, edits long, item_words long, similarity double, first_word long"

    result = pa.schema(
        [
            ("id", to_arrow_type(rows.schema["id"].dataType)),
            ("item", to_arrow_type(items.schema[item_column].dataType)),
            ("edits", pa.int64()),
            ("item_words", pa.int64()),
            ("similarity", pa.float64()),
            ("first_word", pa.int64()),
        ]
    )

    def finder(index: ItemIndex):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for piece in pieces(batches):
                found = index.occurrences(_words(piece))
                if not found:
                    continue
                text, item, edits, first = (list(c) for c in zip(*found))
                sizes = [len(index.words[i]) for i in item]
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": piece.column("id").take(pa.array(text)).cast(result.field("id").type),
                        "item": pa.array([index.ids[i] for i in item]),
                        "edits": edits,
                        "item_words": sizes,
                        "similarity": [1 - e / n for e, n in zip(edits, sizes)],
                        "first_word": first,
                    },
                    schema=result,
                )

        return run

    # Each block is done and written before the next is built, so that one is held at a time.
    out = None
    for index, last in _blocks(_items(items, item_column, item_text_column)):
        part = rows.mapInArrow(freed(finder(index)), schema)
        del index
        part = part if last else stored(part)
        out = part if out is None else out.unionAll(part)
    if out is None:
        out = rows.sparkSession.createDataFrame([], schema)
    return out.withColumnsRenamed({"id": id_column, "item": item_column})


def _words(piece: pa.RecordBatch) -> Words:
    data, offsets = text_bytes(piece.column("text"))
    return find_words(data, offsets, ALNUM)


def drop_contaminated(
    docs: DataFrame, items: DataFrame, text_column: str = "text", item_text_column: str = "text"
) -> DataFrame:
    """The documents in which no item occurs, all columns kept.

    Null and empty texts hold no item and stay. Rows without an id and repeated
    rows are judged each by their own text; with no items all rows stay.
    """
    columns = docs.columns
    schema = docs.schema

    def keeper(index: ItemIndex):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for piece in pieces(batches, text_column):
                data, offsets = text_bytes(piece.column(text_column))
                hit = {text for text, *_ in index.occurrences(find_words(data, offsets, ALNUM))}
                kept = np.ones(piece.num_rows, bool)
                kept[list(hit)] = False
                yield piece.filter(pa.array(kept))

        return run

    out = docs.withColumn(text_column, F.col(text_column).cast("string")) if dict(docs.dtypes)[text_column] != "string" else docs
    for index, last in _blocks(_items(items, item_text_column, item_text_column)):
        out = out.mapInArrow(freed(keeper(index)), schema)
        del index
        out = out if last else stored(out)
    return out.select(*[F.col(f"`{c}`") for c in columns])
