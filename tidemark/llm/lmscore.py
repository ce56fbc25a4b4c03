"""Stupid-backoff language model scores of documents, computed relationally.

Counts of one-, two- and three-word runs are taken over all documents; a run
counts as known if it occurs at least twice, so that a document's own words do
not explain it. A word scores log(count of the longest known run that ends
there / count of the run before it), and each word by which the run had to be
shortened costs log(0.4). A document's score is the sum over its words.

Texts are packed in batches of bounded size and written. A batch sends each of
its distinct runs once, with the number of times it has it, to the partition of
the run's hash, in sorted and packed arrays: this is the exploded side of the
join, with repeats summed before they move. A partition adds up the counts of
equal runs over all batches, which is its part of the count table, joins them
to the runs asked for, and answers each batch in the order in which it asked.
There the answers are joined with the words again and summed per document. The
number of partitions follows the number of words, so that each stays small.
Runs are told apart by 56 bits of hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.data import stored
from tidemark.llm.textbuf import ALNUM, PIECE_BYTES, Words, find_words, mix, ngrams, pieces, text_bytes

ORDER = 3
BACKOFF = 0.4
#: A run of two or more words is known if it occurs so often.
LEAST_COUNT = 2
#: Bytes of text in a batch, or one text, and words behind a partition of the count table.
BATCH_BYTES = 8 << 20
PARTITION_WORDS = 800_000
#: Bits of hash that tell runs apart.
BITS = 56


def _batches(id_type: pa.DataType):
    """Rows of texts to rows of batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        pack = zstandard.ZstdCompressor(level=6)
        held: list[tuple[pa.Array, np.ndarray, np.ndarray, int]] = []

        def out() -> pa.RecordBatch:
            ids = pa.concat_arrays([h[0] for h in held])
            sizes = np.concatenate([np.diff(h[2]) for h in held])
            blob = pack.compress(b"".join(h[1].tobytes() for h in held))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([ids.to_pylist()], pa.list_(id_type)),
                    pa.array([sizes], pa.list_(pa.int64())),
                    pa.array([blob], pa.binary()),
                    pa.array([sum(h[3] for h in held)], pa.int64()),
                ],
                names=["batch", "ids", "sizes", "blob", "words"],
            )

        for piece in pieces(batches):
            data, offsets = text_bytes(piece.column("text"))
            if held and sum(len(h[1]) for h in held) + len(data) > BATCH_BYTES:
                yield out()
                number, held = number + 1, []
            held.append((piece.column("id"), data, offsets, len(find_words(data, offsets, ALNUM).hash)))
        if held:
            yield out()

    return run


class _Runs:
    """The runs of a batch: of each order the sorted distinct hashes, how often
    each occurs, and for each place the index of its run."""

    def __init__(self, sizes: list[int], blob: bytes):
        offsets = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))]).astype(np.int64)
        data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob, max_output_size=int(offsets[-1]) + 1), np.uint8)
        self.words = _words(data, offsets)
        self.hashes, self.counts, self.index = [], [], []
        for n in range(1, ORDER + 1):
            values = mix(self.words.hash) if n == 1 else ngrams(self.words, n)[0]
            distinct, index, counts = np.unique(values >> np.uint64(64 - BITS), return_inverse=True, return_counts=True)
            self.hashes.append(distinct)
            self.counts.append(counts.astype(np.uint32))
            self.index.append(index.astype(np.int32))

    def cuts(self, order: int, partitions: int) -> np.ndarray:
        """Where each partition's hashes begin."""
        bounds = [(k << BITS) // partitions for k in range(1, partitions)]
        inner = np.searchsorted(self.hashes[order], np.array(bounds, np.uint64))
        return np.concatenate([[0], inner, [len(self.hashes[order])]])

    def scores(self, known: list[np.ndarray], total: int) -> tuple[np.ndarray, np.ndarray]:
        """Words and the sum of their log scores of each text; ``known``: counts of the distinct runs."""
        words = self.words
        n = len(words.hash)
        texts = len(words.first) - 1
        within = np.arange(n) - words.first[:-1][words.doc] if n else np.zeros(0, np.int64)
        count = [known[0][self.index[0]]]
        for order in range(1, ORDER):  # of the run that ends at each word
            full = np.zeros(n, np.int64)
            full[within >= order] = known[order][self.index[order]]
            count.append(full)
        longest = np.minimum(within, ORDER - 1)
        score = np.log(np.maximum(count[0], 1) / max(total, 1)) + longest * math.log(BACKOFF)
        for order in range(1, ORDER):
            has = (within >= order) & (count[order] >= LEAST_COUNT)
            before = count[order - 1][np.flatnonzero(has) - 1]
            score[has] = np.log(count[order][has] / before) + (longest[has] - order) * math.log(BACKOFF)
        return np.diff(words.first), np.bincount(words.doc, score, texts).astype(np.float64)


def _words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words of a batch, found piece by piece; where they start is not kept."""
    hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE_BYTES, "right")) - 1)
        found = find_words(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], ALNUM)
        hashes.append(found.hash)
        counts.append(np.diff(found.first))
        at = to
    n = np.concatenate(counts)
    nowhere = np.zeros(0, np.int64)
    return Words(nowhere, nowhere, np.repeat(np.arange(len(n)), n), np.concatenate(hashes), np.concatenate([[0], np.cumsum(n)]))


def _packed(hashes: np.ndarray, counts: np.ndarray, pack: zstandard.ZstdCompressor) -> bytes:
    """Differences of sorted hashes and counts, byte by byte of all values, so that high bytes compress."""
    gaps = np.diff(hashes, prepend=np.uint64(0))
    planes = np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T)
    return pack.compress(planes.tobytes() + _small(counts))


def _small(counts: np.ndarray) -> bytes:
    """Counts byte by byte of all values."""
    return np.ascontiguousarray(counts.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes()


def _values(planes: bytes, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, n).T).view(np.uint64).reshape(n)


def _unpacked(payload: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(payload, max_output_size=16 * n + 1)
    return np.cumsum(_values(raw[: 8 * n], n), dtype=np.uint64), _values(raw[8 * n :], n)


def _asked(partitions: int):
    """Batches to packed runs for each partition and order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for row in range(batch.num_rows):
                runs = _Runs(batch.column("sizes")[row].as_py(), batch.column("blob")[row].as_py())
                rows = []
                for order in range(ORDER):
                    cuts = runs.cuts(order, partitions).tolist()
                    for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        if b > a:
                            rows.append((p * ORDER + order, b - a, _packed(runs.hashes[order][a:b], runs.counts[order][a:b], pack)))
                if rows:
                    slot, n, payload = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(rows), batch.column("batch")[row].as_py(), np.int64)),
                            pa.array(slot, pa.int64()),
                            pa.array(n, pa.int64()),
                            pa.array(payload, pa.binary()),
                        ],
                        names=["batch", "slot", "n", "payload"],
                    )

    return run


def _answered(table: pa.Table) -> pa.Table:
    """One partition and order: the counts over all batches, for each batch in its order."""
    sizes = table.column("n").to_pylist()
    pack = zstandard.ZstdCompressor(level=1)
    total = sum(sizes)
    hashes, counts = np.empty(total, np.uint64), np.empty(total, np.uint32)
    at = 0
    for payload, n in zip(table.column("payload"), sizes):
        hashes[at : at + n], counts[at : at + n] = _unpacked(payload.as_py(), n)
        at += n
    order = np.argsort(hashes, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]]))
    sums = np.add.reduceat(counts[order], first)
    counts[order] = np.repeat(sums, np.diff(np.append(first, total)))
    ends = np.cumsum(sizes)
    replies = [pack.compress(_small(counts[e - n : e])) for e, n in zip(ends, sizes)]
    return pa.table(
        {
            "batch": table.column("batch"),
            "slot": table.column("slot"),
            "n": table.column("n"),
            "answer": pa.array(replies, pa.binary()),
        }
    )


def score_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Stupid-backoff scores of whole texts against the counts of all of them.

    Returns ``id_column``, ``n_words``, ``log_score`` (the sum, natural
    logarithm) and ``mean_log_score`` (per word; null without words). Words are
    runs of letters, digits and characters beyond ASCII, A-Z lower-cased; runs
    do not cross texts. Null and empty texts have no words and a sum of 0. One
    row per input row, repeated ids included; other columns are not read.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    id_type = to_arrow_type(rows.schema["id"].dataType)
    packed = stored(
        rows.mapInArrow(_batches(id_type), f"batch long, ids array<{kind}>, sizes array<long>, blob binary, words long")
    )
    total = packed.agg(F.sum("words")).first()[0] or 0
    partitions = max(1, -(-total // PARTITION_WORDS))
    asked = packed.select("batch", "sizes", "blob").mapInArrow(_asked(partitions), "batch long, slot long, n long, payload binary")
    answers = asked.groupBy("slot").applyInArrow(_answered, "batch long, slot long, n long, answer binary")

    def joined(batch: pa.Table, replies: pa.Table) -> pa.Table:
        ids, words, scores = [], [], []
        for row in batch.to_pylist():
            runs = _Runs(row["sizes"], row["blob"])
            answer = dict(zip(replies.column("slot").to_pylist(), replies.column("answer").to_pylist()))
            known = []
            for order in range(ORDER):
                cuts = runs.cuts(order, partitions).tolist()
                parts = []
                for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    if b > a:
                        raw = zstandard.ZstdDecompressor().decompress(answer[p * ORDER + order], max_output_size=8 * (b - a) + 1)
                        parts.append(_values(raw, b - a))
                known.append(np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64))
            n, score = runs.scores(known, total)
            ids += row["ids"]
            words.append(n)
            scores.append(score)
        n = np.concatenate(words) if words else np.zeros(0, np.int64)
        score = np.concatenate(scores) if scores else np.zeros(0)
        mean = pa.array(score / np.maximum(n, 1), mask=n == 0)
        return pa.table({"id": pa.array(ids, id_type), "n_words": pa.array(n), "log_score": pa.array(score), "mean_log_score": mean})

    texts = packed.select("batch", "ids", "sizes", "blob").groupBy("batch")
    out = texts.cogroup(answers.groupBy("batch")).applyInArrow(
        joined, f"id {kind}, n_words long, log_score double, mean_log_score double"
    )
    return out.withColumnRenamed("id", id_column)
