"""Periodic runs of words, and texts with their repetitions collapsed.

A run is a stretch of consecutive words with a smallest period q that no
neighbouring word extends. In a run of at least ``repeats`` periods, word k
equals word k + q at so many places in a row that two neighbours of a grid of
fixed step lie among them; the steps of all periods make a harmonic grid of
some n log n points a text. Where both points hold, the longest common extension
of the two suffixes at k and k + q tells how far the run goes on, and a binary
search over extensions where it began.

Extensions come from a difference cover: of any two places, some equal shift of
fewer than 13 words leads to two sampled places. Only sampled suffixes are
sorted, by doubling, of which ever fewer are left tied; their common blocks of
13 words stand in a sparse table of range minima. So an extension is at most 12
words compared, one look-up, and at most 12 words compared again.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textbuf import draws, freed, mix, pieces

MODULUS = 13
#: Every difference modulo 13 is that of two of these.
COVER = (0, 1, 3, 9)
#: Grid points looked at together.
POINTS = 1 << 20

_IN_COVER = np.isin(np.arange(MODULUS), COVER)
_SHIFT = np.array(
    [[next(d for d in range(MODULUS) if _IN_COVER[(a + d) % MODULUS] and _IN_COVER[(b + d) % MODULUS]) for b in range(MODULUS)]
     for a in range(MODULUS)]
)
_STEP = draws(MODULUS + 1, 41) | np.uint64(1)


def lay_out(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts of word numbers from 1, each with 13 zeros behind; where each begins and ends."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(sizes + MODULUS) - sizes - MODULUS
    word = np.zeros(int((sizes + MODULUS).sum()), np.int64)
    for t, b in zip(texts, begin.tolist()):
        word[b : b + len(t)] = t
    return word, begin, begin + sizes


class Extensions:
    """Longest common extensions of places of the same text."""

    def __init__(self, word: np.ndarray, begin: np.ndarray, end: np.ndarray):
        self.word = word
        text = np.repeat(np.arange(len(begin)), end - begin + MODULUS)
        place = np.flatnonzero(_IN_COVER[np.arange(len(word)) % MODULUS])
        place = place[place <= end[text[place]]]
        self.place = place
        self.number = np.full(len(word), -1, np.int64)
        self.number[place] = np.arange(len(place))
        key = (text[place].astype(np.uint64) + np.uint64(1)) * _STEP[-1]
        padded = mix(np.append(word, np.zeros(MODULUS, np.int64)).astype(np.uint64) + np.uint64(1))
        for k in range(MODULUS):
            key += padded[place + k] * _STEP[k]
        self._sort(mix(key))

    def _sort(self, key: np.ndarray) -> None:
        """Ranks of sampled suffixes in the order of their blocks, and the sparse table."""
        m = len(key)
        order = np.argsort(key, kind="stable")
        rank = np.zeros(m, np.int64)
        rank[order], tied = _groups(key[order], np.zeros(m, np.int64))
        tied = order[tied]
        levels, step = [rank], MODULUS
        while len(tied):
            second = rank[self.number[self.place[tied] + step]]
            by = np.lexsort((second, rank[tied]))
            tied = tied[by]
            new, again = _groups(second[by], rank[tied])
            rank = rank.copy()
            rank[tied], tied = new, tied[again]
            levels.append(rank)
            step *= 2
        self.rank = rank
        suffix = np.zeros(m, np.int64)
        suffix[rank] = np.arange(m)
        # Blocks in common with the suffix before, where there are any.
        common = np.zeros(m, np.int32)
        sorted_first = levels[0][suffix]
        shared = np.flatnonzero(sorted_first[1:] == sorted_first[:-1]) + 1
        a, b = self.place[suffix[shared - 1]], self.place[suffix[shared]]
        for level in range(len(levels) - 1, -1, -1):
            one, other = self.number[a], self.number[b]
            same = np.flatnonzero((one >= 0) & (other >= 0) & (levels[level][one] == levels[level][other]))
            common[shared[same]] += 1 << level
            a[same] += MODULUS << level
            b[same] += MODULUS << level
        self.table = [common]
        while len(shared) and 2 << (len(self.table) - 1) <= m:
            last, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[: len(last) - half], last[half:]))

    def _blocks(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Blocks of 13 words that sampled suffixes have in common."""
        if len(self.table) == 1:
            return np.zeros(len(one), np.int64)
        low, high = np.minimum(one, other) + 1, np.maximum(one, other) + 1  # ranks low to high - 1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.zeros(len(one), np.int64)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.table[k][low[at]], self.table[k][high[at] - (1 << k)])
        return out

    def _compare(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from i and j on, at most ``most``."""
        out = np.zeros(len(i), np.int64)
        at = np.flatnonzero(most > 0)
        while len(at):
            at = at[self.word[i[at] + out[at]] == self.word[j[at] + out[at]]]
            out[at] += 1
            at = at[out[at] < most[at]]
        return out

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from places i < j of one text on are the same."""
        shift = _SHIFT[i % MODULUS, j % MODULUS]
        out = self._compare(i, j, shift)
        at = np.flatnonzero(out == shift)
        one, other = self.number[i[at] + shift[at]], self.number[j[at] + shift[at]]
        out[at] += MODULUS * self._blocks(self.rank[one], self.rank[other])
        out[at] += self._compare(i[at] + out[at], j[at] + out[at], np.full(len(at), MODULUS))
        return out


def _groups(second: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """New ranks of rows sorted by (rank, second), and which rows are still tied.

    Ranks are the places where groups of equal rows begin; a group of old ranks
    takes the places from its rank on.
    """
    n = len(rank)
    if not n:
        return rank, np.zeros(0, np.int64)
    at = np.arange(n)
    old = np.append(True, rank[1:] != rank[:-1])
    new = old | np.append(True, second[1:] != second[:-1])
    group_begins = np.maximum.accumulate(np.where(old, at, 0))
    begins = np.maximum.accumulate(np.where(new, at, 0))
    alone = new & np.append(new[1:], True)
    return rank + begins - group_begins, np.flatnonzero(~alone)


def runs(
    word: np.ndarray, begin: np.ndarray, end: np.ndarray, least: int = 6, repeats: int = 4
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and period of all runs of at least ``least`` words
    and ``repeats`` periods, by text, start and period."""
    if least < 3 or repeats < 3:
        raise ValueError("runs must have at least three words and three periods")
    known = Extensions(word, begin, end)
    # All (text, period) with room for a run, and the points of their grids.
    periods = np.where(end - begin >= least, (end - begin) // repeats, 0)
    text = np.repeat(np.arange(len(begin)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = (np.maximum(least, repeats * period) - period) // 2
    points = np.maximum((end - begin)[text] - period, 0) // step
    total = np.cumsum(points)
    out = []
    at = 0
    while at < len(text):
        done = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + POINTS, "right")))
        out.append(_some_runs(known, begin, text[at:to], period[at:to], step[at:to], points[at:to], least, repeats))
        at = to
    if not out:
        return (np.zeros(0, np.int64),) * 4
    text, start, length, period = (np.concatenate(parts) for parts in zip(*out))
    order = np.lexsort((period, length, start, text))
    text, start, length, period = text[order], start[order], length[order], period[order]
    # The same stretch is found again by multiples of its smallest period.
    once = np.ones(len(text), bool)
    once[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    text, start, length, period = text[once], start[once], length[once], period[once]
    order = np.lexsort((period, start, text))
    return text[order], start[order], length[order], period[order]


def _some_runs(known: Extensions, begin, text, period, step, points, least: int, repeats: int):
    """Runs of some (text, period), the period not always the smallest."""
    pair = np.repeat(np.arange(len(text)), points)
    k = (np.arange(len(pair)) - np.repeat(np.cumsum(points) - points, points)) * step[pair]
    k += begin[text[pair]]
    word = known.word
    q, s = period[pair], step[pair]
    at = np.flatnonzero(word[k] == word[k + q])
    # The next point holds too; behind a text's end anything may stand, which its extensions do not reach.
    beyond = np.minimum(k[at] + s[at] + q[at], len(word) - 1)
    at = at[word[beyond - q[at]] == word[beyond]]
    ahead = known.common(k[at], k[at] + q[at])
    at, ahead = at[ahead >= s[at]], ahead[ahead >= s[at]]
    # Of a run's points the first is enough.
    first = np.ones(len(at), bool)
    first[1:] = (at[1:] != at[:-1] + 1) | (pair[at[1:]] != pair[at[:-1]])
    at, ahead = at[first], ahead[first]
    pair, k, q, s = pair[at], k[at], q[at], s[at]
    # It began behind the point before, or with the text.
    low, high = np.maximum(k - s + 1, begin[text[pair]]), k.copy()
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        holds = known.common(middle, middle + q[open_]) >= k[open_] - middle
        high[open_[holds]] = middle[holds]
        low[open_[~holds]] = middle[~holds] + 1
        open_ = open_[low[open_] < high[open_]]
    length = k + ahead + q - high
    kept = length >= np.maximum(least, repeats * q)
    return text[pair[kept]], (high - begin[text[pair]])[kept], length[kept], q[kept]


def find_runs(
    docs: DataFrame, least: int = 6, repeats: int = 4, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The periodic runs of every whole text, and the text without what they repeat.

    Words end at ASCII white space and differ by letter case. Returns
    ``id_column``, ``n_words``, ``runs`` (array of start, length, period, by
    start, then period; starts are numbers of words from 0) and ``collapsed``:
    the words that no run has after its first period, joined by one space. One
    row per input row, repeated rows and rows without an id included; a null or
    empty text has no words, no runs and an empty ``collapsed``. Of stretches
    with several periods the smallest counts. Other columns are not read. A text
    is taken whole, at some 500 bytes of memory a word. Blocks of 13 words are
    told apart by 64 bits of hash.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            texts = [(t or b"").split() for t in piece.column("text").cast(pa.binary()).to_pylist()]
            numbers: dict[bytes, int] = defaultdict(count(1).__next__)
            found = _rows(texts, *runs(*lay_out([np.array([numbers[w] for w in t], np.int64) for t in texts]), least, repeats))
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), *found], names=["id", "n_words", "runs", "collapsed"]
            )

    chosen = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    shape = f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return chosen.mapInArrow(freed(run), shape).withColumnRenamed("id", id_column)


def _rows(texts: list[list[bytes]], text, start, length, period) -> list[pa.Array]:
    bounds = np.searchsorted(text, np.arange(len(texts) + 1))
    collapsed = []
    for k, words in enumerate(texts):
        some = slice(bounds[k], bounds[k + 1])
        if bounds[k] < bounds[k + 1]:
            cover = np.zeros(len(words) + 1, np.int64)
            np.add.at(cover, start[some] + period[some], 1)
            np.add.at(cover, start[some] + length[some], -1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(cover)[:-1] == 0).tolist()]
        collapsed.append(b" ".join(words))
    structs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
    return [
        pa.array([len(t) for t in texts], pa.int64()),
        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), structs),
        pa.array(collapsed, pa.binary()).cast(pa.string()),
    ]


def planted(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with the texts of one id in ten made periodic from some word on.

    With h the unsigned crc32 of the decimal id, g = floor(h / 10) and n the
    number of words: if h mod 10 is 0 and n > 0, each word i >= a becomes word
    a + (i - a) mod p, where a = g mod n and p = 1 + floor((n - a) / (3 + g mod 8)).
    Texts of other ids, null ids included, stay as they are.
    """
    hashed = F.crc32(F.col(id_column).cast("string"))
    words = F.regexp_extract_all(F.col(text_column).cast("string"), F.lit(r"([^\x20\x09-\x0D]+)"))
    g = F.floor(hashed / 10).cast("long")
    n = F.size("__words").cast("long")
    a = g % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
    place = F.sequence(F.lit(0).cast("long"), n - 1)
    changed = F.transform(
        place, lambda i: F.element_at("__words", F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int") + 1)
    )
    some = docs.withColumn("__words", F.when(hashed % 10 == 0, words))
    return some.withColumn(
        text_column, F.when(n > 0, F.concat_ws(" ", changed)).otherwise(F.col(text_column).cast("string"))
    ).drop("__words")


def run_digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per row of ``find_runs``: number of runs, the longest (ties: smallest start,
    then period), and hashes of all runs and of the collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    longest = F.when(F.size("runs") > 0, longest)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    length, start, period = (longest.getField(k) for k in ("length", "col2", "col3"))
    return found.select(
        id_column,
        F.size("runs").cast("long").alias("n_runs"),
        (-start).alias("start"),
        length.alias("length"),
        (-period).alias("period"),
        F.floor(F.lit(1000) * length / -period).cast("long").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
