"""License notices: an exact set-similarity join of text blocks with templates.

A block is a line, or a stretch of 64 words of a longer one, each beginning 32
words after the last; with a template of more than 32 words, twice and once its
words. A template is the word set of a notice. A block holds a
template if it has at least nine tenths of its words, and gets the label of
those of which it has the largest share. A block may have several notices, and
a notice may be wrapped over several lines: labels are also given for every
stretch of the text, across line breaks, of as many words as the notice and
with nine tenths of its words; of stretches that share more than half of their
words the one with the larger share counts. Words of templates are
ordered by the number of documents that have them, rarest first. Templates are
indexed by a prefix: so many of their rarest words that a block without any of
these cannot hold them. A block is compared with the templates whose prefix
words it has, unless it is too short, or too few words of either are left
behind the place of the common word. The comparison itself is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textbuf import ALNUM, Words, find_words, pieces, text_bytes

# Phrases with their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Usual wordings of license notices.
TEMPLATES = {
    "agpl-3.0": ["licensed under the gnu affero general public license version 3"],
    "apache-2.0": ["licensed under the apache license version 2.0", "released under the apache license 2.0"],
    "bsd": ["licensed under the bsd license", "released under the bsd license", "use of this source code is governed by a bsd style license"],
    "cc-by-4.0": ["licensed under a creative commons attribution 4.0 international license"],
    "cc-by-nc-4.0": ["licensed under cc by nc 4.0"],
    "cc-by-sa-4.0": ["licensed under cc by sa 4.0"],
    "cc0": ["released under the cc0 public domain dedication"],
    "gpl-2.0": ["this work is licensed under the gnu general public license version 2"],
    "gpl-3.0": ["this work is licensed under the gnu general public license version 3"],
    "lgpl-3.0": ["licensed under the gnu lesser general public license version 3"],
    "mit": ["released under the mit license", "licensed under the mit license"],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public license version 2.0"],
}
#: A block holds a template with at least this percentage of its distinct words.
PERCENT = 90
#: Words of a block, and from one block's start to the next, unless a template has more words than the step.
BLOCK_WORDS, BLOCK_STEP = 64, 32

_NOT_BREAK = np.ones(256, bool)
_NOT_BREAK[0x0A] = False


def _hashes(text: str) -> np.ndarray:
    data, offsets = text_bytes(pa.array([text]))
    return find_words(data, offsets, ALNUM).hash


@dataclass
class Templates:
    """Template word sets in the order of ``vocabulary`` (hash, rarest first)."""

    labels: list[str]
    sets: list[np.ndarray]  # sorted places in the vocabulary
    sizes: list[int]  # words, repeated ones too
    needed: list[int]
    sorted_hashes: np.ndarray
    place: np.ndarray  # of each sorted hash in the vocabulary
    prefix: dict[int, list[tuple[int, int]]]  # by place: template, position in it
    in_prefix: np.ndarray

    @classmethod
    def ordered(cls, wordings: dict[str, list[str]], frequency: dict[int, int]) -> Templates:
        """``frequency``: in how many documents each word hash occurs."""
        named = sorted((label, text) for label, texts in wordings.items() for text in texts)
        sizes = [len(_hashes(text)) for _, text in named]
        words = [np.unique(_hashes(text)) for _, text in named]
        vocabulary = sorted({int(h) for w in words for h in w}, key=lambda h: (frequency.get(h, 0), h))
        place_of = {h: i for i, h in enumerate(vocabulary)}
        sets = [np.sort(np.array([place_of[int(h)] for h in w], np.int64)) for w in words]
        needed = [-(-len(s) * PERCENT // 100) for s in sets]
        prefix: dict[int, list[tuple[int, int]]] = {}
        for t, (s, need) in enumerate(zip(sets, needed)):
            for position in range(len(s) - need + 1 if need else 0):
                prefix.setdefault(int(s[position]), []).append((t, position))
        hashes = np.array(vocabulary, np.uint64)
        order = np.argsort(hashes)
        in_prefix = np.zeros(len(vocabulary), bool)
        in_prefix[list(prefix)] = True
        return cls([label for label, _ in named], sets, sizes, needed, hashes[order], order, prefix, in_prefix)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each word in the vocabulary, or -1."""
        if not len(self.sorted_hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.sorted_hashes, hashes), len(self.sorted_hashes) - 1)
        return np.where(self.sorted_hashes[at] == hashes, self.place[at], -1)

    @cached_property
    def alike(self) -> list[set[int]]:
        """For each template those that have more than half of its words."""
        return [
            {u for u, other in enumerate(self.sets) if u != t and 2 * len(np.intersect1d(own, other)) > len(own)}
            for t, own in enumerate(self.sets)
        ]

    @property
    def step(self) -> int:
        return max([BLOCK_STEP, *self.sizes])

    def stretch(self, t: int, places: list[int]) -> tuple[int, int, int]:
        """Common words, first and last + 1 of the best stretch for a template in ``places``.

        A stretch has as many words as the template at most, and begins and
        ends with a word of it. Of equally good ones the first counts.
        """
        wanted = set(self.sets[t].tolist())
        inside: dict[int, int] = {}
        best, last = 0, 0
        for k, word in enumerate(places):
            if word in wanted:
                inside[word] = inside.get(word, 0) + 1
            if k >= self.sizes[t] and (gone := places[k - self.sizes[t]]) in wanted:
                inside[gone] -= 1
                if not inside[gone]:
                    del inside[gone]
            if len(inside) > best:
                best, last = len(inside), k
        first = max(last + 1 - self.sizes[t], 0)
        while first < last and places[first] not in wanted:
            first += 1
        return best, first, last + 1

    def held(self, block: np.ndarray) -> list[tuple[int, int]]:
        """(template, common words) of all templates that a block holds.

        ``block``: sorted distinct places of its words that templates have.
        """
        found: dict[int, int] = {}
        for at, word in enumerate(block.tolist()):
            for t, position in self.prefix.get(word, ()):
                if t in found:
                    continue
                need = self.needed[t]
                left = min(len(self.sets[t]) - position, len(block) - at)
                before = min(position, at)
                if len(block) < need or before + left < need:
                    continue
                common = len(np.intersect1d(self.sets[t], block, assume_unique=True))
                found[t] = common if common >= need else 0
        return [(t, c) for t, c in found.items() if c]


def blocks(words: Words, lines: Words, step: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 word of each block that has words."""
    width = step * BLOCK_WORDS // BLOCK_STEP
    first = np.searchsorted(words.start, lines.start)
    last = np.searchsorted(words.start, lines.end)
    size = last - first
    first, size = first[size > 0], size[size > 0]
    parts = np.where(size <= width, 1, -(-(size - step) // step))
    number = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = np.repeat(first, parts) + number * step
    return begin, np.minimum(begin + width, np.repeat(first + size, parts))


def stretches(words: Words, place: np.ndarray, known: np.ndarray, index: Templates) -> list[tuple[int, int, int, int]]:
    """(first word, last + 1, template, common words) of notices, wherever lines end."""
    found = set()
    for at in np.flatnonzero(known).tolist():
        a, b = int(words.first[words.doc[at]]), int(words.first[words.doc[at] + 1])
        for t, _ in index.prefix[int(place[at])]:
            low, high = max(a, at + 1 - index.sizes[t]), min(b, at + index.sizes[t])
            own = place[low:high].tolist()
            if len(set(own)) < index.needed[t]:
                continue
            common, first, last = index.stretch(t, own)
            if common >= index.needed[t]:
                found.add((low + first, low + last, t, common))
    # The better ones first; each is compared with those that begin close to it.
    near: dict[int, list[tuple[int, int, int, float]]] = {}
    out = []
    for first, last, t, common in sorted(found, key=lambda f: (-f[3] / len(index.sets[f[2]]), f)):
        share = common / len(index.sets[t])
        others = [o for k in (-1, 0, 1) for o in near.get(first // index.step + k, ())]
        if any(
            2 * (min(last, e) - max(first, s)) > last - first and (share < other or t == u) for s, e, u, other in others
        ):
            continue
        near.setdefault(first // index.step, []).append((first, last, t, share))
        out.append((first, last, t, common))
    return out


def _phrase_starts(words: Words) -> list[tuple[str, np.ndarray]]:
    """Label and first words of all places of each phrase."""
    out = []
    for phrase, label in PHRASES.items():
        wanted = _hashes(phrase)
        n = max(len(words.hash) - len(wanted) + 1, 0)
        at = np.flatnonzero(words.hash[:n] == wanted[0])
        for k, h in enumerate(wanted[1:], 1):
            at = at[words.hash[at + k] == h]
        out.append((label, at[words.doc[at] == words.doc[at + len(wanted) - 1]]))
    return out


def _vocabulary_rows(hashes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(hashes), np.int64)
        for piece in pieces(batches):
            data, offsets = text_bytes(piece.column("text"))
            words = find_words(data, offsets, ALNUM)
            at = np.minimum(np.searchsorted(hashes, words.hash), len(hashes) - 1)
            hit = hashes[at] == words.hash
            pairs = np.unique(words.doc[hit] * len(hashes) + at[hit])
            counts += np.bincount(pairs % len(hashes), minlength=len(hashes))
        yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], names=["word", "n"])

    return run


def word_frequency(docs: DataFrame, wordings: dict[str, list[str]]) -> dict[int, int]:
    """In how many documents each template word occurs, over all of ``docs(text)``."""
    hashes = np.unique(np.concatenate([np.zeros(0, np.uint64), *(_hashes(t) for ts in wordings.values() for t in ts)]))
    if not len(hashes):
        return {}
    counted = docs.mapInArrow(_vocabulary_rows(hashes), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"] % (1 << 64): r["n"] for r in counted.collect()}  # a row for each template word


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, list[str]] = TEMPLATES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """License phrases and notices of every whole text.

    Returns ``id_column``, ``n_words``, ``n_base`` (all places of phrases),
    ``first_word`` and ``last_word`` (their smallest and largest first word,
    counted from 0, else null), ``base_labels``, ``labels`` (with those of all
    templates that some block or stretch holds, but for one most of whose
    words another template has too that the block holds more of), ``score`` (1 with a phrase, else
    the largest share of a held template, else 0) and ``blocks``, the words of the
    blocks that hold a template and of wrapped notices: start word, end word, label, share. Null and
    empty texts have no words and no labels. One row per input row; other
    columns are not read.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    index = Templates.ordered(templates, word_frequency(rows, templates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            data, offsets = text_bytes(piece.column("text"))
            words = find_words(data, offsets, ALNUM)
            yield _scanned(piece, words, data, offsets, index)

    block = "array<struct<start_word: long, end_word: long, label: string, share: double>>"
    out = rows.mapInArrow(
        run,
        f"id {kind}, n_words long, n_base long, first_word long, last_word long, "
        f"base_labels string, labels string, score double, blocks {block}",
    )
    return out.withColumnRenamed("id", id_column)


_BLOCK = pa.list_(
    pa.struct([("start_word", pa.int64()), ("end_word", pa.int64()), ("label", pa.string()), ("share", pa.float64())])
)


def _scanned(piece: pa.RecordBatch, words: Words, data, offsets, index: Templates) -> pa.RecordBatch:
    n = piece.num_rows
    base: list[set[str]] = [set() for _ in range(n)]
    places: list[list[int]] = [[] for _ in range(n)]
    for label, starts in _phrase_starts(words):
        for at in starts.tolist():
            text = int(words.doc[at])
            base[text].add(label)
            places[text].append(at - int(words.first[text]))
    held: list[list[dict]] = [[] for _ in range(n)]
    labels = [set(b) for b in base]
    place = index.places(words.hash)
    known = place >= 0
    known[known] = index.in_prefix[place[known]]
    telling = np.cumsum(np.append(0, known))
    lines = find_words(data, offsets, _NOT_BREAK, lower=False)
    begin, end = blocks(words, lines, index.step)
    for k in np.flatnonzero(telling[end] > telling[begin]).tolist():
        own = place[begin[k] : end[k]]
        text = int(words.doc[begin[k]])
        found = index.held(np.unique(own[own >= 0]))
        share = {t: common / len(index.sets[t]) for t, common in found}
        # A template most of whose words another one has, of which more is there, is that other one.
        labels[text] |= {index.labels[t] for t in share if all(share.get(u, 0.0) <= share[t] for u in index.alike[t])}
        for t, common in found:
            held[text].append(
                {
                    "start_word": int(begin[k] - words.first[text]),
                    "end_word": int(end[k] - words.first[text]),
                    "label": index.labels[t],
                    "share": common / len(index.sets[t]),
                }
            )
    line = np.searchsorted(lines.start, words.start, "right")
    for first, last, t, common in stretches(words, place, known, index):
        text = int(words.doc[first])
        labels[text].add(index.labels[t])
        if line[first] == line[last - 1]:  # in a block already
            continue
        held[text].append(
            {
                "start_word": int(first - words.first[text]),
                "end_word": int(last - words.first[text]),
                "label": index.labels[t],
                "share": common / len(index.sets[t]),
            }
        )
    score = [1.0 if b else max((h["share"] for h in hs), default=0.0) for b, hs in zip(base, held)]
    return pa.RecordBatch.from_arrays(
        [
            piece.column("id"),
            pa.array(np.diff(words.first)),
            pa.array([len(p) for p in places], pa.int64()),
            pa.array([min(p) if p else None for p in places], pa.int64()),
            pa.array([max(p) if p else None for p in places], pa.int64()),
            pa.array([",".join(sorted(b)) for b in base]),
            pa.array([",".join(sorted(s)) for s in labels]),
            pa.array(score, pa.float64()),
            pa.array(held, _BLOCK),
        ],
        names=["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks"],
    )


def oracle() -> str:
    """The same result in SQL, but for stretches, by comparing every block with every template."""
    listed = ", ".join(
        f"({i}, '{label}', {sorted(set(text.replace('.', ' ').split()))})"
        for i, (label, text) in enumerate((label, text) for label, texts in sorted(TEMPLATES.items()) for text in texts)
    )
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    phrases = " UNION ALL ".join(
        f"SELECT doc_id, '{label}' AS label, unnest(list_filter(range(0, n_words), lambda i : "
        + " AND ".join(f"words[i + {k + 1}] = '{w}'" for k, w in enumerate(phrase.split()))
        + ")) AS place FROM worded"
        for phrase, label in PHRASES.items()
    )
    return f"""
WITH lowered AS (
    SELECT doc_id, translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS low FROM documents
), worded AS (
    SELECT doc_id, low, regexp_extract_all(low, '{word}') AS words, len(words) AS n_words FROM lowered
), places AS ({phrases}
), base AS (
    SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
           list_sort(list(DISTINCT label)) AS labels FROM places GROUP BY doc_id
), lines AS (
    SELECT doc_id, regexp_extract_all(line, '{word}') AS words
    FROM (SELECT doc_id, unnest(string_split(low, chr(10))) AS line FROM lowered)
), blocks AS (
    SELECT doc_id, row_number() OVER () AS block, list_distinct(words[begin + 1 : begin + {BLOCK_WORDS}]) AS words FROM (
        SELECT doc_id, words, unnest(CASE WHEN len(words) <= {BLOCK_WORDS} THEN [0]
            ELSE range(0, len(words) - {BLOCK_STEP}, {BLOCK_STEP}) END) AS begin FROM lines WHERE len(words) > 0)
), templates AS (
    SELECT * FROM (VALUES {listed}) AS t(template, label, needed)
), held AS (
    SELECT doc_id, block, template, label, len(list_intersect(words, needed)) / len(needed) AS share
    FROM blocks, templates
    WHERE 100 * len(list_intersect(words, needed)) >= {PERCENT} * len(needed)
), alike AS (
    SELECT a.template, b.template AS other FROM templates a, templates b
    WHERE a.template <> b.template AND 2 * len(list_intersect(a.needed, b.needed)) > len(a.needed)
), explained AS (
    SELECT h.block, h.template FROM held h JOIN alike USING (template)
    JOIN held o ON o.block = h.block AND o.template = alike.other AND o.share > h.share
), method AS (
    SELECT doc_id, list(DISTINCT label) FILTER (WHERE explained.block IS NULL) AS labels, max(share) AS share
    FROM held LEFT JOIN explained USING (block, template) GROUP BY doc_id
)
SELECT doc_id, n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(base.labels, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(base.labels, method.labels))), ','), '') AS labels,
       CASE WHEN base.labels IS NOT NULL THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM worded LEFT JOIN base USING (doc_id) LEFT JOIN method USING (doc_id)
"""
