"""Toxicity: a support vector machine on a gapped subsequence string kernel.

Two words are alike in as far as they share subsequences of three to six
characters, where one or two foreign ones in between cost a factor each; word
ends are characters of their own. So an insult with other characters inserted, or with
another ending, stays close to it. The kernel is normalised to 1 for equal words.

Training takes a bounded sample of labelled texts. A text is a set of sentences
of words, and its label says that some word of some sentence is an insult.
Words that occur in toxic texts and hardly elsewhere are positive examples,
also with characters inserted; frequent and rare words of clean texts, treated
alike, are negative ones. Nyström features over landmark words turn the kernel
into a linear one, on which a squared-hinge SVM is solved by Newton steps. Its
margin for a word is a sum over the word's subsequences, divided by its length,
so that scoring needs no landmark. A sentence has the largest margin of its
words, a text the largest of its sentences; a logistic curve fitted to the
sample's texts makes it a score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.data import stored
from tidemark.llm.samples import fold, training_sample
from tidemark.llm.textbuf import draws, freed, give_back, mix, pieces

#: Labelled rows the model is fitted on at most.
SAMPLE_ROWS = 20_000
#: Example words of each kind, and landmarks, at most.
POSITIVE_WORDS, CLEAN_WORDS, LANDMARKS = 1_000, 2_000, 600
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
#: Margins a worker remembers; when full it starts anew.
REMEMBERED_WORDS = 200_000

DECAY = 0.6
#: Offsets of a subsequence's characters, and its weight: of three characters
#: with up to two others between, four with up to one, five and six with none.
PATTERNS = [
    ((0, *inner, size + gaps - 1), DECAY**gaps)
    for size, most in ((3, 2), (4, 1), (5, 0), (6, 0))
    for gaps in range(most + 1)
    for inner in combinations(range(1, size + gaps - 1), size - 2)
]
_MARK = draws(6, 91) | np.uint64(1)
#: What stands for the beginning and the end of a word.
BEGIN, END = "\x02", "\x03"
#: Characters that disguised insults have inside.
INSERTED = ".*-_"
#: Longer words are scored in windows of this many characters, half overlapping.
WINDOW = 64


def words_of(text: str) -> set[str]:
    """Lower-case words between white space, without marks around them.

    Three or more single characters in a row also count as one word.
    """
    parts = text.lower().split()
    out = {p.strip(punctuation) for p in set(parts)}
    run: list[str] = []
    if any(len(p) == 1 for p in parts):
        for p in [*parts, "  "]:
            if len(p) == 1:
                run.append(p)
            else:
                if len(run) > 2:
                    out.add("".join(run))
                run = []
    out.discard("")
    return out


def windows(word: str) -> list[str]:
    if len(word) <= WINDOW:
        return [word]
    return [word[k : k + WINDOW] for k in range(0, len(word) - WINDOW // 2, WINDOW // 2)]


def places(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word index, code and weight of each place of a subsequence in each word."""
    marked = [BEGIN + w + END for w in words]
    char = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), [len(m) for m in marked])
    owners, codes, weights = [], [], []
    with np.errstate(over="ignore"):
        for offsets, weight in PATTERNS:
            n = len(char) - offsets[-1]
            if n <= 0:
                continue
            inside = word[:n] == word[offsets[-1] :]
            code = np.full(n, len(offsets), np.uint64)
            for mark, at in zip(_MARK, offsets):
                code += char[at : at + n] * mark
            owners.append(word[:n][inside])
            codes.append(mix(code[inside]))
            weights.append(np.full(len(codes[-1]), weight))
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0)
    return np.concatenate(owners), np.concatenate(codes), np.concatenate(weights)


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word index, code and weight of each distinct subsequence of each word."""
    return _summed(*places(words))


def _summed(owner: np.ndarray, code: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(owner):
        return owner, code, weight
    # Equal subsequences of a word are summed. Sorting by a mixture of both
    # puts them side by side.
    with np.errstate(over="ignore"):
        both = code ^ mix(owner.astype(np.uint64) + np.uint64(1))
    order = np.argsort(both)
    first = np.flatnonzero(np.concatenate([[True], both[order][1:] != both[order][:-1]]))
    return owner[order][first], code[order][first], np.add.reduceat(weight[order], first)


def norms(owner: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    return np.sqrt(np.maximum(np.bincount(owner, weight**2, n), 1e-12))


def kernel(a: list[str], b: list[str]) -> np.ndarray:
    """Normalised kernel of each word of ``a`` with each of ``b``."""
    owner_b, code_b, weight_b = subsequences(b)
    out = np.zeros((len(a), len(b)))
    if not len(code_b):
        return out
    weight_b = weight_b / norms(owner_b, weight_b, len(b))[owner_b]
    # For each subsequence, the words of b that have it.
    order = np.argsort(code_b, kind="stable")
    owner_b, weight_b = owner_b[order], weight_b[order]
    table, begin, having = np.unique(code_b[order], return_index=True, return_counts=True)
    for at in range(0, len(a), 100):
        part = a[at : at + 100]
        owner, code, weight = subsequences(part)
        length = norms(owner, weight, len(part))
        where = np.minimum(np.searchsorted(table, code), len(table) - 1)
        hit = np.flatnonzero(table[where] == code)
        n = having[where[hit]]
        pair = np.repeat(hit, n)
        other = np.arange(len(pair)) + np.repeat(begin[where[hit]] - np.cumsum(n) + n, n)
        cell = owner[pair] * len(b) + owner_b[other]
        sums = np.bincount(cell, weight[pair] * weight_b[other], len(part) * len(b))
        out[at : at + len(part)] = sums.reshape(len(part), len(b)) / length[:, None]
    return out


@dataclass
class WordModel:
    """Weights of subsequences (sorted codes), the margin's offset, the curve."""

    codes: np.ndarray
    weights: np.ndarray
    offset: float
    slope: float = 1.0
    shift: float = 0.0

    def margins(self, words: list[str]) -> np.ndarray:
        """Of each word; of a long one the largest of its windows.

        A word more unlike than like the insults has the offset, whatever its
        length, so that only the others' lengths are worked out.
        """
        parts = [windows(w) for w in words]
        flat = [p for ps in parts for p in ps]
        owner, code, weight = places(flat)
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        value = np.where(self.codes[at] == code, self.weights[at], 0.0) * weight
        total = np.bincount(owner, value, len(flat))
        some = (total > 0)[owner]
        owner, _, weight = _summed(owner[some], code[some], weight[some])
        margin = np.maximum(total, 0) / norms(owner, weight, len(flat)) + self.offset
        first = np.cumsum([0, *(len(p) for p in parts)])[:-1]
        return np.maximum.reduceat(margin, first) if len(flat) else np.zeros(0)

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))


def disguised(word: str) -> list[str]:
    """The word with characters inserted: between all letters, and at one place."""
    if len(word) < 4:
        return []
    half = len(word) // 2
    return [INSERTED[0].join(word), INSERTED[2].join(word)] + [word[:half] + c + word[half:] for c in INSERTED[:2]]


def fit_words(positive: list[tuple[str, float]], negative: list[tuple[str, float]], ridge: float = 0.01) -> WordModel:
    """The SVM on example words with weights, the most telling ones first."""
    examples = [(w, 1.0, 4 * v) for w, v in positive] + [(d, 1.0, v) for w, v in positive for d in disguised(w)]
    examples += [(w, -1.0, v) for w, v in negative]
    examples += [(d, -1.0, v / 4) for w, v in negative[:1000] for d in disguised(w)]
    if not positive or not negative:
        return WordModel(np.zeros(1, np.uint64), np.zeros(1), 0.0)
    landmarks = [w for w, _ in positive][: LANDMARKS // 2]
    landmarks += [w for w, _ in negative][: LANDMARKS - len(landmarks)]
    among = kernel(landmarks, landmarks)
    values, vectors = np.linalg.eigh(among)
    kept = values > 1e-6 * values.max()
    root = vectors[:, kept] / np.sqrt(values[kept])
    x = kernel([e[0] for e in examples], landmarks) @ root
    x = np.hstack([x, np.ones((len(x), 1))])
    y = np.array([e[1] for e in examples])
    c = np.array([e[2] for e in examples])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-3
    for _ in range(30):
        left, right = np.diag(penalty), np.zeros(len(w))
        for at in range(0, len(x), 2_000):  # so that no further copy of all examples is made
            some = slice(at, at + 2_000)
            active = y[some] * (x[some] @ w) < 1
            xa = x[some][active]
            xc = xa * c[some][active][:, None]
            left = left + xc.T @ xa
            right += xc.T @ y[some][active]
        new = np.linalg.solve(left, right)
        if np.abs(new - w).max() < 1e-6:
            break
        w = (w + new) / 2 if _ % 3 == 2 else new
    alpha = root @ w[:-1]
    owner, code, weight = subsequences(landmarks)
    value = weight * alpha[owner] / norms(owner, weight, len(landmarks))[owner]
    codes, place = np.unique(code, return_inverse=True)
    return WordModel(codes, np.bincount(place, value), float(w[-1]))


def fit_curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve whose threshold errs least.

    The slope comes from Newton steps with a small ridge. The margin that gets
    the score ``THRESHOLD`` lies in the middle of where the sample has the
    fewest errors, a missed toxic text counting twice.
    """
    if not len(y):
        return 1.0, 0.0
    x = np.stack([margins, np.ones(len(y))], axis=1)
    w = np.array([1.0, 0.0])
    target = (y * (y.sum() + 1) + (1 - y) * 1) / np.where(y > 0, y.sum() + 2, (1 - y).sum() + 2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (target - p) - 1e-3 * w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    slope = max(float(w[0]), 1e-3)
    if not 0 < y.sum() < len(y):
        return slope, float(w[1])
    order = np.argsort(margins, kind="stable")
    m, toxic = margins[order], y[order]
    missed = np.concatenate([[0], np.cumsum(toxic)])  # with so many texts below the cut
    flagged = np.concatenate([np.cumsum((1 - toxic)[::-1])[::-1], [0]])
    ends = np.concatenate([[m[0] - 2], m, [m[-1] + 2]])
    errors = np.where(ends[1:] > ends[:-1], 2 * missed + flagged, np.inf)
    best = np.flatnonzero(errors == errors.min())
    cut = (ends[best[0]] + ends[best[-1] + 1]) / 2
    return slope, float(np.log(THRESHOLD / (1 - THRESHOLD)) - slope * cut)


def _sketch(words: set[str]) -> int:
    """Two minimum hashes of the long words; the same for most copies with small changes."""
    long = [w for w in words if len(w) > 7] or list(words)
    least = [min((zlib.crc32(w.encode("utf-8", "replace"), seed) for w in long), default=0) for seed in (1, 2)]
    return least[0] << 31 | least[1]


def _word_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of each labelled text, and what tells copies."""
    for piece in pieces(batches):
        sets = [{w for w in words_of(t or "") if len(w) <= WINDOW} for t in piece.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                piece.column("label"),
                pa.array([_sketch(s) for s in sets], pa.int64()),
                pa.array([sorted(s) for s in sets], pa.list_(pa.string())),
            ],
            names=["label", "sketch", "words"],
        )


class _Margins:
    """The largest margin of a text's words; remembers words."""

    def __init__(self, model: WordModel):
        self.model = model
        self.seen: dict[str, float] = {}

    def of(self, texts: Iterable[str | None]) -> np.ndarray:
        sets = [words_of(t or "") for t in texts]
        if len(self.seen) > REMEMBERED_WORDS:
            self.seen.clear()
        new = list(set().union(*sets) - self.seen.keys())
        for at in range(0, len(new), 5_000):  # some kilobytes a word while it is worked out
            some = new[at : at + 5_000]
            self.seen.update(zip(some, self.model.margins(some).tolist()))
        lowest = self.model.offset - 1.0
        return np.array([max((self.seen[w] for w in s), default=lowest) for s in sets], np.float64)


def with_margins(docs: DataFrame, model: WordModel, whole: bool = False) -> DataFrame:
    """The columns of ``docs`` and ``margin``; ``text`` is kept only if it is one ``whole`` word."""
    kept = [c for c in docs.columns if c != "text" or whole]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margins = _Margins(model)
        for piece in pieces(batches):
            texts = piece.column("text").to_pylist()
            values = model.margins(texts) if whole else margins.of(texts)
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in kept), pa.array(values)], names=[*kept, "margin"])

    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept), "margin double"])
    return docs.mapInArrow(freed(run), schema)


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> WordModel:
    """The model of a bounded sample of labelled texts, held-out fold left out."""
    sample = training_sample(labels, "toxic", FOLDS, HELD_OUT, sample_rows)
    # A part of the sample is kept for the curve: its words are no examples.
    for_curve = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit("curve"))) % 4 == 0
    chosen = docs.join(F.broadcast(sample), docs["id"] == sample["doc_id"])
    texts = stored(chosen.select("text", "label", for_curve.alias("for_curve")))
    sums = texts.agg(F.sum("label").alias("toxic"), F.count("*").alias("n")).first()
    toxic, n = sums["toxic"] or 0, sums["n"]
    if not 0 < toxic < n:
        model = WordModel(np.zeros(1, np.uint64), np.zeros(1), 0.0)
        share = (toxic + 1) / (n + 2)
        model.slope, model.shift = 1e-3, float(np.log(share / (1 - share)))
        return model
    # Of copies one text counts, else any word of a copied text looks like an insult.
    sets = texts.filter("NOT for_curve").select("text", "label").mapInArrow(freed(_word_sets), "label int, sketch long, words array<string>")
    once = sets.groupBy("label", "sketch").agg(F.min("words").alias("words"))
    words = stored(
        once.select("label", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
    )
    # How much more often in toxic texts, with half a text of each kind added.
    ratio = F.log((F.col("a") + 0.5) / (toxic + 1)) - F.log((F.col("b") + 0.5) / (n - toxic + 1))
    apart = words.withColumn("gain", F.col("a") * ratio)
    # So that few words pass by chance, however many there are.
    least = 3 + float(np.log(max(words.count(), 1)))
    positive = apart.filter((F.col("a") >= 3) & (ratio > 1.5) & (F.col("gain") > least))
    positive = positive.orderBy(F.desc("gain"), "word").limit(POSITIVE_WORDS).select("word", "a").collect()
    clean = stored(apart.filter((F.col("b") > 0) & (ratio < 0.5)).select("word", "b"))
    frequent = clean.orderBy(F.desc("b"), "word").limit(CLEAN_WORDS).collect()
    rare = clean.orderBy(F.xxhash64("word"), "word").limit(CLEAN_WORDS).collect()
    positives = [(r["word"], 1.0 + float(np.log(r["a"]))) for r in positive]
    # Frequent and rare words take turns, so that landmarks have both.
    turns = {r["word"]: 1.0 + float(np.log(r["b"])) for pair in zip(frequent, rare) for r in pair}
    model = fit_words(positives, list(turns.items()))
    for _ in range(4):  # clean words that come out too high become examples
        margins = with_margins(clean.select(F.col("word").alias("text"), "b"), model, whole=True)
        high = margins.filter("margin > -0.5").orderBy(F.desc("margin"), "text").limit(CLEAN_WORDS).collect()
        hard = {r["text"]: turns.get(r["text"], 0.0) + 1.0 + float(np.log(r["b"])) for r in high}
        turns = {**hard, **{w: v for w, v in turns.items() if w not in hard}}
        model = fit_words(positives, list(turns.items()))
    rows = with_margins(texts.filter("for_curve").select("text", "label"), model).collect()  # two numbers for each text
    rows.sort(key=tuple)
    margins, y = np.array([r["margin"] for r in rows]), np.array([r["label"] for r in rows], np.float64)
    model.slope, model.shift = fit_curve(margins, y)
    give_back()
    return model


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id_column``, ``held_out``, ``score`` (higher: toxic 1 is likelier) and ``predicted``.

    One row per input row. Null and empty texts have the margin of no word.
    Rows without an id are scored and never held out or learned from. Where the
    sample has one label only, or no row, all scores are near its smoothed
    share. Only the text is an input of the score.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    model = fit_toxicity(rows, labels)
    scored = with_margins(rows, model)
    margin = F.col("margin") * model.slope + model.shift
    held_out = F.coalesce(fold("id", FOLDS) == HELD_OUT, F.lit(False))
    scored = scored.select(
        F.col("id").alias(id_column), held_out.alias("held_out"), (1 / (1 + F.exp(-margin))).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def filter_toxic(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not flagged, all columns kept.

    Each row is judged by its own text in the same pass, so that no text moves.

    Null and empty texts have the margin of no word. Rows without an id and
    repeated rows are judged each by their own text; an empty table stays empty.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    model = fit_toxicity(rows, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margins = _Margins(model)
        for piece in pieces(batches, text_column):
            score = model.score(margins.of(piece.column(text_column).to_pylist()))
            yield piece.filter(pa.array(score < THRESHOLD))

    return docs.mapInArrow(freed(run), docs.schema)
