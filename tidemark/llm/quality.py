"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of whole texts are counted on their bytes. Boosted trees over a
bounded sample of labelled documents give rules, the conjunctions on the way
to each node; a logistic regression with a lasso penalty keeps few of them;
these are compiled to one Spark column expression that scores all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.data import stored
from tidemark.llm.samples import fold, training_sample
from tidemark.llm.textbuf import NOT_SPACE, find_words, freed, pieces, text_bytes
from tidemark.llm.trees import Condition, boost, paths

#: Labelled rows the model is fitted on at most.
SAMPLE_ROWS = 20_000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3

STATISTICS = (
    "log_words",
    "mean_word",
    "long_words",
    "symbols",
    "marks",
    "digits",
    "capitals",
    "non_ascii",
    "pipes",
    "exclamations",
    "symbol_words",
    "capital_words",
    "repeated_next",
    "distinct_words",
    "top_word",
    "words_per_line",
    "repeated_lines",
    "lines_per_word",
    "words_per_stop",
    "single_letters",
)


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL = _table(b"#$%&*+<=>@[\\]^_`{|}~/")
_MARK = _table(b".,;:!?'\"()-")
_DIGIT = _table(b"0123456789")
_CAPITAL = _table(bytes(range(65, 91)))
_LETTER = _table(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
_HEAD = ~_table(bytes(range(128, 192)))  # bytes that begin a character
_STOP = _table(b".!?")


def statistics(column: pa.Array) -> np.ndarray:
    """Rows by STATISTICS; all zero for null, empty and blank texts."""
    data, offsets = text_bytes(column)
    texts = len(offsets) - 1
    out = np.zeros((texts, len(STATISTICS)))
    if not len(data):
        return out
    words = find_words(data, offsets, NOT_SPACE, lower=False)

    def counted(table: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])
        return total

    def by_text(total: np.ndarray) -> np.ndarray:
        return total[offsets[1:]] - total[offsets[:-1]]

    def by_word(total: np.ndarray) -> np.ndarray:
        return total[words.end] - total[words.start]

    def summed(per_word: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(per_word, dtype=np.int64)])
        return total[words.first[1:]] - total[words.first[:-1]]

    heads, symbols, letters, capitals = (counted(t) for t in (_HEAD, _SYMBOL, _LETTER, _CAPITAL))
    chars = np.maximum(by_text(heads), 1)
    n = np.diff(words.first)
    some = np.maximum(n, 1)
    length = by_word(heads)
    symbol_words = by_word(symbols) > 0
    capital_words = (by_word(capitals) > 1) & (by_word(capitals) >= by_word(letters))
    same_text = words.doc[1:] == words.doc[:-1]
    repeated = np.concatenate([[False], (words.hash[1:] == words.hash[:-1]) & same_text])
    pipe, exclamation, stop = (counted(t) for t in (_table(b"|"), _table(b"!"), _STOP))
    lines = find_words(data, offsets, ~_table(b"\n"), lower=False)
    n_lines = np.diff(lines.first)
    columns = [
        np.log1p(n),
        summed(length) / some,
        summed(length > 15) / some,
        by_text(symbols) / chars,
        by_text(counted(_MARK)) / chars,
        by_text(counted(_DIGIT)) / chars,
        by_text(capitals) / np.maximum(by_text(letters), 1),
        (by_text(heads) - by_text(counted(_table(bytes(range(128)))))) / chars,
        by_text(pipe) / some,
        by_text(exclamation) / some,
        summed(symbol_words) / some,
        summed(capital_words) / some,
        summed(repeated) / some,
    ]
    distinct, top, repeated_lines = np.zeros(texts), np.zeros(texts), np.zeros(texts)
    for i in range(texts):
        if n[i]:
            counts = np.unique(words.hash[words.first[i] : words.first[i + 1]], return_counts=True)[1]
            distinct[i], top[i] = len(counts) / n[i], counts.max() / n[i]
        if n_lines[i] > 1:
            repeated_lines[i] = 1 - len(np.unique(lines.hash[lines.first[i] : lines.first[i + 1]])) / n_lines[i]
    columns += [
        distinct,
        top,
        n / np.maximum(n_lines, 1),
        repeated_lines,
        n_lines / some,
        n / np.maximum(by_text(stop), 1),
        summed(length == 1) / some,
    ]
    out = np.stack(columns, axis=1).astype(np.float64)
    out[n == 0] = 0
    return out


def with_statistics(docs: DataFrame) -> DataFrame:
    """``id`` and the statistics of ``docs(id, text)``."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            values = statistics(piece.column("text"))
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), *(pa.array(values[:, k].copy()) for k in range(len(STATISTICS)))],
                names=["id", *STATISTICS],
            )

    return docs.mapInArrow(freed(run), ", ".join([f"id {kind}", *(f"{s} double" for s in STATISTICS)]))


@dataclass
class RuleModel:
    """Rules with their weights; ``intercept`` alone where no rule holds."""

    intercept: float
    rules: list[tuple[tuple[Condition, ...], float]]

    def column(self) -> Column:
        """The score as an expression over the statistics."""
        margin = F.lit(self.intercept)
        for rule, weight in self.rules:
            holds = F.lit(True)
            for feature, above, threshold in rule:
                value = F.col(STATISTICS[feature])
                holds = holds & (value > threshold if above else value <= threshold)
            margin = margin + F.when(holds, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-margin))

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The same for rows of statistics."""
        margin = np.full(len(x), self.intercept)
        for rule, weight in self.rules:
            margin += weight * holds(rule, x)
        return 1 / (1 + np.exp(-margin))

    def text(self) -> list[str]:
        """The rules, readable."""
        return [
            " and ".join(f"{STATISTICS[f]} {'>' if above else '<='} {t:.4g}" for f, above, t in rule) + f": {w:+.3f}"
            for rule, w in self.rules
        ]


def holds(rule: tuple[Condition, ...], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for feature, above, threshold in rule:
        out &= (x[:, feature] > threshold) == above
    return out


def fit_rules(x: np.ndarray, y: np.ndarray, penalty: float = 2e-3, steps: int = 400) -> RuleModel:
    """Rules from boosted trees, weighted by a lasso logistic regression.

    Proximal gradient steps with momentum. Without rows the score is 0.5; with
    one class only, its smoothed share.
    """
    start, trees = boost(x, y, rounds=25, depth=3)
    rules = sorted({rule for tree in trees for rule in paths(tree)})
    if not rules:
        return RuleModel(start, [])
    a = np.stack([holds(rule, x) for rule in rules], axis=1).astype(np.float64)
    mean, scale = a.mean(axis=0), a.std(axis=0)
    rules = [r for r, s in zip(rules, scale) if s > 0]
    a = (a[:, scale > 0] - mean[scale > 0]) / scale[scale > 0]
    mean, scale = mean[scale > 0], scale[scale > 0]
    n = len(y)
    rate = 4 * n / (np.linalg.norm(a, 2) ** 2 + n)
    w, b = np.zeros(a.shape[1]), start
    at_w, at_b, t = w, b, 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(a @ at_w + at_b))) - y
        new = at_w - rate * (a.T @ error) / n
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        new_b = at_b - rate * error.mean()
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        at_w, at_b = new + (before - 1) / t * (new - w), new_b + (before - 1) / t * (new_b - b)
        w, b = new, new_b
    kept = [(rule, float(v / s)) for rule, v, s in zip(rules, w, scale) if v != 0]
    return RuleModel(float(b - (w * mean / scale).sum()), kept)


def fit_quality(stats: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> RuleModel:
    """The model of a bounded sample of labelled documents, held-out fold left out."""
    sample = training_sample(labels, "quality", FOLDS, HELD_OUT, sample_rows)
    joined = stats.join(F.broadcast(sample), stats["id"] == sample["doc_id"])
    # Documents that share an id all count; their number is bounded by a last limit.
    # Where ids repeat, which rows are taken depends on what they hold, not on their order.
    sample = joined.select("id", *STATISTICS, "label").orderBy(F.xxhash64("id"), "id", *STATISTICS)
    rows = sample.limit(sample_rows).collect()
    rows.sort(key=tuple)
    x = np.array([r[1:-1] for r in rows], np.float64).reshape(len(rows), len(STATISTICS))
    return fit_rules(x, np.array([r[-1] for r in rows], np.float64))


def score_quality(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id_column``, ``held_out``, ``score`` (higher: quality 1 is likelier) and ``predicted``.

    One row per input row. Null, empty and blank texts have all statistics 0
    and are scored by the same rules. Rows without an id are scored and never
    held out or learned from. Only the text is an input of the score.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    stats = stored(with_statistics(rows.select("id", "text")))
    model = fit_quality(stats, labels)
    held_out = F.coalesce(fold("id", FOLDS) == HELD_OUT, F.lit(False))
    scored = stats.select(F.col("id").alias(id_column), held_out.alias("held_out"), model.column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def filter_quality(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns kept.

    Each row is judged by its own text in the same pass, so that no text moves.

    Null and empty texts are judged like others, by the statistics of no words.
    Rows without an id and repeated rows are judged each by their own text. Of
    no rows, none are returned; without a usable label all scores are equal.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    model = fit_quality(stored(with_statistics(rows)), labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text_column):
            yield piece.filter(pa.array(model.scores(statistics(piece.column(text_column))) >= THRESHOLD))

    return docs.mapInArrow(freed(run), docs.schema)
