"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is normalised the way the model asks (white space to U+2581, one put in
front) and cut before every run of U+2581 that follows something else: no piece
of the vocabulary spans such a place, which is checked when it is read.
Words not seen before by the worker are encoded together. Their symbols lie in
one flat array; each round looks up the rank of every neighbouring pair, takes
the smallest rank of each word by a segmented minimum, merges that pair
wherever it occurs in the word, leftmost first, and closes the gaps. The rounds
end when no pair of any word is in the vocabulary.

Merging all places of a pair at once gives the same result as one by one as
long as no piece ranks before a piece it is made of; where a piece breaks this,
or shares its rank, only the leftmost place of a word is merged in a round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textbuf import freed, pieces

SPACE = "▁"
#: Bytes of encoded words a task remembers, with as much of older ones; when full it starts anew.
REMEMBERED_BYTES = 32 << 20
#: Of each word, beside its characters and ids.
_WORD_BYTES = 300
_NONE = np.int64(1 << 40)


@dataclass
class Vocabulary:
    """Pieces with scores, as read from a SentencePiece BPE model."""

    texts: list[str]
    scores: list[float]
    byte_ids: list[int]  # id of each byte's piece
    normal: list[bool]  # pieces that a merge may make
    dummy_prefix: bool = True

    @classmethod
    def load(cls, model: bytes) -> Vocabulary:
        """The model must be a BPE with byte fallback and no text rewriting."""
        import sentencepiece

        reader = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = reader.get_piece_size()
        kinds = [reader.is_control(i) or reader.is_unknown(i) or reader.is_byte(i) for i in range(n)]
        if any(reader.is_unused(i) for i in range(n)):
            raise ValueError("models with unused pieces are not supported")
        probe = "Ａﬁ é  x"
        normal_form = reader.normalize(probe)
        if normal_form not in (probe.replace(" ", SPACE), SPACE + probe.replace(" ", SPACE)):
            raise ValueError("models that rewrite texts are not supported")
        byte_ids = [reader.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(reader.is_byte(i) for i in byte_ids):
            raise ValueError("models without byte fallback are not supported")
        return cls(
            [reader.id_to_piece(i) for i in range(n)],
            [reader.get_score(i) for i in range(n)],
            byte_ids,
            [not k for k in kinds],
            reader.encode("x", out_type=str)[0].startswith(SPACE),
        )

    @cached_property
    def symbols(self) -> dict[str, int]:
        """A number for each piece that merges may make, and for each character in one."""
        ids: dict[str, int] = {}
        for i, text in enumerate(self.texts):
            if self.normal[i]:
                for part in (text, *text):
                    ids.setdefault(part, len(ids))
        return ids

    @cached_property
    def silent(self) -> frozenset[int]:
        """Control pieces, which decode to nothing."""
        return frozenset(i for i, normal in enumerate(self.normal) if not normal and i not in self.byte_of)

    @cached_property
    def byte_of(self) -> dict[int, int]:
        return {i: b for b, i in enumerate(self.byte_ids)}

    @cached_property
    def merges(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted pair keys; the rank and symbol each pair makes; which ranks may merge everywhere."""
        symbols = self.symbols
        by_score = sorted({self.scores[i] for i in range(len(self.texts)) if self.normal[i]}, reverse=True)
        rank_of = {score: k for k, score in enumerate(by_score)}
        rank = {t: rank_of[self.scores[i]] for i, t in enumerate(self.texts) if self.normal[i]}
        shared = np.bincount(np.array(list(rank.values())), minlength=len(by_score)) > 1
        safe = ~shared
        keys, ranks, made = [], [], []
        base = len(symbols) + 1
        for text, r in rank.items():
            if SPACE in text.lstrip(SPACE):
                raise ValueError(f"a piece spans a word boundary: {text!r}")
            for cut in range(1, len(text)):
                left, right = text[:cut], text[cut:]
                if left in symbols and right in symbols:
                    keys.append(symbols[left] * base + symbols[right])
                    ranks.append(r)
                    made.append(symbols[text])
                    for part in (left, right):
                        if len(part) > 1 and rank[part] >= r:
                            safe[rank[part]] = False
        order = np.argsort(np.array(keys, np.int64))
        return (
            np.array(keys, np.int64)[order],
            np.array(ranks, np.int64)[order],
            np.array(made, np.int64)[order],
            safe,
        )


class Encoder:
    """Encodes words; keeps what it has encoded."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.symbols = vocabulary.symbols
        self.unknown = len(self.symbols)
        self.base = self.unknown + 1
        self.keys, self.ranks, self.made, self.safe = vocabulary.merges
        id_of = {t: i for i, t in enumerate(vocabulary.texts) if vocabulary.normal[i]}
        self.ids = np.array([*(id_of.get(t, -1) for t in self.symbols), -1], np.int64)
        self.code = np.full(0x110000, self.unknown, np.int32)  # symbol of each character
        for text, number in self.symbols.items():
            if len(text) == 1:
                self.code[ord(text)] = number
        self.space = self.symbols.get(SPACE, -1)
        self.space_runs = self._space_runs(id_of)
        self.decimal = [str(i) for i in range(len(vocabulary.texts))]
        self.seen: dict[str, tuple[str, int, str]] = {}
        self.older: dict[str, tuple[str, int, str]] = {}
        self.held = 0

    def _space_runs(self, id_of: dict[str, int]) -> list[list[int]]:
        """Ids of a run of n spaces for n up to L, where longer runs are cut
        into runs of L from the left; empty if the vocabulary is not like that.

        It is when all pieces of spaces share one score below all others, so
        that they merge last, each time at the leftmost place.
        """
        scores = {len(t): self.vocabulary.scores[i] for t, i in id_of.items() if set(t) == {SPACE} and len(t) > 1}
        others = [self.vocabulary.scores[i] for t, i in id_of.items() if set(t) != {SPACE} and len(t) > 1]
        if not scores or len(set(scores.values())) > 1 or next(iter(scores.values())) >= min(others, default=0):
            return []

        def cut(n: int) -> list[int]:
            lengths = [1] * n
            while True:
                at = next((i for i in range(len(lengths) - 1) if sum(lengths[i : i + 2]) in scores), None)
                if at is None:
                    return lengths
                lengths[at : at + 2] = [sum(lengths[at : at + 2])]

        longest = max(scores)
        if any(cut(longest + n) != [longest, *cut(n)] for n in range(2 * longest)):
            return []
        return [[id_of[SPACE * k] for k in cut(n)] for n in range(longest + 1)]

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and symbol of the piece that each pair makes."""
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        rank = np.where(self.keys[at] == key, self.ranks[at], _NONE)
        if self.space_runs:  # these merge after all others, see _slow_ids
            rank[(left == self.space) & (right == self.space)] = _NONE
        return rank, self.made[at]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Token ids of each word, by merge rounds over all of them at once."""
        char = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        if not len(char):
            return [[] for _ in words]
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        symbol = self.code[char].astype(np.int64)
        # rank[i] and made[i] belong to the pair of symbols i and i + 1
        rank, made = self._look_up(symbol, np.append(symbol[1:], self.unknown))
        rank[np.flatnonzero(np.diff(word, append=-1))] = _NONE
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(symbol):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            sizes = np.diff(first, append=len(word))
            least = np.minimum.reduceat(rank, first)
            ended = np.repeat(least == _NONE, sizes)
            if ended.any():  # words without a pair leave, the others go on
                done.append((word[ended], symbol[ended], char[ended]))
                symbol, char, word, rank, made = (x[~ended] for x in (symbol, char, word, rank, made))
                sizes, least = sizes[least < _NONE], least[least < _NONE]
                if not len(symbol):
                    break
            place = np.flatnonzero(rank == np.repeat(least, sizes))
            # Of places that touch, every other one from the left; of ranks
            # that are not safe, only a word's leftmost place.
            number = np.arange(len(place))
            run = np.maximum.accumulate(np.where(np.diff(place, prepend=-2) > 1, number, 0))
            leftmost = np.diff(word[place], prepend=-1) > 0
            place = place[((number - run) % 2 == 0) & (self.safe[rank[place]] | leftmost)]
            symbol[place] = made[place]
            keep = np.ones(len(symbol), bool)
            keep[place + 1] = False
            place = place - np.arange(len(place))
            symbol, char, word, rank, made = (x[keep] for x in (symbol, char, word, rank, made))
            changed = np.unique(np.concatenate([place, place - 1]))
            changed = changed[changed >= 0]
            right = np.minimum(changed + 1, len(symbol) - 1)
            rank[changed], made[changed] = self._look_up(symbol[changed], symbol[right])
            rank[changed[(word[changed] != word[right]) | (right == changed)]] = _NONE
        word = np.concatenate([d[0] for d in done])
        order = np.argsort(word, kind="stable")
        symbol = np.concatenate([d[1] for d in done])[order]
        char = np.concatenate([d[2] for d in done])[order]
        bounds = np.searchsorted(word[order], np.arange(len(words) + 1))
        ids = self.ids[symbol]
        odd = np.add.reduceat(np.append((ids < 0) | (symbol == self.space), False), bounds[:-1]) > 0
        slow = set(np.flatnonzero(odd).tolist())
        ids, bounds = ids.tolist(), bounds.tolist()
        return [
            self._slow_ids(symbol[a:b].tolist(), char[a:b].tolist()) if k in slow else ids[a:b]
            for k, (a, b) in enumerate(zip(bounds, bounds[1:]))
        ]

    def _slow_ids(self, symbols: list[int], chars: list[int]) -> list[int]:
        """Ids of a word that has characters without a piece, which become
        their bytes, or single spaces, whose runs become pieces of spaces."""
        out: list[int] = []
        at = 0
        while at < len(symbols):
            if symbols[at] == self.space and self.space_runs:
                to = at
                while to < len(symbols) and symbols[to] == self.space:
                    to += 1
                whole, rest = divmod(to - at, len(self.space_runs) - 1)
                out += self.space_runs[-1] * whole + self.space_runs[rest]
                at = to
                continue
            known = int(self.ids[symbols[at]])
            out += [known] if known >= 0 else [self.vocabulary.byte_ids[b] for b in chr(chars[at]).encode()]
            at += 1
        return out

    def learn(self, words: set[str]) -> None:
        """Have all the words in ``seen``: ids, their number, and their text."""
        if self.held > REMEMBERED_BYTES:
            self.older, self.seen, self.held = self.seen, {}, 0
        new = []
        for w in words:
            if w not in self.seen:
                if w in self.older:
                    self._keep(w, self.older[w])
                else:
                    new.append(w)
        decimal = self.decimal
        for at in range(0, len(new), 20_000):
            some = new[at : at + 20_000]
            for w, ids in zip(some, self.encode_words(some)):
                self._keep(w, (",".join([decimal[i] for i in ids]), len(ids), decode(self.vocabulary, ids, False)))

    def _keep(self, word: str, known: tuple[str, int, str]) -> None:
        self.seen[word] = known
        self.held += _WORD_BYTES + 4 * len(word) + len(known[0])

    def split(self, text: str) -> list[str]:
        """The normalised text cut before each space that follows something else."""
        if not text:
            return []
        text = text.replace(" ", SPACE)
        if self.vocabulary.dummy_prefix:
            text = SPACE + text
        parts = text.split(SPACE)
        if "" not in parts[1:-1] and parts[-1] and not parts[0]:  # no runs of spaces
            return [SPACE + p for p in parts[1:]]
        out, run = ([parts[0]] if parts[0] else []), 0
        for p in parts[1:]:
            run += 1
            if p:
                out.append(SPACE * run + p)
                run = 0
        return out + ([SPACE * run] if run else [])

    def encode(self, text: str) -> list[int]:
        words = self.split(text)
        self.learn(set(words))
        return [int(i) for w in words for i in self.seen[w][0].split(",")]


def _characters(data: bytes) -> str:
    """UTF-8, where each byte that begins no character becomes U+FFFD."""
    try:
        return data.decode()
    except UnicodeDecodeError as e:
        return data[: e.start].decode() + "\ufffd" + _characters(data[e.start + 1 :])


def decode(vocabulary: Vocabulary, ids: list[int], strip: bool = True) -> str:
    """The text of token ids: bytes joined to characters (broken ones become
    U+FFFD), U+2581 to spaces, the space put in front taken off."""
    byte_of, texts = vocabulary.byte_of, vocabulary.texts
    if byte_of.keys().isdisjoint(ids) and not vocabulary.silent.intersection(ids):
        text = "".join([texts[i] for i in ids])
    else:
        out: list[str] = []
        pending = bytearray()
        for i in [*ids, -1]:
            if i in byte_of:
                pending.append(byte_of[i])
                continue
            out.append(_characters(bytes(pending)))
            pending.clear()
            out.append("" if i < 0 or i in vocabulary.silent else texts[i])
        text = "".join(out)
    if strip and vocabulary.dummy_prefix and text.startswith(SPACE):
        text = text[1:]
    return text.replace(SPACE, " ")


def encode_decode(
    docs: DataFrame, model: bytes, id_column: str = "doc_id", text_column: str = "text", with_text: bool = True
) -> DataFrame:
    """Token ids of every whole text, and what they decode to.

    Returns ``id_column``, ``n_tokens``, ``ids_sha256`` (of the decimal ids
    joined by commas), ``decoded`` (only ``with_text``) and ``decoded_sha256``.
    One row per input row, repeated ids included; a null or empty text has no
    tokens. Other columns of ``docs`` are not read. Unicode lone surrogates
    cannot occur in Spark strings. The vocabulary is prepared on the driver;
    each task has a copy and remembers a bounded number of bytes of words.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    encoder = Encoder(Vocabulary.load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            texts = [t or "" for t in piece.column("text").to_pylist()]
            cut = [encoder.split(t) for t in texts]
            encoder.learn(set().union(*cut))
            numbers, hashes, decoded, decoded_hashes = [], [], [], []
            for words in cut:
                known = [encoder.seen[w] for w in words]
                numbers.append(sum(k[1] for k in known))
                hashes.append(hashlib.sha256(",".join([k[0] for k in known]).encode()).hexdigest())
                text = "".join([k[2] for k in known])
                text = text[1:] if encoder.vocabulary.dummy_prefix else text
                if with_text:
                    decoded.append(text)
                decoded_hashes.append(hashlib.sha256(text.encode()).hexdigest())
            out = {
                "id": piece.column("id"),
                "n_tokens": pa.array(numbers, pa.int64()),
                "ids_sha256": pa.array(hashes, pa.string()),
                **({"decoded": pa.array(decoded, pa.string())} if with_text else {}),
                "decoded_sha256": pa.array(decoded_hashes, pa.string()),
            }
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    chosen = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    shape = f"id {kind}, n_tokens long, ids_sha256 string, {'decoded string, ' if with_text else ''}decoded_sha256 string"
    return chosen.mapInArrow(freed(run), shape).withColumnRenamed("id", id_column)
