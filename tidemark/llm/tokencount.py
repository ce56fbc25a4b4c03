"""Token counts by a finite-state transducer compiled from a SentencePiece BPE.

A sequence of pieces is what BPE makes of its text if and only if each two
neighbours are what BPE makes of theirs: merges run in the order of rank and
place, and that order, seen on two neighbours only, is the order in which they
are merged alone. So every beginning of a text has one last piece, found from
the last pieces of shorter beginnings, and BPE is a deterministic transducer
over characters:

* a state is the longest end of what was read that some piece begins with (a
  node of a trie with failure links) and, for each place inside it where a piece
  may still begin, the piece that ends there and the tokens up to there;
* a transition emits by how much the number of tokens changes.

``Transducer`` holds what follows from the vocabulary alone: trie, failure
links, and for each piece how its edges change while it is merged, from which
two pieces are found to be neighbours or not. ``Machine`` determines states and
transitions when they are first met, many at a time, and keeps the transitions
in a table of fixed size; one that was overwritten is worked out again.

Texts are read in blocks of characters, whatever their length. A block is cut
into chunks, which run side by side. A chunk that begins where no piece can
reach across has one state to start from. Any other starts from the state that
the characters before it lead to, and its map is extended by the states in
which the chunk before it is found to end. A map takes each state a chunk was
started from to its end state; maps are composed by a prefix scan, which tells
each chunk's true start, until that is among the states of its map.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.sentencepiece import SPACE, Vocabulary
from tidemark.llm.textbuf import draws, freed, mix, pieces

#: Characters run through at once, and of a chunk.
BLOCK, CHUNK = 1 << 21, 256
#: From so many characters before a chunk its first state is guessed.
LOOK_BACK = 48
#: A machine with more states than this starts anew at the next block.
KEPT_STATES = 1 << 18
#: Bits that number the places of the tables of states and of transitions.
STATE_BITS, STEP_BITS = 20, 21
_NEVER = np.int64(1 << 40)
_RESET = 5  # codes 1 to 4: characters without a piece, by their bytes; 5: a text begins


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each value stands in the sorted ``keys``, and whether it does."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass
class Transducer:
    """What the vocabulary alone determines. Piece 0 is none, node 0 the root."""

    characters: np.ndarray  # code points of characters in pieces; code 6 and up in this order
    prefix: bool  # a space is put in front of every text
    cost: np.ndarray  # tokens that a piece counts for
    child_keys: np.ndarray  # node * codes + code, sorted
    child: np.ndarray
    fail: np.ndarray
    depth: np.ndarray
    piece: np.ndarray  # of a node that is a piece, else 0
    shorter: np.ndarray  # next node up the failure links that is a piece, or 0
    open: np.ndarray  # per node, after which of its beginnings a piece may begin that is not over
    at: np.ndarray  # where a piece's steps begin in the next three
    left: np.ndarray
    right: np.ndarray
    rank: np.ndarray  # of the next merge inside
    pair_keys: np.ndarray  # left * pieces + right, sorted
    pair_rank: np.ndarray
    reach: np.ndarray  # piece * codes + code, sorted: it merges with something that begins so
    touching: np.ndarray  # code * codes + code, sorted: neighbours in some piece

    @property
    def codes(self) -> int:
        return len(self.characters) + 6

    @classmethod
    def compile(cls, vocabulary: Vocabulary) -> Transducer:
        normal = {t: -vocabulary.scores[i] for i, t in enumerate(vocabulary.texts) if vocabulary.normal[i]}
        order = {score: k for k, score in enumerate(sorted(set(normal.values())))}
        rank = {t: order[score] for t, score in normal.items()}
        characters = sorted({c for t in normal for c in t})
        code = {c: 6 + k for k, c in enumerate(characters)}
        codes = len(characters) + 6
        # Characters without a piece of their own count for their bytes.
        steps = {c: [(c, c, int(_NEVER))] for c in characters}
        steps |= {t: s for t in normal if len(t) > 1 and (s := _merged(t, rank)) is not None}
        number = {t: 1 + k for k, t in enumerate(steps)}
        count = len(number) + 1
        nodes = {"": 0}
        for t in steps:
            for k in range(1, len(t) + 1):
                nodes.setdefault(t[:k], len(nodes))
        child_keys, child = [], []
        fail, depth, piece, shorter = (np.zeros(len(nodes), np.int64) for _ in range(4))
        open_ = np.zeros((len(nodes), max(map(len, nodes)) + 2), bool)
        open_[0, 0] = True
        for t, n in sorted(nodes.items(), key=lambda x: len(x[0])):
            if not t:
                continue
            child_keys.append(nodes[t[:-1]] * codes + code[t[-1]])
            child.append(n)
            depth[n], piece[n] = len(t), number.get(t, 0)
            fail[n] = next(nodes[t[k:]] for k in range(1, len(t) + 1) if t[k:] in nodes)
            shorter[n] = fail[n] if piece[fail[n]] else shorter[fail[n]]
            inside = len(t) - depth[fail[n]]
            open_[n, inside:] = open_[fail[n], : open_.shape[1] - inside]
            open_[n, 0] = True
        pairs, reach = {}, set()
        for t in normal:
            for k in range(1, len(t)):
                a, b = number.get(t[:k]), number.get(t[k:])
                if a and b:
                    pairs[a * count + b] = rank[t]
                    reach.add(a * codes + code[t[k]])
        flat = [s for one in steps.values() for s in one]
        by_child, pair_keys = np.argsort(child_keys), np.array(sorted(pairs), np.int64)
        return cls(
            characters=np.array([ord(c) for c in characters], np.int64),
            prefix=vocabulary.dummy_prefix,
            cost=np.array([0, *(1 if t in normal else len(t.encode()) for t in steps)], np.int64),
            child_keys=np.array(child_keys, np.int64)[by_child],
            child=np.array(child, np.int64)[by_child],
            fail=fail,
            depth=depth,
            piece=piece,
            shorter=shorter,
            open=open_,
            at=np.cumsum([0, 0, *(len(one) for one in steps.values())])[:-1],
            left=np.array([number[s[0]] for s in flat], np.int64),
            right=np.array([number[s[1]] for s in flat], np.int64),
            rank=np.array([s[2] for s in flat], np.int64),
            pair_keys=pair_keys,
            pair_rank=np.array([pairs[k] for k in pair_keys.tolist()], np.int64),
            reach=np.array(sorted(reach), np.int64),
            touching=np.array(sorted({code[a] * codes + code[b] for t in normal for a, b in zip(t, t[1:])}), np.int64),
        )

    def encode_characters(self) -> np.ndarray:
        """The code of every code point."""
        table = np.full(0x110000, 4, np.int32)
        table[:0x10000], table[:0x800], table[:0x80] = 3, 2, 1
        table[self.characters] = np.arange(6, self.codes)
        table[0x20] = table[ord(SPACE)]
        return table

    def step(self, node: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of known characters: the node after each, and which end of the old node it extends."""
        at, found = _find(self.child_keys, node * self.codes + code)
        old = node.copy()
        while not found.all():
            missing = np.flatnonzero(~found)
            old[missing] = self.fail[old[missing]]
            at[missing], found[missing] = _find(self.child_keys, old[missing] * self.codes + code[missing])
        return self.child[at], old

    def neighbours(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether BPE leaves each two pieces as they are; next to none, all do."""
        out = np.ones(len(left), bool)
        open_ = np.flatnonzero(left > 0)
        i, j = self.at[left[open_]], self.at[right[open_]]
        while len(open_):
            key = self.right[i] * len(self.cost) + self.left[j]
            at, found = _find(self.pair_keys, key)
            across = np.where(found, self.pair_rank[at], _NEVER)
            a, b = self.rank[i], self.rank[j]
            merged = (across < a) & (across <= b)
            out[open_[merged]] = False
            go = ~merged & ((a < _NEVER) | (b < _NEVER))
            first = (a <= b)[go]
            open_, i, j = open_[go], i[go] + first, j[go] + ~first
        return out

    def apart(self, piece: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Whether no state of a piece's right edge merges with anything that begins so."""
        out = np.ones(len(piece), bool)
        open_ = np.flatnonzero(piece > 0)
        at = self.at[piece[open_]]
        while len(open_):
            reaches = _find(self.reach, self.right[at] * self.codes + code[open_])[1]
            out[open_[reaches]] = False
            go = ~reaches & (self.rank[at] < _NEVER)
            open_, at = open_[go], at[go] + 1
        return out


def _merged(text: str, rank: dict[str, int]) -> list[tuple[str, str, int]] | None:
    """Left and right edge and next rank at each step of merging a piece; None if it does not result."""
    parts, out = list(text), []
    while len(parts) > 1:
        best, k = min((rank.get(a + b, int(_NEVER)), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
        if best == _NEVER:
            return None
        out.append((parts[0], parts[-1], best))
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    return [*out, (text, text, int(_NEVER))]


class Machine:
    """States and transitions met so far. State 0 is where nothing reaches across."""

    def __init__(self, compiled: Transducer):
        self.t = compiled
        self.code = compiled.encode_characters()
        self.width = compiled.open.shape[1]
        self._steps = draws(2 * self.width + 1, 7) | np.uint64(1)
        self._clear()

    def _clear(self) -> None:
        self.states = 1
        self.node = np.zeros(1 << 12, np.int32)
        # After each open beginning of the node: the last piece (0 where it does
        # not matter), and tokens since the node began.
        self.last = np.zeros((1 << 12, self.width), np.int32)
        self.tokens = np.zeros((1 << 12, self.width), np.int16)
        self.slot = np.zeros(1 << STATE_BITS, np.int32)
        self.keys = np.full(1 << STEP_BITS, -1, np.int64)
        self.next = np.zeros(1 << STEP_BITS, np.int32)
        self.emits = np.zeros(1 << STEP_BITS, np.int16)

    def _state(self, node: np.ndarray, last: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Numbers of states; one that is not found gets a new number."""
        hashed = node.astype(np.uint64) * self._steps[-1]
        hashed += (last.astype(np.uint64) * self._steps[: self.width]).sum(1, dtype=np.uint64)
        hashed += (tokens.astype(np.uint64) * self._steps[self.width : -1]).sum(1, dtype=np.uint64)
        slot = (mix(hashed) >> np.uint64(64 - STATE_BITS)).astype(np.int64)
        number = self.slot[slot].astype(np.int64)
        same = (self.node[number] == node) & (self.last[number] == last).all(1) & (self.tokens[number] == tokens).all(1)
        new = np.flatnonzero(~same)
        while self.states + len(new) > len(self.node):
            self.node, self.last, self.tokens = (
                np.concatenate([x, np.zeros_like(x)]) for x in (self.node, self.last, self.tokens)
            )
        made = self.states + np.arange(len(new))
        self.states += len(new)
        number[new] = self.slot[slot[new]] = made
        self.node[made], self.last[made], self.tokens[made] = node[new], last[new], tokens[new]
        return number

    def _work_out(self, state: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next state and tokens emitted, from the vocabulary."""
        t = self.t
        out = np.zeros(len(state), np.int64)
        emits = np.where(code < _RESET, code, 0)
        known = np.flatnonzero(code > _RESET)
        state, code = state[known], code[known]
        rows = np.arange(len(state))
        old_node = self.node[state].astype(np.int64)
        old_depth = t.depth[old_node]
        last, tokens = self.last[state], self.tokens[state]
        total = tokens[rows, old_depth].astype(np.int64)
        ending = last[rows, old_depth].astype(np.int64)
        last[rows, old_depth] = np.where(t.apart(ending, code), 0, ending)
        node, kept = t.step(old_node, code)
        columns = (old_depth - t.depth[kept])[:, None] + np.arange(self.width)
        inside = columns < self.width
        columns = np.minimum(columns, self.width - 1)
        last = np.where(inside, np.take_along_axis(last, columns, 1), 0)
        tokens = np.where(inside, np.take_along_axis(tokens, columns, 1), 0)
        before = tokens[:, 0].astype(np.int64)
        depth = t.depth[node]
        end = np.where(t.piece[node] > 0, node, t.shorter[node])
        open_ = rows
        while len(open_):  # the longest piece that fits what stands before it; one does
            e = end[open_]
            begin = depth[open_] - t.depth[e]
            fits = t.neighbours(last[open_, begin].astype(np.int64), t.piece[e])
            done, e, begin = open_[fits], e[fits], begin[fits]
            last[done, depth[done]] = t.piece[e]
            tokens[done, depth[done]] = tokens[done, begin] + t.cost[t.piece[e]]
            open_ = open_[~fits]
            end[open_] = t.shorter[end[open_]]
        emits[known] = tokens[rows, depth] - total
        tokens -= before[:, None].astype(np.int16)
        matters = t.open[node]
        out[known] = self._state(node, np.where(matters, last, 0), np.where(matters, tokens, 0))
        return out, emits

    def _take(self, state: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and tokens emitted, from the table where it has them."""
        key = state * self.t.codes + code
        mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        one = (mixed >> np.uint64(64 - STEP_BITS)).astype(np.int64)
        hit = self.keys[one] == key
        if hit.all():
            return self.next[one], self.emits[one]
        missed = np.flatnonzero(~hit)
        two = (mixed[missed] >> np.uint64(20) & np.uint64((1 << STEP_BITS) - 1)).astype(np.int64)
        there = self.keys[two] == key[missed]
        one[missed[there]] = two[there]
        missed, two = missed[~there], two[~there]
        # Read before anything is written: a new entry may take the place of one just found.
        following, emitted = self.next[one], self.emits[one].astype(np.int64)
        if len(missed):
            fresh, of, back = np.unique(key[missed], return_index=True, return_inverse=True)
            to, emits = self._work_out(state[missed][of], code[missed][of].astype(np.int64))
            place = one[missed][of]
            taken = self.keys[place] >= 0
            place[taken] = two[of][taken]
            self.keys[place], self.next[place], self.emits[place] = fresh, to, emits
            following[missed], emitted[missed] = to[back], emits[back]
        return following, emitted

    def _walk(
        self, x: np.ndarray, start: np.ndarray, end: np.ndarray, state: np.ndarray, emitted: np.ndarray | None
    ) -> np.ndarray:
        """End states of stretches of ``x`` read side by side."""
        order = np.argsort(start - end, kind="stable")
        sizes = (end - start)[order]
        state, place = state[order].astype(np.int64), start[order].copy()
        active = len(order)
        for k in range(int(sizes.max(initial=0))):
            while sizes[active - 1] <= k:
                active -= 1
            state[:active], emits = self._take(state[:active], x[place[:active]])
            if emitted is not None:
                emitted[place[:active]] = emits
            place[:active] += 1
        out = np.empty_like(state)
        out[order] = state
        return out

    def run(self, x: np.ndarray, state: int, chunk: int = CHUNK) -> tuple[np.ndarray, int]:
        """Tokens emitted at each character of a block, and the state behind it."""
        emitted = np.zeros(len(x), np.int16)
        start = np.arange(0, len(x), chunk)
        closed = np.zeros(len(x), bool)  # no piece reaches across the place before the character
        closed[1:] = ~_find(self.t.touching, x[:-1].astype(np.int64) * self.t.codes + x[1:])[1]
        closed |= x <= _RESET
        # Each chunk but the first begins at its first closed place, if it has one.
        places = np.append(np.flatnonzero(closed), len(x))
        nearest = places[np.searchsorted(places, start)]
        clear = nearest < np.append(start[1:], len(x))
        clear[0] = True
        start = np.where(clear & (start > 0), nearest, start)
        end = np.append(start[1:], len(x))
        begin = np.zeros(len(start), np.int64)
        begin[0] = state
        guessed = np.flatnonzero(~clear)
        back = np.maximum(start[guessed] - LOOK_BACK, 0)
        begin[guessed] = self._walk(x, back, start[guessed], np.zeros(len(back), np.int64), None)
        # The maps: (chunk, state it begins with) and the state it ends with.
        of, entered = np.arange(len(start)), begin
        final = self._walk(x, start, end, begin, emitted)
        while True:
            order = np.lexsort((entered, of))
            of, entered, final = of[order], entered[order], final[order]
            key = of * (1 << 32) + entered
            after = np.minimum(of + 1, len(start) - 1)
            following = np.where(clear[after], 0, final)
            at, found = _find(key, after * (1 << 32) + following)
            found |= of == len(start) - 1
            chosen, complete = self._scan(of, at, found, int(np.searchsorted(key, state)))
            if complete:
                break
            more = np.unique(after[~found] * (1 << 32) + following[~found])
            more_of, more_entered = more >> 32, more & ((1 << 32) - 1)
            more_final = self._walk(x, start[more_of], end[more_of], more_entered, None)
            of, entered, final = (np.concatenate(p) for p in ((of, more_of), (entered, more_entered), (final, more_final)))
        wrong = np.flatnonzero(entered[chosen] != begin)
        self._walk(x, start[wrong], end[wrong], entered[chosen[wrong]], emitted)
        return emitted, int(final[chosen[-1]])

    @staticmethod
    def _scan(of: np.ndarray, at: np.ndarray, found: np.ndarray, begin: int) -> tuple[np.ndarray, bool]:
        """The entry of each chunk's map that is its true one, by composing the
        maps; False if one is missing.

        ``at`` is the entry of the next chunk that an entry leads to, if ``found``.
        """
        first = np.searchsorted(of, np.arange(of[-1] + 1))
        width = int(np.diff(first, append=len(of)).max())
        chunks, missing = len(first), np.int64(-1)
        leads = np.full((chunks, width), missing)
        leads[of, np.arange(len(of)) - first[of]] = np.where(found, at - first[np.minimum(of + 1, chunks - 1)], missing)
        step = 1
        while step < chunks:
            through = np.take_along_axis(leads[step:], np.maximum(leads[:-step], 0), 1)
            # Row k becomes the map from the beginning of chunk k - 2 * step + 1 to the end of chunk k.
            leads = np.concatenate([leads[:step], np.where(leads[:-step] < 0, missing, through)])
            step *= 2
        entries = np.concatenate([[0], leads[:-1, begin - first[0]]])
        entries[0] = begin - first[0]
        return first + np.maximum(entries, 0), bool((entries >= 0).all())

    def count(self, texts: list[str], chunk: int = CHUNK, block: int = BLOCK) -> np.ndarray:
        """Tokens of each text."""
        front = "\x00" + (SPACE if self.t.prefix else "")
        whole = "".join([front + text if text else "\x00" for text in texts])
        sizes = np.array([len(text) + len(front) if text else 1 for text in texts], np.int64)
        starts = np.cumsum(sizes) - sizes
        totals = np.zeros(len(texts), np.int64)
        state = 0
        for at in range(0, len(whole), block):
            if self.states > KEPT_STATES:
                node, last, tokens = (a[[state]] for a in (self.node, self.last, self.tokens))
                self._clear()
                state = int(self._state(node, last, tokens)[0])
            x = self.code[np.frombuffer(whole[at : at + block].encode("utf-32-le"), np.uint32)]
            first, behind = np.searchsorted(starts, [at, at + len(x)])
            begins = starts[first:behind] - at
            x[begins] = _RESET
            emitted, state = self.run(x, state, chunk)
            # What stands before the first text that begins here belongs to the text before.
            cuts = begins if len(begins) and begins[0] == 0 else np.concatenate([[0], begins])
            totals[behind - len(cuts) : behind] += np.add.reduceat(emitted, cuts, dtype=np.int64)
        return totals


def count_tokens(
    docs: DataFrame, model: bytes, limit: int = 4096, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """How many tokens a SentencePiece BPE makes of every whole text.

    ``model``: a BPE with byte fallback and without text rewriting; no begin or
    end ids are counted. Returns ``id_column``, ``n_bytes`` (UTF-8),
    ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens), one row per
    input row: repeated rows and rows without an id stay. A null or empty text
    has 0 bytes and 0 tokens. Texts may have any length: memory follows the
    longest text at some ten bytes a character. Other columns are not read, so
    their names do not matter. The transducer is compiled on the driver, which
    depends on the model only; each task has its own machine.
    """
    compiled = Transducer.compile(Vocabulary.load(model))
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(compiled)
        for piece in pieces(batches, "text", BLOCK):
            counts = machine.count([t or "" for t in piece.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), piece.column("n_bytes"), pa.array(counts, pa.int64())],
                names=["id", "n_bytes", "n_tokens"],
            )

    text = F.col(text_column).cast("string")
    chosen = docs.select(
        F.col(id_column).alias("id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        text.alias("text"),
    )
    counted = chosen.mapInArrow(freed(run), f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(
        F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
