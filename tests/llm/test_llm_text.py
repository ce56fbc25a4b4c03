import random

import numpy as np
import pyarrow as pa
from helpers import ALNUM, ODD_TEXTS, SPACED, words

from tidemark.llm import textbuf


def random_texts(n, seed=1):
    random.seed(seed)
    alphabet = "abAB zé漢\t\n.,-09\x00\x7f𝒳"
    return ["".join(random.choice(alphabet) for _ in range(random.randint(0, 40))) for _ in range(n)] + ODD_TEXTS


def test_words_are_those_of_the_patterns():
    texts = random_texts(500)
    data, offsets = textbuf.text_bytes(pa.array(texts, pa.string()).slice(3))
    for table, pattern in ((textbuf.ALNUM, ALNUM), (textbuf.NOT_SPACE, SPACED)):
        found = textbuf.find_words(data, offsets, table)
        lowered = textbuf.LOWER[data].tobytes()
        got = [lowered[a:b].decode() for a, b in zip(found.start, found.end)]
        want = [w for t in texts[3:] for w in words(t, pattern)]
        assert got == want
        assert np.diff(found.first).tolist() == [len(words(t, pattern)) for t in texts[3:]]
        assert len(set(found.hash.tolist())) == len(set(want))


def test_runs_stay_within_texts():
    texts = random_texts(200, 2)
    data, offsets = textbuf.text_bytes(pa.array(texts, pa.string()))
    found = textbuf.find_words(data, offsets, textbuf.ALNUM)
    values, docs = textbuf.ngrams(found, 3)
    want = [(i, *w[k : k + 3]) for i, t in enumerate(texts) for w in [words(t)] for k in range(len(w) - 2)]
    assert docs.tolist() == [w[0] for w in want]
    assert len(set(values.tolist())) == len({w[1:] for w in want})


def test_pieces_are_bounded_and_whole():
    texts = random_texts(300, 3)
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    parts = list(textbuf.pieces([batch.slice(0, 0), batch], limit=500))
    assert [t for p in parts for t in p.column("text").to_pylist()] == texts
    for p in parts:
        sizes = [len((t or "").encode()) for t in p.column("text").to_pylist()]
        assert sum(sizes) <= 500 or len(sizes) == 1
