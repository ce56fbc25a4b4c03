import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece as library
from helpers import ODD_TEXTS, frame

from tidemark.llm import tokencount
from tidemark.llm.sentencepiece import Vocabulary

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = open(PATH, "rb").read()


@pytest.fixture(scope="module")
def known():
    return library.SentencePieceProcessor(model_proto=MODEL)


@pytest.fixture(scope="module")
def compiled():
    return tokencount.Transducer.compile(Vocabulary.load(MODEL))


def hard_texts():
    random.seed(1)
    parts = ["the", "in", "er", " ", "  ", "▁", "tion", "0", "11", "..", "--", "==", "\n", "//", "é", "漢", "ß", "a", "<s>", "<0x41>", "\x00"]
    texts = [t or "" for t in ODD_TEXTS] + [" " * n + "x" for n in range(70)] + ["a" * 999, "ab" * 500, "=-" * 300]
    texts += ["".join(random.choice(parts) for _ in range(random.randint(0, 60))) for _ in range(2000)]
    return texts + ["".join(random.choice("abcdetion") for _ in range(random.randint(0, 2000))) for _ in range(30)]


@pytest.mark.parametrize("chunk, block", [(256, 1 << 21), (33, 1000), (7, 100_000), (1, 3000)])
def test_equal_to_the_library_however_texts_are_cut(known, compiled, chunk, block):
    texts = hard_texts() if chunk > 1 else hard_texts()[:300]
    got = tokencount.Machine(compiled).count(texts, chunk, block)
    assert got.tolist() == [len(known.encode(t)) for t in texts]


def test_every_piece_and_pairs_of_pieces(known, compiled):
    random.seed(2)
    pieces = [known.id_to_piece(i) for i in range(259, 32000)]
    texts = pieces + [random.choice(pieces) + random.choice(pieces) + random.choice(pieces) for _ in range(30_000)]
    assert tokencount.Machine(compiled).count(texts).tolist() == [len(x) for x in known.encode(texts)]


def test_forgotten_states_and_overwritten_transitions_change_nothing(known, compiled, monkeypatch):
    monkeypatch.setattr(tokencount, "KEPT_STATES", 50)
    monkeypatch.setattr(tokencount, "STEP_BITS", 6)
    monkeypatch.setattr(tokencount, "STATE_BITS", 5)
    texts = hard_texts()[80:400]
    assert tokencount.Machine(compiled).count(texts, 40, 500).tolist() == [len(known.encode(t)) for t in texts]


def test_a_chunk_whose_first_state_is_guessed_wrong_is_read_again(known, compiled, monkeypatch):
    monkeypatch.setattr(tokencount, "LOOK_BACK", 1)
    texts = ["a" * n for n in (500, 777, 1000)] + ["abcabcaab" * 200]
    assert tokencount.Machine(compiled).count(texts, 50).tolist() == [len(known.encode(t)) for t in texts]


def test_scan_composes_maps():
    # Chunk 1 has two entries, of which the first chunk leads to the second.
    of, found = np.array([0, 1, 1, 2]), np.array([True, True, True, True])
    at = np.array([2, 3, 3, 3])
    chosen, complete = tokencount.Machine._scan(of, at, found, 0)
    assert chosen.tolist() == [0, 2, 3] and complete
    assert not tokencount.Machine._scan(of, at, np.array([True, True, False, True]), 0)[1]
    assert tokencount.Machine._scan(of, at, np.array([True, False, True, True]), 0)[1]


def test_frame(spark, known):
    long_text = "one long text " * 200_000
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "no id"), (1, "again"), (99, long_text), (100, "word " * 4096)]
    docs = frame(spark, rows, "doc_id long, text string, id string, n_tokens string")
    got = tokencount.count_tokens(docs, MODEL).collect()
    sizes = [(i, len((t or "").encode()), len(known.encode(t or ""))) for i, t in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((i, b, n, n > 4096)) for i, b, n in sizes)
    assert tokencount.count_tokens(frame(spark, []), MODEL).collect() == []


def test_query_reads_whole_texts(spark, known):
    from tidemark.llm.queries import op13_token_counts

    got = {r.doc_id: (r.n_tokens, r.over_limit) for r in op13_token_counts(spark, "/root/testdata/sf0.01").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    counts = [len(x) for x in known.encode([d.text or "" for d in docs])]
    assert got == {d.doc_id: (n, n > 4096) for d, n in zip(docs, counts)}
