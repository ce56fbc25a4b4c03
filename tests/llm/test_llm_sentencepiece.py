import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece as library
from helpers import ODD_TEXTS, frame

from tidemark.llm import sentencepiece

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    model = open(PATH, "rb").read()
    return library.SentencePieceProcessor(model_proto=model), sentencepiece.Encoder(sentencepiece.Vocabulary.load(model)), model


def test_equal_to_the_library(both):
    known, own, _ = both
    random.seed(1)
    parts = ["the", "in", "er", " ", "  ", "▁", "tion", "0", "11", "..", "--", "==", "\n", "//", "é", "漢", "ß", "a", "<s>", "<0x41>"]
    texts = [t for t in ODD_TEXTS if t] + [" " * n + "x" for n in range(70)] + ["a" * 999, "ab" * 500]
    texts += ["".join(random.choice(parts) for _ in range(random.randint(0, 60))) for _ in range(3000)]
    texts += [own.vocabulary.texts[i] * random.randint(1, 4) for i in range(259, 32000, 7)]
    for text in texts:
        ids = known.encode(text)
        assert own.encode(text) == ids, text
        assert sentencepiece.decode(own.vocabulary, ids) == known.decode(ids), text


def test_broken_bytes_and_control_pieces_decode_as_in_the_library(both):
    known, own, _ = both
    byte = own.vocabulary.byte_ids
    for ids in ([byte[0xE6], byte[0xBC], 300], [1, 300, 2], [byte[0xFF]], [300, byte[0xC3], byte[0xA9], 300], []):
        assert sentencepiece.decode(own.vocabulary, ids) == known.decode(ids)


def test_forgetting_words_changes_nothing(both, monkeypatch):
    known, own, _ = both
    monkeypatch.setattr(sentencepiece, "REMEMBERED_BYTES", 1000)
    for text in ["a few words here", "other words here", "a few more"] * 3:
        assert own.encode(text) == known.encode(text)


def test_frame(spark, both):
    known, _, model = both
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "no id"), (1, "again")]
    got = sentencepiece.encode_decode(frame(spark, rows), model).collect()
    want = []
    for i, text in rows:
        ids = known.encode(text or "")
        decoded = known.decode(ids)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), decoded)]
        want.append((i, len(ids), sha[0], decoded, sha[1]))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert sentencepiece.encode_decode(frame(spark, []), model).collect() == []
