import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from helpers import ODD_TEXTS, frame

from tidemark.llm import periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, least=6, repeats=4):
    """All maximal stretches of each period, the smallest period of each stretch."""
    found = {}
    n = len(words)
    for q in range(1, n // repeats + 1):
        k = 0
        while k + q < n:
            if words[k] != words[k + q]:
                k += 1
                continue
            to = k
            while to + q < n and words[to] == words[to + q]:
                to += 1
            if to + q - k >= max(least, repeats * q):
                found.setdefault((k, to + q - k), q)
            k = to + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def test_every_difference_is_covered():
    differences = {(a - b) % periodic.MODULUS for a in periodic.COVER for b in periodic.COVER}
    assert differences == set(range(periodic.MODULUS))


def sequences():
    random.seed(3)
    out = [[], [1], [1] * 5, [1] * 6, [1] * 700, [1, 2] * 300, [1, 2] * 4, [1, 2, 1] * 40 + [1, 2], list(range(200))]
    for _ in range(300):
        out.append([random.randint(1, random.choice([1, 2, 3, 50])) for _ in range(random.randint(0, 150))])
    for _ in range(150):  # periods inside periods, cut and joined
        words = []
        while len(words) < random.randint(1, 500):
            unit = [random.randint(1, 3) for _ in range(random.randint(1, 30))]
            words += (unit * random.randint(1, 12))[: random.randint(1, 200)]
        out.append(words)
    fibonacci = [[1], [1, 2]]
    while len(fibonacci[-1]) < 900:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    return out + [fibonacci[-1], fibonacci[-1] * 5]


def test_common_extensions():
    texts = [np.array(s, np.int64) for s in sequences() if len(s) > 3]
    word, begin, end = periodic.lay_out(texts)
    known = periodic.Extensions(word, begin, end)
    random.seed(4)
    i, j, want = [], [], []
    for t, b in zip(texts, begin.tolist()):
        for _ in range(40):
            x, y = sorted(random.sample(range(len(t)), 2))
            n = 0
            while y + n < len(t) and t[x + n] == t[y + n]:
                n += 1
            i, j, want = i + [b + x], j + [b + y], want + [n]
    assert known.common(np.array(i), np.array(j)).tolist() == want


@pytest.mark.parametrize("points", [1 << 20, 100])
@pytest.mark.parametrize("least, repeats", [(6, 4), (3, 3), (10, 3)])
def test_runs_equal_brute_force(monkeypatch, points, least, repeats):
    monkeypatch.setattr(periodic, "POINTS", points)
    texts = sequences()
    text, start, length, period = periodic.runs(*periodic.lay_out([np.array(s, np.int64) for s in texts]), least, repeats)
    got = [[] for _ in texts]
    for t, *run in zip(*(x.tolist() for x in (text, start, length, period))):
        got[t].append(tuple(run))
    for words, found in zip(texts, got):
        assert found == plain_runs(words, least, repeats), words


def test_short_runs_are_refused():
    with pytest.raises(ValueError):
        periodic.runs(*periodic.lay_out([np.array([1, 1])]), 2, 2)


def expected(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in sorted(found, key=lambda r: (r[0], r[2])))
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *sha)


def test_frame(spark):
    random.seed(5)
    said = [" ".join(random.choice(["a", "B", "b", "é"]) for _ in range(random.randint(0, 60))) for _ in range(80)]
    texts = ODD_TEXTS + said + ["no no no no no no\nno", "\x1c a   a", "go on " * 3000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "x x x x x x"), (1, "again again"), (20, said[8])]
    docs = frame(spark, rows, "doc_id long, text string, runs string, __words2 string")
    got = periodic.run_digest(periodic.find_runs(periodic.planted(docs))).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(expected(i, t)) for i, t in rows)
    assert periodic.run_digest(periodic.find_runs(periodic.planted(frame(spark, [])))).collect() == []


def test_collapsed_text_and_spans(spark):
    docs = frame(spark, [(1, "say it  so so so so so so\tnow"), (2, None)])
    one, two = sorted(periodic.find_runs(docs).collect(), key=lambda r: r.doc_id)
    assert (one.n_words, one.collapsed) == (9, "say it so now")
    assert [tuple(r) for r in one.runs] == [(2, 6, 1)]
    assert tuple(two)[1:] == (0, [], "")


def test_query_equals_brute_force(spark):
    from tidemark.llm.queries import op12_periodic_runs

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = {tuple(r) for r in op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    want = {expected(d.doc_id, d.text) for d in docs if len(d.text or "") < 8000}
    assert len(got) == len(docs) and want <= got and len(want) > 150
