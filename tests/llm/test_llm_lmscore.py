import math
from collections import Counter

import pytest
from helpers import ODD_TEXTS, frame, words

from tidemark.llm import lmscore


def expected(rows):
    texts = [words(t) for _, t in rows]
    counts = [Counter(tuple(w[k : k + n]) for w in texts for k in range(len(w) - n + 1)) for n in (1, 2, 3)]
    total = sum(counts[0].values())
    out = []
    for (i, _), w in zip(rows, texts):
        score = 0.0
        for k in range(len(w)):
            longest = min(k, 2)
            for n in range(longest, -1, -1):
                run = tuple(w[k - n : k + 1])
                cost = (longest - n) * math.log(0.4)
                if n == 0:
                    score += cost + math.log(counts[0][run] / total)
                elif counts[n][run] >= 2:
                    score += cost + math.log(counts[n][run] / counts[n - 1][run[:-1]])
                    break
        out.append((i, len(w), score))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_scores_are_those_of_brute_force(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(lmscore, "BATCH_BYTES", 2000)
        monkeypatch.setattr(lmscore, "PARTITION_WORDS", 700)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60)
    rows = [tuple(r) for r in docs.collect()] + [(1000 + k, t) for k, t in enumerate(ODD_TEXTS)] + [(None, "the the the")]
    got = lmscore.score_documents(frame(spark, rows)).collect()
    got = sorted((str(r["doc_id"]), r["n_words"], r["log_score"], r["mean_log_score"]) for r in got)
    want = sorted((str(i), n, s) for i, n, s in expected(rows))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want):
        assert g[2] == pytest.approx(w[2], rel=1e-9, abs=1e-9)
        assert g[3] == (pytest.approx(w[2] / w[1]) if w[1] else None)


def test_no_words(spark):
    assert lmscore.score_documents(frame(spark, [])).collect() == []
    got = lmscore.score_documents(frame(spark, [(1, None), (2, " ")])).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0.0, None), (2, 0, 0.0, None)]
