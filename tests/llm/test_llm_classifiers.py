import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import ODD_TEXTS, frame

from tidemark.llm import quality, toxicity, trees
from tidemark.llm.data import table

SF = "/root/testdata/sf0.01"


def area(score, label):
    positive, negative = score[label == 1], score[label == 0]
    return (positive[:, None] > negative[None]).mean() + (positive[:, None] == negative[None]).mean() / 2


def test_statistics_of_odd_texts():
    values = quality.statistics(pa.array(ODD_TEXTS, pa.string()))
    assert values.shape == (len(ODD_TEXTS), len(quality.STATISTICS)) and np.isfinite(values).all()
    assert not values[[0, 1, 2, 3]].any()
    one = dict(zip(quality.STATISTICS, quality.statistics(pa.array(["Aa aa | bb!! aa aa 12 é\nAa aa"]))[0]))
    assert one["log_words"] == pytest.approx(np.log1p(10))
    assert one["pipes"] == pytest.approx(0.1) and one["exclamations"] == pytest.approx(0.2)
    assert one["repeated_next"] == pytest.approx(0.1) and one["distinct_words"] == pytest.approx(0.6)
    assert one["digits"] == pytest.approx(2 / 29) and one["non_ascii"] == pytest.approx(1 / 29)


def test_paths_and_rules():
    tree = trees.Split(0, 1.0, trees.Leaf(1), trees.Split(0, 2.0, trees.Leaf(2), trees.Split(1, 5.0, trees.Leaf(3), trees.Leaf(4))))
    assert ((0, True, 2.0), (1, False, 5.0)) in trees.paths(tree)
    rng = np.random.default_rng(1)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.6) & (x[:, 2] <= 0.5)).astype(float)
    model = quality.fit_rules(x, y)
    assert ((model.scores(x) >= 0.5) == y).mean() > 0.98
    assert quality.fit_rules(x[:0], y[:0]).scores(x[:2]).tolist() == [0.5, 0.5]
    assert (quality.fit_rules(x, y * 0).scores(x) < 0.1).all()


def test_compiled_rules_are_the_rules(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    stats = quality.with_statistics(docs.selectExpr("doc_id AS id", "text"))
    model = quality.fit_quality(stats, labels)
    rows = stats.select("id", *quality.STATISTICS, model.column().alias("score")).collect()
    x = np.array([r[1:-1] for r in rows])
    assert np.allclose(model.scores(x), [r[-1] for r in rows])
    assert model.rules and len(model.text()) == len(model.rules)


@pytest.mark.parametrize("score, label, folds, held, least", [
    (quality.score_quality, "quality", 5, 0, 0.97),
    (toxicity.score_toxicity, "toxic", 4, 2, 0.75),
])
def test_held_out_documents(spark, score, label, folds, held, least):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = score(docs, labels).join(labels, "doc_id").toPandas()
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % folds == held)).all()
    out = got[got.held_out]
    assert area(out.score.to_numpy(), out[label].to_numpy()) >= least


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = table(spark, SF, "documents").limit(300), table(spark, SF, "labels")
    turned = labels.selectExpr("doc_id", "if(crc32(string(doc_id)) % 5 = 0, 1 - quality, quality) AS quality")
    a = quality.score_quality(docs, labels).collect()
    assert sorted(a) == sorted(quality.score_quality(docs, turned).collect())


def test_odd_rows(spark):
    docs = frame(spark, [*enumerate(ODD_TEXTS), (None, "no id"), (1, "again")])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(4, 1, 0), (4, None, 1), (None, 0, 1), (77, 0, 0), (10, 0, None)], none.schema)
    for score, keep in ((quality.score_quality, quality.filter_quality), (toxicity.score_toxicity, toxicity.filter_toxic)):
        for labels in (none, some):
            got = score(docs, labels).collect()
            assert len(got) == len(ODD_TEXTS) + 2 and all(0 <= r["score"] <= 1 for r in got)
            assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]
            kept = keep(docs, labels)
            assert kept.columns == docs.columns and kept.count() <= len(got)
        assert score(docs.limit(0), none).collect() == []


def test_inserted_characters_and_gaps_stay_close():
    rng = random.Random(2)
    letters = "abcdefghilmnorstuw"
    clean = ["".join(rng.choices(letters, k=rng.randint(3, 10))) for _ in range(1500)]
    insults = ["idiot", "worthless", "pathetic", "moron"]
    model = toxicity.fit_words([(w, 4.0) for w in insults], [(w, 1.0) for w in clean])
    high = ["idiot", "i.d.i.o.t", "idi-ot", "wor*thless", "path.etic", "p-a-t-h-e-t-i-c", "worthlesss"]
    low = ["".join(rng.choices(letters, k=7)) for _ in range(300)]
    assert min(model.margins(high)) > np.quantile(model.margins(low), 0.98)
    assert "idiot" in toxicity.words_of("you i d i o t there") and toxicity.words_of("IDIOT!!%%%") == {"idiot"}
    assert model.margins(["x" * 500 + "idiot" + "x" * 500])[0] > model.margins(["x" * 1000])[0]


def test_kernel_is_that_of_plain_counting():
    from collections import Counter

    def plain(word):
        text = toxicity.BEGIN + word + toxicity.END
        out = Counter()
        for places, weight in toxicity.PATTERNS:
            for k in range(len(text) - places[-1]):
                out["".join(text[k + p] for p in places)] += weight
        return out

    a, b = ["idiot", "aaaa", "x"], ["idi.ot", "aaa", "clown"]
    for i, row in enumerate(toxicity.kernel(a, b)):
        for j, value in enumerate(row):
            x, y = plain(a[i]), plain(b[j])
            length = lambda c: sum(v * v for v in c.values()) ** 0.5
            assert value == pytest.approx(sum(x[k] * y[k] for k in x) / length(x) / length(y))
