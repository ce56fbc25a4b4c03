import hashlib
import random

import numpy as np
import pytest
from helpers import ODD_TEXTS, frame, words

from tidemark.llm import licenses, spotsigs
from tidemark.llm.data import table

SF = "/root/testdata/sf0.001"


def scanned(text, templates=licenses.TEMPLATES):
    """Every block against every template."""
    all_words = words(text)
    base = sorted(
        (k, label) for phrase, label in licenses.PHRASES.items() for p in [phrase.split()]
        for k in range(len(all_words)) if all_words[k : k + len(p)] == p
    )
    labels, shares = {label for _, label in base}, [0.0]
    for line in (text or "").split("\n"):
        own = words(line)
        starts = [0] if len(own) <= 64 else range(0, len(own) - 32, 32)
        for s in starts:
            block = set(own[s : s + 64])
            held = []
            for label, wordings in templates.items():
                for wording in wordings:
                    t = set(words(wording))
                    if 100 * len(t & block) >= 90 * len(t):
                        held.append((len(t & block) / len(t), label, t))
            for share, label, t in held:
                shares.append(share)
                if not any(more > share and 2 * len(t & u) > len(t) for more, _, u in held):
                    labels.add(label)
    starts = [k for k, _ in base]
    return (
        len(all_words), len(base), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({label for _, label in base})), ",".join(sorted(labels)), 1.0 if base else max(shares),
    )


@pytest.fixture(scope="module")
def license_rows(spark):
    rng = random.Random(5)
    out = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    notices = [w for ws in licenses.TEMPLATES.values() for w in ws] + list(licenses.PHRASES)
    for k in range(300):
        notice = rng.choice(notices).split()
        if rng.random() < 0.4:
            notice[rng.randrange(len(notice))] = "word"
        filler = rng.choices(["the", "of", "Foo", "license", "under", "by", "é"], k=rng.choice([0, 3, 30, 200]))
        at = rng.randint(0, len(filler))
        sep = rng.choice([" ", "\n", "-", ". "])
        out.append((100 + k, sep.join(filler[:at]) + rng.choice([" ", "\n"]) + " ".join(notice).upper() + "\n" + " ".join(filler[at:])))
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    return out + [(10_000 + r["doc_id"], r["text"]) for r in docs] + [(None, "All rights reserved"), (0, "cc-by")]


def test_two_notices_of_a_line_both_count(spark):
    (mpl, *_), (mit, *_) = licenses.TEMPLATES["mpl-2.0"], licenses.TEMPLATES["mit"]
    most = mpl.split()
    del most[len(most) // 2]
    text = " ".join(most) + " " + mit
    (row,) = licenses.scan_licenses(frame(spark, [(1, text)])).collect()
    assert {"mpl-2.0", "mit"} <= set(row.labels.split(","))


def test_licenses_are_those_of_brute_force(spark, license_rows):
    got = licenses.scan_licenses(frame(spark, license_rows)).drop("blocks").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((i, *scanned(t))) for i, t in license_rows)


def test_other_templates(spark, license_rows):
    longer = {"a": ["word " + " ".join(f"x{k}" for k in range(20))], "b": [" ".join(f"x{k}" for k in range(5, 30))]}
    rows = [(k, " ".join(f"x{j}" for j in range(k % 8, 20 + k % 13) if j != k % 5)) for k in range(60)]
    got = licenses.scan_licenses(frame(spark, rows), longer).drop("blocks").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((i, *scanned(t, longer))) for i, t in rows)
    none = licenses.scan_licenses(frame(spark, rows), {}).collect()
    assert {(r["labels"], r["score"]) for r in none} == {("", 0.0)}
    assert licenses.scan_licenses(frame(spark, [])).collect() == []


def test_blocks_name_the_place(spark):
    (row,) = licenses.scan_licenses(frame(spark, [(1, "some words\nReleased under the MIT License.\nmore")])).collect()
    assert [tuple(b) for b in row["blocks"]] == [(2, 7, "mit", 1.0)]


def test_wrapped_notices(spark):
    rows = {
        1: ("Released under the\nMIT License", "mit", 1.0),
        2: ("x\n# This work is licensed under the GNU\n# General Public License,\n# version 2.\ny", "gpl,gpl-2.0", 1.0),
        3: ("a b c\n * licensed under a creative\n * commons attribution 4.0 global\n * license", "cc-by-4.0", 0.9),
        4: ("licensed under a creative\r\ncommons attribution 4.0\r\ninternational license", "cc-by-4.0", 1.0),
        5: ("use of this source code is governed\nby some bsd style license", "bsd", 11 / 12),
        6: ("under the mit\nfiller released\nlicense", "", 0.0),
        7: ("Released under the", "", 0.0),
        8: ("MIT License", "", 0.0),
    }
    got = licenses.scan_licenses(frame(spark, [(k, v[0]) for k, v in rows.items()])).collect()
    assert {r["doc_id"]: (r["labels"], r["score"]) for r in got} == {k: v[1:] for k, v in rows.items()}
    assert [tuple(b) for b in got[0]["blocks"]] == [(0, 5, "mit", 1.0)]


def test_lesser_notices_of_a_line(spark):
    gpl = "this work is licensed under the gnu general public license version"
    rows = {
        1: ("Released under the MIT License, or use of this source code is governed by some BSD style license", "bsd,mit"),
        2: (f"{gpl} 2", "gpl,gpl-2.0"),
        3: (f"{gpl} 2 or {gpl} 3", "gpl,gpl-2.0,gpl-3.0"),
        4: ("some work is licensed under the gnu affero general public license version 3", "agpl-3.0,gpl"),
    }
    got = licenses.scan_licenses(frame(spark, [(k, v[0]) for k, v in rows.items()])).collect()
    assert {r["doc_id"]: r["labels"] for r in got} == {k: v[1] for k, v in rows.items()}


def test_templates_of_many_words(spark):
    body = [f"w{k}" for k in range(170)]
    rows = [(k, " ".join(f"f{j}" for j in range(37 * k)) + " " + " ".join(body) + " z" * 400) for k in range(12)]
    rows += [(100 + k, "\n".join(" ".join(body[j : j + 9 + k]) for j in range(0, 170, 9 + k))) for k in range(9)]
    rows += [(200, " ".join(body[:152])), (201, "\n".join(body[:153])), (202, "\n".join(body[:152]))]
    got = licenses.scan_licenses(frame(spark, rows), {"long": [" ".join(body)]}).collect()
    assert {r["doc_id"]: r["labels"] for r in got} == {k: "" if k in (200, 202) else "long" for k, _ in rows}


def signature_set(text):
    own = words(text)
    anchors = set(spotsigs.ANCHORS)
    out = set()
    for k, w in enumerate(own):
        if w in anchors:
            chain = [x for x in own[k + 1 :] if x not in anchors][: spotsigs.CHAIN]
            if len(chain) == spotsigs.CHAIN:
                out.add((w, *chain))
    if not out and own:
        out = {tuple(own[k : k + 3]) for k in range(max(len(own) - 2, 1))}
    return out


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


@pytest.mark.parametrize("parts", [1, 5])
def test_edited_texts(spark, parts):
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    rows = [(i * 3, t) for i, t in enumerate(ODD_TEXTS)] + [(1000 + r["doc_id"], r["text"]) for r in docs[:80]]
    rows += [(6, "tie of one id"), (None, "z no id"), (None, "a no id"), (33, "one two three four")]
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    want = []
    for k, (i, text) in enumerate(ordered):
        text, following = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        n = len(text) // 4
        edited = text[: len(text) - n] + following[:n]
        own = signature_set(text)
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), jaccard(own, signature_set(edited)), jaccard(own, signature_set(following))))
    random.Random(1).shuffle(rows)
    got = spotsigs.compare_edited(frame(spark, rows), parts=parts).collect()
    seen = [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in got]
    assert sorted(map(repr, seen)) == sorted(map(repr, want))
    prints = spotsigs.fingerprints(frame(spark, rows)).collect()
    of = {}
    for r, (i, t) in zip(prints, rows):
        assert of.setdefault(r["fingerprint"], signature_set(t)) == signature_set(t)
    assert len({r["fingerprint"] for r in prints}) == len({frozenset(signature_set(t)) for _, t in rows})


def test_one_and_no_documents(spark):
    (row,) = spotsigs.compare_edited(frame(spark, [(1, "abcd efgh")])).collect()
    assert (row["edited_sha256"], row["near_next"]) == (hashlib.sha256(b"abcd efab").hexdigest(), 1.0)
    assert spotsigs.compare_edited(frame(spark, [])).collect() == []


def test_pairs_are_those_of_brute_force(spark):
    rng = random.Random(6)
    vocabulary = ["the", "of", "and"] * 20 + [f"w{k}" for k in range(200)]
    bases = [rng.choices(vocabulary, k=rng.randint(20, 120)) for _ in range(12)]
    rows = []
    for k in range(120):
        base = rng.choice(bases)
        rows.append((k, " ".join(rng.choice(vocabulary) if rng.random() < 0.03 else w for w in base[: len(base) - rng.randint(0, 10)])))
    sets = {}
    for i, t in rows:
        sets.setdefault(frozenset(signature_set(t)), i)
    ids = sorted((i, s) for s, i in sets.items() if s)
    want = {(a, b): jaccard(x, y) for k, (a, x) in enumerate(ids) for b, y in ids[k + 1 :] if jaccard(x, y) >= spotsigs.THRESHOLD}
    got = spotsigs.similar_pairs(frame(spark, rows)).collect()
    assert {(r["a"], r["b"]): r["likeness"] for r in got} == pytest.approx(want) and want


def test_pruned_likeness():
    rng = np.random.default_rng(2)
    for _ in range(300):
        a, b = (np.unique(rng.integers(0, 60, rng.integers(0, 50)).astype(np.uint64)) for _ in range(2))
        exact = jaccard(set(a.tolist()), set(b.tolist()))
        assert spotsigs.likeness(a, b) == pytest.approx(exact)
        if len(a) and len(b):
            assert spotsigs.likeness(a, b, 0.4) == pytest.approx(exact if exact >= 0.4 else 0.0)
