import hashlib
import re
from collections import defaultdict

import pytest
from helpers import LOWER

from tidemark.llm import chat, urls
from tidemark.llm.data import table

ODD_URLS = [
    None, "", "no scheme", "http://", "http://A.COM", "http://www.Example.com/en/", "x://example.com/en", "http://example.com/en/?a=1&b=2",
    "http://notexample.com/en/x", "http://a.net/es/#f", "http://net/fr/", "http://a.b.net?x=/es/", "://com/", "http://É.com/\n/x", "http://h.org/" + "a" * 5000,
    "http://x.com://y.com/", "http://www.example.com/en/", "http://www.example.com/en/",
]


def judged(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group(0)
        path = re.match(r"[^?#]*", rest[len(host) :]).group(0)
        host = host.translate(LOWER)
    fits = [(h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda f: len(f[0]), default=(None, None))
    return host, path, rule, verdict


def test_hosts_paths_and_rules(spark):
    known = [r["url"] for r in table(spark, "/root/testdata/sf0.01", "pages").collect()]
    rows = [(i, u, "x", "y") for i, u in enumerate(ODD_URLS + known)] + [(None, "http://a.org/x", "x", "y")]
    got = urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string, id string, label string")).collect()
    assert len(got) == len(rows)
    by_id = {r["page_id"]: r for r in got}
    for i, u, *_ in rows:
        host, path, rule, verdict = judged(u)
        r = by_id[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), u
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")


def test_trees_learn_from_labels(spark):
    rows = [(k, f"http://h{k % 7}.org/{'a' * (k % 40)}/{k}?x=1&y={k}" if k % 3 else f"http://h{k % 7}.org/{k}") for k in range(600)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labelled = pages.filter("page_id < 400").selectExpr("url", "int(page_id % 3 > 0) AS label")
    got = urls.judge_urls(pages, [], labelled).filter("page_id >= 400").collect()
    right = [(r["verdict"] == "block") == (r["page_id"] % 3 > 0) for r in got]
    assert sum(right) > 0.97 * len(right)


def test_urls_without_labels(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x"), (2, None)], "page_id long, url string")
    assert {r["verdict"] for r in urls.judge_urls(pages).collect()} == {"allow"}
    assert urls.judge_urls(pages.limit(0)).collect() == []
    assert len(urls.judge_urls(pages, []).collect()) == 2


def test_statistics_count_all_pages(spark, monkeypatch):
    labelled = [(f"http://a.com/{'x' if k % 4 else 'y'}/{k}", int(k % 4 == 0), 1) for k in range(80)]
    others = [(f"http://b{k % 9}.org/z/{k}", None, 1) for k in range(50)] + [("http://b0.org/z/0", None, 1)] * 30
    others += [("http://c.net/z/1", 1, 0), ("http://c.net/z/2", 7, 0), (None, 1, 1)]
    seen = spark.createDataFrame(labelled + others, "url string, label int, pages int")
    pages = [("http://a.com/y/0", "a.com", "/y/0"), ("http://b3.org/z/3", "b3.org", "/z/3"), ("http://c.net/z/1", "c.net", "/z/1"), ("http://d.de/", "d.de", "/")]
    rows = spark.createDataFrame(pages * 2, "url string, host string, path string")
    prior = 21 / 81
    want = {
        "a.com": (80.0, (20 + 4 * prior) / 84, (20 + 4 * prior) / 84, 24 / 24 - 4 * (1 - prior) / 24),
        "b3.org": (50.0, prior, prior, (1 + 4 * prior) / 5),
        "c.net": (0.0, (1 + 4 * prior) / 5, (1 + 4 * prior) / 5, (1 + 4 * prior) / 5),
        "d.de": (0.0, prior, prior, prior),
    }
    for often in (urls.OFTEN_KEYS, 4, 1):  # broadcast, both, exchanged
        monkeypatch.setattr(urls, "OFTEN_KEYS", often)
        got = urls.UrlModel(seen, sample_rows=10).features(rows).collect()
        assert len(got) == 8
        for r in got:
            found = (r["suffix_urls"], r["suffix_blocked"], r["first_label_blocked"], r["segment_blocked"])
            assert found == pytest.approx(want[r["host"]]), (often, r["host"])


def rendered(rows):
    """Maximal conversations by comparing each with each."""
    turns = defaultdict(lambda: defaultdict(set))
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv][chat.LAST if turn is None else turn].add((role or "", text or ""))
    logs = {c: [(t, sorted(s)) for t, s in sorted(ts.items())] for c, ts in turns.items()}
    out = set()
    for c, log in logs.items():
        equal = [o for o, other in logs.items() if other == log]
        longer = any(len(other) > len(log) and other[: len(log)] == log for other in logs.values())
        if longer or c != min(equal):
            continue
        parts = defaultdict(list)
        for t, said in log:
            parts[t >> chat.BLOCK_BITS].append("".join(f"<|{r}|>\n{x}\n" for r, x in said))
        for part, said in parts.items():
            out.add((c, part, len(said), len(equal), "".join(said)))
    return out


def test_maximal_conversations(spark):
    base = [(k, "user" if k % 2 else "assistant", f"t{k}") for k in range(600)]
    rows = [(1, *t) for t in base] + [(2, *t) for t in base[:300]] + [(3, *t) for t in base[:256]] + [(4, *t) for t in base]
    rows += [(5, *t) for t in base[:2]] + [(6, *base[0]), (6, 1, "user", "other")] + [(7, *base[0])] * 3
    rows += [(8, 0, "user", None), (8, None, None, "last"), (9, 0, "user", ""), (10, 0, None, None), (11, None, None, None)]
    rows += [(12, 3, "b", "x"), (12, 3, "a", "y"), (13, 3, "a", "y"), (None, 0, "user", "nobody"), (14, 1, "user", "t1"), (14, -5, "x", "y")]
    frame = spark.createDataFrame([(*r, "z", "z") for r in rows], "conv_id long, turn int, role string, text string, block string, h1 string")
    got = {tuple(r) for r in chat.render(frame).collect()}
    assert got == rendered(rows)
    assert chat.render(frame.limit(0)).collect() == []


def test_conversations_of_the_test_table(spark):
    table_ = table(spark, "/root/testdata/sf0.001", "conversations")
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table_.collect()]
    got = {(r["conv_id"], r["part"], r["n_turns"], r["n_copies"], r["rendered_sha256"]) for r in chat.rendered_digest(table_).collect()}
    assert got == {(*r[:4], hashlib.sha256(r[4].encode()).hexdigest()) for r in rendered(rows)}


def test_no_python_on_the_main_path(spark):
    sf = "/root/testdata/sf0.001"
    for frame in (chat.rendered_digest(table(spark, sf, "conversations")), urls.judge_urls(table(spark, sf, "pages"))):
        plan = frame._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
