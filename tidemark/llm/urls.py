"""URL filters: rules first, then boosted trees on lexical features.

The rules' verdicts are the labels that the trees learn from, or any labelled
urls. Features, their joining with suffix statistics, and the fitted trees are
DataFrame expressions; the trees are fitted on a bounded sample of distinct
labelled urls. The statistics count all urls of all pages, and block rates all
labelled urls.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.data import stored
from tidemark.llm.trees import Leaf, Split, boost

#: Labelled urls the trees are fitted on at most.
SAMPLE_ROWS = 20_000
#: (host, path prefix, verdict); a rule fits its host and all hosts below.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
FEATURES = (
    "url_length",
    "host_length",
    "path_length",
    "depth",
    "labels",
    "hyphens",
    "digit_ratio",
    "letter_ratio",
    "host_entropy",
    "path_entropy",
    "parameters",
    "fragment",
    "secure",
    "suffix_urls",
    "suffix_blocked",
    "first_label_blocked",
    "segment_blocked",
)

#: What urls are grouped by for statistics.
STATISTICS = ("suffix", "first_label", "segment")
#: Keys of a statistic that are broadcast at most.
OFTEN_KEYS = 100_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands after the first ``://``; both empty where there is none."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _UPPER.lower())
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """``rule`` and ``verdict`` of the longest fitting rule; null where none fits."""
    fits = [
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for h, p, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    ]
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*fits, none)


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text).cast("double")
    counts = F.transform(
        F.array_distinct(F.split(text, "")), lambda c: n - F.length(F.replace(text, c, F.lit(""))).cast("double")
    )
    summed = F.aggregate(counts, F.lit(0.0), lambda a, c: a + F.when(c > 0, c * F.log2(c)).otherwise(0.0))
    return F.when(n > 1, F.log2(n) - summed / n).otherwise(0.0)


def _counted(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def keyed(rows: DataFrame) -> DataFrame:
    """What ``host`` and ``path`` are grouped by for statistics."""
    host, path = F.col("host"), F.col("path")
    names = {
        "suffix": F.substring_index(host, ".", -1),
        "first_label": F.substring_index(host, ".", 1),
        "segment": F.regexp_extract(path, r"^/([^/]*)", 1),
    }
    return rows.withColumns(names)


def lexical(rows: DataFrame) -> DataFrame:
    """Features of ``url``, ``host`` and ``path``, but for the statistics."""
    url = F.coalesce(F.col("url"), F.lit(""))
    host, path = F.col("host"), F.col("path")
    length = F.greatest(F.length(url), F.lit(1)).cast("double")
    values = {
        "url_length": F.length(url).cast("double"),
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "depth": _counted(path, "/"),
        "labels": _counted(host, r"\."),
        "hyphens": _counted(host, "-"),
        "digit_ratio": _counted(url, "[0-9]") / length,
        "letter_ratio": _counted(url, "[A-Za-z]") / length,
        "host_entropy": _entropy(host),
        "path_entropy": _entropy(path),
        "parameters": _counted(url, r"[?&][^?&#=]+="),
        "fragment": F.instr(url, "#").cast("boolean").cast("double"),
        "secure": url.startswith("https").cast("double"),
    }
    return rows.withColumns(values)


class Statistic:
    """Urls and smoothed share of blocked ones by one key, over all urls.

    Of more than ``OFTEN_KEYS`` keys only those with more than that part of the
    pages are broadcast; the others have few rows each and are joined by exchange.
    """

    def __init__(self, known: DataFrame, name: str, prior: float, pages: int):
        self.name = name
        rate = (F.coalesce(F.sum("label"), F.lit(0)) + 4 * prior) / (F.count("label") + 4)
        counted = known.groupBy(name).agg(
            rate.alias(f"{name}_blocked"),
            F.count_if(F.col("pages") > 0).cast("double").alias(f"{name}_urls"),
            F.sum("pages").alias("key_pages"),
        )
        counted = stored(counted)
        often = F.col("key_pages") > pages / OFTEN_KEYS
        few = counted.count() <= OFTEN_KEYS
        self.often = (counted if few else counted.filter(often)).drop("key_pages")
        self.seldom = None if few else counted.filter(~often).drop("key_pages")

    def joined(self, rows: DataFrame) -> DataFrame:
        name, values = self.name, [f"{self.name}_blocked", f"{self.name}_urls"]
        rows = rows.join(F.broadcast(self.often), name, "left")
        if self.seldom is None:
            return rows
        # Rows that are served already go anywhere; no other key is frequent.
        rows = rows.withColumn("spread", F.when(F.col(values[0]).isNotNull(), F.monotonically_increasing_id()).otherwise(0))
        others = self.seldom.withColumnsRenamed({v: f"seldom_{v}" for v in values}).withColumn("spread", F.lit(0).cast("long"))
        rows = rows.join(others, [name, "spread"], "left")
        rows = rows.withColumns({v: F.coalesce(v, f"seldom_{v}") for v in values})
        return rows.drop("spread", *[f"seldom_{v}" for v in values])


class UrlModel:
    """Trees and the statistics they need, fitted on labelled urls."""

    def __init__(self, seen: DataFrame, sample_rows: int = SAMPLE_ROWS):
        """``seen(url, label, pages)``, label 1 for urls to block and 0 for others,
        pages 1 for rows of the pages and 0 for further labels; nulls are left
        out, repeated urls count once. Without labels nothing is blocked."""
        label = F.when(F.col("label").isin(0, 1), F.col("label")).cast("int")
        seen = seen.filter("url IS NOT NULL").select("url", label.alias("label"), F.col("pages").cast("long").alias("pages"))
        once = seen.groupBy("url").agg(F.max("label").alias("label"), F.sum("pages").alias("pages"))
        host, path = host_and_path(F.col("url"))
        known = stored(keyed(once.withColumns({"host": host, "path": path})))
        totals = known.agg(F.avg("label").alias("share"), F.sum("pages").alias("pages")).first()
        self.prior = float(totals["share"] or 0.0)
        self.statistics = [Statistic(known, n, self.prior, totals["pages"] or 0) for n in STATISTICS]
        sample = stored(known.filter("label IS NOT NULL").orderBy(F.xxhash64("url"), "url").limit(sample_rows))
        rows = self.features(sample).select("url", *FEATURES, "label").collect()  # at most sample_rows
        rows.sort()
        x = np.array([r[1:-1] for r in rows], np.float64).reshape(len(rows), len(FEATURES))
        self.start, self.trees = boost(x, np.array([r[-1] for r in rows], np.float64), rounds=12, depth=3)

    def features(self, rows: DataFrame) -> DataFrame:
        """All features; keys without labels have the overall share of blocked urls."""
        rows = keyed(rows)
        for statistic in self.statistics:
            rows = statistic.joined(rows)
        filled = {f"{n}_blocked": F.coalesce(f"{n}_blocked", F.lit(self.prior)) for n in STATISTICS}
        filled |= {f"{n}_urls": F.coalesce(f"{n}_urls", F.lit(0.0)) for n in STATISTICS}
        return lexical(rows.withColumns(filled))

    def score(self) -> Column:
        """The chance that a url is to be blocked, over the features."""
        if not self.trees:
            return F.lit(0.0)
        margin = reduce(lambda a, b: a + b, [F.lit(self.start), *(_compiled(t) for t in self.trees)])
        return 1 / (1 + F.exp(-margin))


def _compiled(tree: Split | Leaf) -> Column:
    if isinstance(tree, Leaf):
        return F.lit(float(tree.value))
    left = F.col(FEATURES[tree.feature]) <= tree.threshold
    return F.when(left, _compiled(tree.left)).otherwise(_compiled(tree.right))


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]] = RULES,
    labelled: DataFrame | None = None,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """A verdict for every row.

    Returns ``id_column``, ``host``, ``path``, ``rule`` (the longest that fits,
    else null), ``verdict`` (the rule's; else block where the trees give a
    chance of at least one half) and ``score``, that chance. Null urls and urls
    without ``://`` have an empty host and path. ``labelled(url, label)``
    defaults to the urls that a rule fits. Repeated rows are all returned;
    other columns are not read.
    """
    rows = pages.select(F.col(id_column).alias("id"), F.col(url_column).cast("string").alias("url"))
    host, path = host_and_path(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path})
    # Written first, here and below: what follows names these columns often,
    # and Spark would put their expressions in at each place.
    found = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = stored(rows.withColumn("found", found).select("*", "found.rule", F.col("found.verdict").alias("ruled")).drop("found"))
    if labelled is None:
        label = F.when(F.col("ruled").isNotNull(), (F.col("ruled") == "block").cast("int"))
        seen = rows.select("url", label.alias("label"), F.lit(1).alias("pages"))
    else:
        seen = rows.select("url", F.lit(None).cast("int").alias("label"), F.lit(1).alias("pages"))
        seen = seen.unionAll(labelled.select("url", F.col("label").cast("int"), F.lit(0).alias("pages")))
    model = UrlModel(seen)
    features = stored(model.features(rows).select("id", "host", "path", "rule", "ruled", *FEATURES))
    scored = features.withColumn("score", model.score())
    learned = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select(
        F.col("id").alias(id_column), "host", "path", "rule", F.coalesce("ruled", learned).alias("verdict"), "score"
    )
