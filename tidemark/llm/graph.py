"""Connected components of an edge list, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.data import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, of all nodes in ``edges(a, b)``.

    Each round takes the smallest label among a node and its neighbours; from
    the third on also the label of that label, so that long paths take a number
    of rounds that grows with their logarithm. Labels are written after each
    round; none has changed when their sum is the same. Null ends and repeated
    edges change nothing.

    The rounds run over fewer edges: of the ends ``a`` that a ``b`` is linked
    with, it keeps the smallest, and the others are linked with that one, which
    is the same for most of a dense group.
    """
    edges = edges.filter("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    least = F.min("a").over(Window.partitionBy("b"))
    ends = [F.struct(F.col(x).alias("a"), F.col("least").alias("b")) for x in ("b", "a")]
    edges = edges.withColumn("least", least).select(F.inline(F.array(*ends))).distinct()
    ends = [F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in ("ab", "ba", "aa", "bb")]
    both = stored(edges.select(F.inline(F.array(*ends))))
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")))
    before, rounds = _total(labels), 0
    while True:
        new = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("component"))
        )
        if rounds >= 2:  # a label is itself a node, so its own label is a step further down
            further = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
            new = new.join(further, "component").select("node", F.least("component", "further").alias("component"))
        labels = stored(new)
        now, rounds = _total(labels), rounds + 1
        if now == before:
            return labels
        before = now


def _total(labels: DataFrame):
    return labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
