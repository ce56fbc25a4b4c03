"""Bounded samples of labelled rows, and folds by id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_column).cast("string")) % folds


def training_sample(labels: DataFrame, label: str, folds: int, held_out: int, rows: int) -> DataFrame:
    """At most ``rows`` rows (doc_id, label 0 or 1) outside the held-out fold.

    Which rows are taken depends on a hash of the id alone. Rows without an id
    or label are left out; of repeated ids the smallest label counts.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label"))
    known = known.filter("doc_id IS NOT NULL AND label IN (0, 1)").filter(fold("doc_id", folds) != held_out)
    once = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    return once.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
