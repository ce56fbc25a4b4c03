"""The registered queries of the operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    chat,
    decontaminate,
    licenses,
    lmscore,
    neardup,
    periodic,
    quality,
    sentencepiece,
    spotsigs,
    tokencount,
    toxicity,
    trie,
    urls,
)
from tidemark.llm.data import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls, empty texts, ties, repeated rows and empty tables as in ``score_documents``."""
    return lmscore.score_documents(table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """``model``: path of a SentencePiece model the driver can read."""
    return sentencepiece.encode_decode(table(spark, sf_dir, "documents"), read_model(model), with_text=False)


def read_model(path: str | None = None) -> bytes:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return f.read()


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls, empty texts, ties, repeated rows and empty tables as in ``judge_urls``."""
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls, empty texts, ties, repeated rows and empty tables as in ``find_items``."""
    return decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls, empty texts, ties, repeated rows and empty tables as in ``near_duplicates``."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls, empty texts, ties, repeated rows and empty tables as in ``score_toxicity``."""
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls, empty texts, ties, repeated rows and empty tables as in ``score_quality``."""
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls, empty texts, ties, repeated rows and empty tables as in ``scan_licenses``."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("blocks")


def op9_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls, empty texts, ties, repeated rows and empty tables as in ``compare_edited``."""
    return spotsigs.compare_edited(table(spark, sf_dir, "documents"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls, empty texts, ties, repeated rows and empty tables as in ``render``."""
    return chat.rendered_digest(table(spark, sf_dir, "conversations"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of the rebuilt conversations. Nulls, repeated rows and conversations
    without turns as in ``numbered``, ``rebuilt`` and ``prefix_trie``."""
    turns, members = trie.rebuilt(trie.numbered(table(spark, sf_dir, "conversations")))
    return trie.prefix_trie(turns, members).drop("p1", "p2")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the documents, one in ten of them made periodic. Nulls, empty texts
    and repeated rows as in ``planted`` and ``find_runs``."""
    return periodic.run_digest(periodic.find_runs(periodic.planted(table(spark, sf_dir, "documents"))))


def op13_token_counts(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """``model``: path of a SentencePiece model the driver can read. Nulls, empty
    texts and repeated rows as in ``count_tokens``."""
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), read_model(model))


QUERIES: dict[str, Query] = {
    "op1_lm_scores": op1_lm_scores,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_url_filters": op3_url_filters,
    "op4_decontamination": op4_decontamination,
    "op5_minhash": op5_minhash,
    "op6_toxicity": op6_toxicity,
    "op7_quality": op7_quality,
    "op8_licenses": op8_licenses,
    "op9_spotsigs": op9_spotsigs,
    "op10_chat": op10_chat,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_token_counts": op13_token_counts,
}

ORACLES: dict[str, str] = {
    "op8_licenses": licenses.oracle(),
    "op10_chat": chat.ORACLE,
    "op11_prefix_trie": trie.ORACLE,
}
