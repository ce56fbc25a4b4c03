import duckdb
import pytest

import __spark_entry__ as entry
import check
import corpus_pipeline
from tidemark.llm import decontaminate, neardup, quality, toxicity
from tidemark.llm.data import stored, table
from tidemark.llm.queries import QUERIES, op2_sentencepiece

SF = "/root/testdata/sf0.001"


def test_stages_do_what_their_operators_say(spark):
    docs = table(spark, SF, "documents")
    labels, items = table(spark, SF, "labels"), table(spark, SF, "benchmark")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(stored(stage(spark, kept[-1], SF)))
        if name != "encoding":
            assert kept[-1].columns == docs.columns
    ids = [{r["doc_id"] for r in k.select("doc_id").collect()} for k in kept]
    good = quality.score_quality(docs, labels).filter("predicted = 1").collect()
    assert ids[1] == {r["doc_id"] for r in good}
    clean = toxicity.score_toxicity(kept[1], labels).filter("predicted = 0").collect()
    assert ids[2] == {r["doc_id"] for r in clean}
    groups = neardup.near_duplicates(kept[2]).collect()
    assert ids[3] == {r["doc_id"] for r in groups if r["kept"]}
    hit = {r["doc_id"] for r in decontaminate.find_items(kept[3], items).collect()}
    assert ids[4] == ids[3] - hit
    coded = {r["doc_id"]: tuple(r) for r in op2_sentencepiece(spark, SF).collect()}
    assert {tuple(r) for r in kept[5].collect()} == {coded[i] for i in ids[4]}
    assert {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()} == {tuple(r) for r in kept[5].collect()}


def test_stages_take_no_rows(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []


def test_registered():
    names = entry.queries().keys()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert "pipeline" in names and set(QUERIES) <= set(names)


@pytest.mark.parametrize("name", ["op8_licenses", "op10_chat"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = entry.queries()[name](spark, SF).toPandas()
    assert check.difference(got, con.execute(entry.oracle_sql()[name]).df()) is None
