"""The pipeline end to end, and its queries' registration."""

import re

import __spark_entry__ as entry
import corpus_pipeline

SF = "/root/testdata/sf0.001"
BLANK = re.compile(r"[\x20\x09-\x0D]+")


def test_registered_queries():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names


def test_pipeline_stages(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF).checkpoint()
        assert after.columns == columns, name
        rows = after.collect()
        if name == "language":
            assert len(rows) == docs.count()
        if name == "exact":
            texts = [BLANK.sub(" ", r.text) for r in rows]
            assert len(set(texts)) == len(texts) and len(set(BLANK.sub(" ", r.text) for r in docs.collect())) == len(texts)
        if name == "near":
            assert len({r.doc_id for r in rows}) == len(rows) <= before.count()
        before = after
    final = corpus_pipeline.STAGES[-1][1](spark, before, SF).collect()
    want = sorted((r.doc_id, tuple(library.encode(r.text, add_special_tokens=False).ids)) for r in before.collect())
    assert sorted((r.doc_id, tuple(r.ids)) for r in final) == want


def test_pipeline_of_odd_rows(spark, odd):
    docs = odd.withColumnRenamed("id", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).checkpoint()
    assert docs.count() > 0
