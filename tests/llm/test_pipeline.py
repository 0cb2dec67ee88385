"""The corpus pipeline, stage by stage."""

from __future__ import annotations

import re

import corpus_pipeline
from tests.llm.tables import no_documents, odd_documents
from tests.llm.test_operators import slow_groups, slow_spans
from tradescribe.llm.tables import stored

SF_DIR = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), f"test-{name}")
        kept[name] = docs
        assert name == "packing" or docs.columns == names
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").where("toxic = 1").collect()}
    before = {r.doc_id for r in kept["toxicity"].collect()}
    assert len(before & toxic) < 0.45 * len(toxic) and len(before) > 900
    language = kept["language"].collect()
    assert len(language) >= 0.99 * len(before)
    groups = slow_groups([(r.doc_id, r.text) for r in language])
    assert {r.doc_id for r in kept["near_copies"].collect()} == {d for d, (_, c) in groups.items() if c == d}
    texts = {r.doc_id: r.text for r in kept["near_copies"].collect()}
    for r in kept["secrets"].collect():
        assert not slow_spans(r.text) and r.n_chars == len(r.text)
        assert bool(slow_spans(texts[r.doc_id])) == (r.text != texts[r.doc_id])
        assert len(re.sub(r"\[secret\]", "", r.text)) <= len(texts[r.doc_id])
    pieces = kept["packing"].collect()
    assert {r.doc_id for r in pieces} == set(texts)


def test_odd_and_empty_documents(spark):
    for docs in (odd_documents(spark), no_documents(spark)):
        names = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SF_DIR), f"test-{name}")
            assert name == "packing" or docs.columns == names
