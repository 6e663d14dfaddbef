"""The registered corpus queries against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline
import pytest
from compare import checking_engine, differences

from sleevework.llm.queries import CHECKS, QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_agrees_with_sql(spark, sf_dir, name):
    con = checking_engine(sf_dir)
    assert differences(spark, con, sf_dir, QUERIES[name], CHECKS[name]) == []
    con.close()


def test_pipeline_stages(spark, sf_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.saved(stage(spark, docs, sf_dir), "test")
        assert docs.columns == columns
        ids = Counter(r["doc_id"] for r in docs.select("doc_id").collect())
        if name == "quality":
            kept = [i for i in labels if i in ids]
            assert sum(labels[i] == 1 for i in kept) >= 0.98 * sum(labels.values())
            assert sum(labels[i] == 0 for i in kept) <= 0.1 * sum(v == 0 for v in labels.values())
        if name != "mixing":
            assert set(ids.values()) == {1} and len(ids) <= before
            before = len(ids)
        else:
            assert max(ids.values()) <= 2
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == set(ids)


def test_pipeline_dedup_stages_against_a_plain_computation(spark, sf_dir):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    best: dict = {}
    for doc in sorted(texts, key=lambda d: (-len(texts[d]), d)):
        best.setdefault(re.sub(r"[\x20\x09-\x0D]+", "", texts[doc]), doc)
    got = {r["doc_id"] for r in stages["exact_dedup"](spark, docs, sf_dir).select("doc_id").collect()}
    assert got == set(best.values()) and len(got) < len(texts)

    sets = {}
    for doc, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
        sets[doc] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r["doc_id"] for r in stages["near_dedup"](spark, docs, sf_dir).select("doc_id").collect()}
    assert got == {doc for doc in sets if find(doc) == doc} and len(got) < len(texts)
