"""Registered queries of the training-data subpackage: against their SQL, and the pipeline against its stages by brute force."""

import base64
import hashlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from oracle import connect, differences

import __spark_entry__ as entry
import corpus_pipeline
from premia.llm import mixing, pii, queries, rules

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables absent")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, name):
    assert differences(spark, connect(SF), SF, entry.queries()[name], queries.SQL[name]) is None


def test_all_are_registered():
    assert queries.QUERIES.keys() <= entry.queries().keys() and queries.SQL.keys() <= entry.oracle_sql().keys()
    assert {n.split("_")[0] for n in queries.QUERIES} == {"pipeline"} | {f"op{i}" for i in range(1, 14)}


def word_shingles(text, size=5):
    words = text.encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_pipeline_rows(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = {r["doc_id"] for r in rules.judge(docs).where("kept").collect()}
    sets = {i: word_shingles(texts[i]) for i in good}
    alike = [(a, b) for a in good for b in good if a < b and jaccard(sets[a], sets[b]) >= 0.8]
    low = {i: i for i in good}
    while any(low[a] != low[b] for a, b in alike):
        for a, b in alike:
            low[a] = low[b] = min(low[a], low[b])
    kept = {i for i in good if low[i] == i}
    assert {r["doc_id"] for r in got} == kept and len(got) == len(kept)
    path = public_tokenizers.path(corpus_pipeline.VOCABULARY)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    hidden = {r["doc_id"]: r["text"] for r in pii.scan(docs).collect()}
    for r in got:
        ids = plain.encode_ordinary(hidden[r["doc_id"]])
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(hidden[r["doc_id"]].encode()).hexdigest()


def test_stages_return_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
    ordered = [r["doc_id"] for r in mixing.interleave(docs).collect()]
    assert ordered == [r["doc_id"] for r in mixing.mix(docs).orderBy("slot", "rank").collect()]
