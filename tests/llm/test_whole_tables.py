"""The registered queries over whole tables against plain Python, and their SQL on DuckDB."""

import os
import sys

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import plain  # noqa: E402
from compare import compare, connect  # noqa: E402

from changeflow.llm.oracle import ORACLE_SQL  # noqa: E402
from changeflow.llm.queries import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def documents(sf_dir):
    table = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"])
    return list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True))


@pytest.fixture(scope="module")
def encoded(documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {i: tokenizer.encode(t or "", add_special_tokens=False).ids for i, t in documents}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), sf_dir, name, QUERIES[name], ORACLE_SQL[name]) == ""


def test_ngram_join(spark, sf_dir, documents):
    want = plain.jaccard(documents, 3, 90)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op2_ngram_join"](spark, sf_dir).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) < len(want)


def test_packing(spark, sf_dir, documents, encoded):
    rows = QUERIES["op4_best_fit_packing"](spark, sf_dir).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by_doc) == set(encoded)
    for doc_id, pieces in by_doc.items():
        ids, at = [*encoded[doc_id], 0], 0
        for k, r in enumerate(sorted(pieces, key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at)
            assert r["ids_crc32"] == plain.crc(ids[at : at + r["length"]])
            assert r["length"] == 2048 or k == 0
            at += r["length"]
        assert at == len(ids)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    least = -(-sum(len(i) + 1 for i in encoded.values()) // 2048)
    assert len(by_sequence) <= least * 1.02 + 1


def test_secrets(spark, sf_dir, documents):
    got = {r["doc_id"]: r for r in QUERIES["op5_secret_scan"](spark, sf_dir).collect()}
    for doc_id, text in documents:
        *counts, base = plain.secrets(text)
        r = got[doc_id]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == counts
        assert r["base_sha256"] == plain.sha(base)
        assert set(filter(None, base.split(","))) <= set(r["spans"].split(","))


def test_toxicity_of_held_out_rows(spark, documents):
    sf_dir = "/root/testdata/sf0.01"
    labels = pq.read_table(f"{sf_dir}/labels.parquet").to_pydict()
    toxic = dict(zip(labels["doc_id"], labels["toxic"], strict=True))
    rows = [r for r in QUERIES["op6_toxicity"](spark, sf_dir).collect() if r["held_out"] and r["doc_id"] in toxic]
    wrong = [r for r in rows if r["predicted"] != toxic[r["doc_id"]]]
    assert len(rows) > 60 and len(wrong) <= 0.05 * len(rows)


def test_token_files(spark, sf_dir, encoded):
    got = {r["doc_id"]: r for r in QUERIES["op8_token_files"](spark, sf_dir).collect()}
    start = 0
    for doc_id in sorted(encoded):
        ids = [*encoded[doc_id], 2]
        r = got[doc_id]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), plain.crc(ids))
        start += len(ids)
    assert len(got) == len(encoded)


def test_phrase_dedup(spark, sf_dir, documents):
    got = [tuple(r) for r in QUERIES["op10_phrase_dedup"](spark, sf_dir).collect()]
    assert sorted(got) == sorted(plain.repeats(documents, 50))
    assert any(r[2] for r in got)


def test_pipeline(spark, sf_dir):
    """Each stage on its own input: what it drops and keeps, and what the last one packs."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        after = stage(spark, docs, sf_dir)
        left = {r["doc_id"] for r in after.collect()}
        assert left <= {i for i, _ in before}
        if name == "exact dedup":
            assert left == {best for _, best, _, _ in plain.exact(before, min)}
        if name == "n-gram jaccard join":
            want = plain.jaccard(before, 5, 80)
            assert left == {c for _, c in want.values()}
        if name == "benchmark decontamination":
            items = pq.read_table(f"{sf_dir}/benchmark.parquet")["text"].to_pylist()
            assert not any(item in text for i, text in before if i in left for item in items)
        if name == "best-fit packing":
            assert left == {i for i, _ in before}
        docs = after
