"""The pipeline: what each stage may and may not do, and its last rows against the libraries."""

import base64

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from brightledger.llm import common

from .test_group_operators import brute_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder, docs, out = tmp_path_factory.mktemp("pipeline"), common.table(spark, SF, "documents"), []
    out.append(docs)
    for i, (_, fn) in enumerate(corpus_pipeline.STAGES):
        fn(spark, docs, SF).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        out.append(docs)
    return out


def test_columns_stay_until_the_last_stage(stages):
    assert all(x.columns == stages[0].columns for x in stages[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "minhash_near_dedup", "benchmark_decontamination", "byte_bpe"]


def test_each_stage_keeps_rows_of_the_one_before(stages):
    ids = [{r["doc_id"] for r in x.select("doc_id").collect()} for x in stages]
    assert all(b <= a for a, b in zip(ids, ids[1:])) and len(ids[-1]) > 0.4 * len(ids[0])
    assert ids[4] == ids[5]


def test_one_of_each_group_is_left(stages):
    before = [(r["doc_id"], r["text"]) for r in stages[2].collect()]
    want = {i for i, (c, _) in brute_components(before, 80).items() if i == c}
    assert {r["doc_id"] for r in stages[3].collect()} == want


def test_no_benchmark_item_is_left_whole(stages, spark):
    items = [r["text"] for r in common.table(spark, SF, "benchmark").collect()]
    assert not any(b in (r["text"] or "") for r in stages[4].collect() for b in items)


def test_lengths_follow_the_text(stages):
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2].collect() if r["text"] is not None)


def test_tokens_are_the_librarys_and_decode(stages):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    before = {r["doc_id"]: r["text"] or "" for r in stages[4].collect()}
    for r in stages[5].collect():
        assert r["text"] == before[r["doc_id"]] and list(r["ids"]) == lib.encode_ordinary(r["text"]) and r["n_tokens"] == len(r["ids"])


def test_registered_query_is_run(spark):
    import __spark_entry__

    assert "pipeline" in __spark_entry__.queries()
    assert sum(n.startswith("op") and n[2].isdigit() for n in __spark_entry__.queries()) == 13
