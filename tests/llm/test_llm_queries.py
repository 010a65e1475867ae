"""The registered queries over whole small tables, and the pipeline against its parts."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from oracle import compare, connect  # noqa: E402

import corpus_pipeline  # noqa: E402
from feedloom.llm import queries  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not there")
COLUMNS = {
    "op1_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op2_pii_surrogates": ["doc_id", "text", "n_entities"],
    "op3_simhash": ["doc_id", "fingerprint", "component_id"],
    "op4_chat_format": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op5_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op6_toxicity": ["doc_id", "held_out", "score", "predicted", "evidence"],
    "op7_decontaminate": ["doc_id", "item_id", "distance", "allowed"],
    "op8_embeddings": ["vec_id", "n_links", "component_id", "kept"],
    "op9_urls": ["page_id", "host", "path", "rule", "verdict", "host_words", "log_odds"],
    "op10_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op11_ranked_search": ["item_id", "rank", "doc_id", "score"],
    "op13_lm_scores": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op12_filter_audit": [
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    ],
}


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, name):
    found = queries.QUERIES[name](spark, SF_DIR)
    assert found.columns == COLUMNS[name]
    rows = {"op4": "conversations", "op7": None, "op11": None, "op12": None, "op8": "embeddings", "op9": "pages"}.get(name.split("_")[0], "documents")
    if name.startswith("op4"):
        assert found.count() == spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id").distinct().count() + 1
    elif rows:
        assert found.count() == spark.read.parquet(f"{SF_DIR}/{rows}.parquet").count()


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_twin(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, queries.QUERIES[name], queries.ORACLE[name]) is None


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    counts = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == docs.columns
        path = f"{spark.conf.get('spark.checkpoint.dir')}/pipeline-{len(counts)}"
        kept.write.parquet(path)
        docs = spark.read.parquet(path)
        counts.append(docs.count())
    assert counts[0] >= counts[1] >= counts[2] > 100
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    same = sorted(map(tuple, last.collect())) == sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect()))
    assert same and last.count() == counts[-1]


def test_pipeline_without_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SF_DIR)
        assert result.count() == 0
