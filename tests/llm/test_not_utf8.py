"""Texts that are not valid UTF-8 pass through every operator that reads them in Python, with a replacement character."""

from __future__ import annotations

import public_tokenizers
import pytest

from feedloom.llm import chat, decontaminate, simhash, tokens, toxicity


@pytest.fixture
def docs(spark):
    return spark.sql(
        "SELECT 1L AS doc_id, cast(X'776F726420FF206F6E65' AS string) AS text UNION ALL SELECT 2L, 'word \\ufffd one' UNION ALL SELECT 3L, 'other'"
    )


def test_counts_and_fingerprints(docs):
    counts = {r["doc_id"]: r["n_tokens"] for r in tokens.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()}
    assert counts[1] == counts[2]
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 3}
    assert sorted(r["doc_id"] for r in simhash.one_of_each(docs).collect()) == [1, 3]


def test_search_and_votes(spark, docs):
    items = spark.createDataFrame([(1, "word one")], "item_id long, text string")
    assert {r["doc_id"] for r in decontaminate.contaminated(docs, items).collect()} == {1, 2}
    assert [r["doc_id"] for r in decontaminate.clean(docs, items).collect()] == [3]
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert toxicity.scored(docs, model).count() == 3 and toxicity.accepted(docs, model).count() <= 3


def test_chat(docs):
    turns = docs.selectExpr("doc_id AS conv_id", "0 AS turn", "'assistant' AS role", "text")
    found = chat.digests(chat.formatted(turns, public_tokenizers.path("byte_bpe_50k.json"))).collect()
    assert {r["conv_id"]: r["loss_chars"] for r in found}[1] == 10
