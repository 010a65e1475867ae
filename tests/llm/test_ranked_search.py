"""Ranked search against scoring every document, on small shards, and its defined cases."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from feedloom.llm import ranked_search
from feedloom.llm.ranked_search import BLOCK, Shard, ranked

DOCS = "doc_id bigint, text string, score string"
ITEMS = "item_id bigint, text string, rank string"
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return _TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_hand(docs, items, k=10):
    texts = [(doc, Counter(terms(text))) for doc, text, _ in docs]
    texts = [(doc, counts, sum(counts.values())) for doc, counts in texts if counts]
    n_docs, total = len(texts), sum(n for _, _, n in texts)
    held = Counter(term for _, counts, _ in texts for term in counts)
    rows = []
    for item, text in {(item, text) for item, text, _ in items}:
        found = []
        for doc, counts, n in texts:
            m = 100 - 75 + 75 * n * n_docs // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1))) * (1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * m))
                for t in terms(text)
                if t in counts
            )
            if score > 0:
                found.append((-score, doc is None, doc))
        found.sort()
        rows += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(found[:k], 1)]
    return sorted(rows, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def some(seed, n):
    """Texts of common and rare words, with copies."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["Été", "x-y", "a1"]
    texts = [" ".join(words[min(int(rng.expovariate(0.03)), 302)] for _ in range(rng.randrange(0, 60))) for _ in range(n)]
    return [(i * 7 % (n * 2), texts[i if rng.random() < 0.7 else i // 2], "x") for i in range(n)]


@pytest.mark.parametrize("postings", [50, 3_000, 2_000_000])
def test_against_scoring_everything(spark, monkeypatch, postings):
    monkeypatch.setattr(ranked_search, "SHARD_POSTINGS", postings)
    docs = some(postings, 600)
    items = [(i, f"{docs[i * 13][1]} {docs[i * 29][1]} unseen", "y") for i in range(15)]
    found = rows_of(ranked(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS)))
    assert found == by_hand(docs, items) and len(found) >= 100


def test_defined_cases(spark):
    docs = [(3, "Same text, here", "x"), (1, "same TEXT here", "x"), (None, "same text here", None), (2, None, "x"), (4, "", "x"),
            (5, "?!", "x"), (1, "same text here", "x"), (6, "other \x00 words \x7f été", "x"), (7, "ÉTÉ", "x"), (8, "other " * 100_000, "x")]
    items = [(1, "text text HERE", "y"), (None, "other words", "y"), (2, "nothing known", "y"), (3, None, "y"), (4, "", "y"),
             (1, "text text HERE", "z"), (5, "été", "y"), (5, "ÉTÉ", "y")]
    found = rows_of(ranked(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)))
    assert found == by_hand(docs, items)
    assert [row[2] for row in found if row[0] == 1] == [1, 1, 3, None]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b", "x")], DOCS), spark.createDataFrame([(1, "a", "y")], ITEMS)
    assert ranked(docs.limit(0), items).count() == 0 and ranked(docs, items.limit(0)).count() == 0
    assert ranked(docs.where("text = ''"), items).columns == ["item_id", "rank", "doc_id", "score"]


def test_queries_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "QUERY_CHARACTERS", 40)
    docs = some(1, 100)
    items = [(i, docs[i * 9][1], "y") for i in range(6)]
    assert rows_of(ranked(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), 3)) == by_hand(docs, items, 3)


def test_text_that_is_not_utf8(spark):
    docs = spark.sql("SELECT 1L AS doc_id, cast(X'61FF62' AS string) AS text UNION ALL SELECT 2L, 'a b'")
    found = ranked(docs, spark.createDataFrame([(1, "b", "y")], ITEMS)).collect()
    assert [row["doc_id"] for row in found] == [2]


def test_blocks_out_of_reach_are_passed_over():
    """The best documents stand first; the rest of a long list is not scored."""
    n = 100 * BLOCK
    gain = np.full(n, 5, np.int64)
    gain[:20] = 9
    shard = Shard(n, np.arange(n), np.zeros(n, np.int64), gain, 1)
    visited = []
    score = shard._score
    shard._score = lambda blocks, *rest: visited.extend(blocks.tolist()) or score(blocks, *rest)
    scores, docs = shard.best([(0, 1)], 10)
    assert scores.tolist() == [9] * 10 and docs.tolist() == list(range(10)) and visited == [0, 1, 2, 3]
