"""The index against all pairs, and scores on held-out rows."""

from __future__ import annotations

import random
import zlib

import pytest

from feedloom.llm import toxicity

SCHEMA = "doc_id bigint, text string, score int, predicted string, toxic int"


def test_index_is_exact():
    random.seed(1)
    vectors = []
    for _ in range(500):
        some = {random.randrange(40): random.random() for _ in range(random.randint(0, 6))}
        length = sum(x * x for x in some.values()) ** 0.5
        vectors.append({term: x / length for term, x in some.items()})
    index = toxicity.BlockMaxIndex(vectors, 40)
    for query, vector in enumerate(vectors[:200]):
        cosines = [(sum(x * other.get(term, 0.0) for term, x in vector.items()), -i) for i, other in enumerate(vectors) if i != query]
        expected = sorted((pair for pair in cosines if pair[0] > 0), reverse=True)[:10]
        found = index.nearest(vector, 10, without=query)
        assert [cosine for cosine, _ in found] == pytest.approx([cosine for cosine, _ in expected])
    assert index.nearest({}, 10) == [] and toxicity.BlockMaxIndex([], 3).nearest({1: 1.0}, 10) == []


def corpus(n):
    random.seed(4)
    words = [a + b for a in ("th", "er", "on", "in", "an", "sh", "ble") for b in ("the", "ion", "es", "ou", "at")]
    bad = ["vile", "rotten", "zzachen", "zzaches", "zzacher"]
    for i in range(n):
        text = random.choices(words, k=random.randint(5, 80))
        toxic = i % 9 == 0
        for _ in range(4 if toxic else 0):
            text.insert(random.randrange(len(text)), random.choice(bad).upper())
        yield i, " ".join(text), int(toxic)


def test_held_out_rows(spark):
    rows = list(corpus(1500))
    docs = spark.createDataFrame([(i, text, 0, "", 0) for i, text, _ in rows], SCHEMA)
    labels = spark.createDataFrame([(i, 1, toxic) for i, _, toxic in rows], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    found = {r["doc_id"]: r for r in toxicity.scored(docs, model).collect()}
    held = [(i, toxic) for i, _, toxic in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i, r in found.items() if r["held_out"]} == {i for i, _ in held}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found.values())
    assert sum(found[i]["predicted"] == toxic for i, toxic in held) / len(held) > 0.99
    changed = spark.createDataFrame([(i, 1, 1 - toxic if i in dict(held) else toxic) for i, _, toxic in rows], labels.schema)
    again = toxicity.scored(docs, toxicity.fit(docs, changed)).collect()
    assert {r["doc_id"]: r["score"] for r in again} == {i: r["score"] for i, r in found.items()}
    kept = toxicity.accepted(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in found.items() if not r["predicted"]}


def test_every_telling_term_counts(spark):
    words = sorted(f"{a}{b}{c}" for a in "abcdefghijklm" for b in "nopqrstuvwxyz" for c in "abcdefghijklmno")
    rows = [(i, " ".join(words) if i % 2 else "plain talk", 0, "", 0) for i in range(60)]
    docs = spark.createDataFrame([*rows, (100, " ".join(words[-20:]), 0, "", 0)], SCHEMA)
    model = toxicity.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, toxic int"))
    assert set(words) <= set(model.vocabulary.place) and len(words) > 2500
    found = {r["doc_id"]: r for r in toxicity.scored(docs, model).collect()}
    assert len(found[100]["evidence"]) == 10 and all(i % 2 for i in found[100]["evidence"])


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a", 0, "", 0), (1, None, 0, "", 0), (1, "b", 0, "", 0), (2, "", 0, "", 0), (3, "x" * 100_000, 0, "", 0)], SCHEMA)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (3, 1), (None, 1), (7, 1)], "doc_id bigint, toxic int")
    for some in (labels, labels.limit(0)):
        model = toxicity.fit(docs, some)
        rows = toxicity.scored(docs, model).collect()
        assert len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows)
        assert toxicity.scored(docs.limit(0), model).count() == 0
    assert toxicity.fit(docs.limit(0), labels).ids == []


def test_calibration_grows():
    model = toxicity.Model([], [], [1, 2], [0, 1], [{}, {}])
    random.seed(1)
    model.calibrate([(x, int(random.random() < x**2)) for x in (random.random() for _ in range(2000))])
    scores = [model.score(i / 50) for i in range(51)]
    assert scores == sorted(scores) and abs(model.score(0.8) - 0.64) < 0.1
