"""Scores against the smoothing formulas over dictionaries, and the defined cases."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from feedloom.llm import language_model
from feedloom.llm.language_model import Automaton, Chunk, packed, scores, unpacked

DOCS = "doc_id bigint, text string, score string"


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 5 == 1


def by_hand(docs, order, strength=500.0):
    """Probabilities from counts of runs, by the recursive formula, without states or arcs."""
    runs, single = Counter(), Counter()
    for doc, text, *_ in docs:
        if not held(doc):
            line = ["<start>", *tokens(text), "<end>"]
            single.update(line[1:])
            for k in range(1, order):
                runs.update(tuple(line[i : i + k]) for i in range(len(line) - k))  # as histories
            for k in range(2, order + 1):
                runs.update(("run", *line[i : i + k]) for i in range(len(line) - k + 1))
    n, types = sum(single.values()), len(single)

    def chance(word, history):
        if not history:
            return (single[word] + 0.5) / (n + 0.5 * (types + 1))
        shorter = chance(word, history[1:])
        seen = runs[history]
        return (runs[("run", *history, word)] + strength * shorter) / (seen + strength) if seen else shorter

    rows = []
    for doc, text, *_ in docs:
        line = ["<start>", *tokens(text), "<end>"]
        score = sum(math.log10(chance(line[i], tuple(line[max(0, i - order + 1) : i]))) for i in range(1, len(line)))
        base = sum(math.log10(chance(word, ())) for word in line[1:])
        rows.append((doc, held(doc), len(line) - 1, sum(single[word] > 0 for word in line[1:]), n, base, score))
    return rows


def same(found, expected):
    key = lambda row: (row[0] is None, row[0] or 0, row[2], row[5])
    found, expected = sorted(map(tuple, found), key=key), sorted(expected, key=key)
    assert [row[:5] for row in found] == [row[:5] for row in expected]
    for a, b in zip(found, expected, strict=True):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-12)


def some(n, seed=3):
    rng = random.Random(seed)
    words = ["The", "a", "of", "x.y", "É", "b c", "z" * 50, *(f"w{i}" for i in range(30))]
    return [(i, " ".join(rng.choice(words[: rng.choice([5, 37])]) for _ in range(rng.randrange(0, 40))), "q") for i in range(n)]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_against_formulas(spark, monkeypatch, order):
    monkeypatch.setattr(language_model, "CHUNK_BYTES", 3_000)
    monkeypatch.setattr(language_model, "GROUP_BYTES", 10_000)
    docs = some(300)
    found = scores(spark.createDataFrame(docs, DOCS).repartition(3), order=order).collect()
    same(found, by_hand(docs, order))
    assert any(row["held_out"] and row["n_known"] < row["n_tokens"] or order for row in found)


def test_defined_cases(spark):
    docs = [(1, None, "x"), (None, "a b", None), (None, "a b", None), (2, "", "x"), (3, " \t\x0b ", "x"), (4, "A b\x1cc", "x"),
            (4, "A b", "x"), (7, "unseen words", "x"), (11, "long word " * 50_000, "x"), (12, "w" * 100_000, "x")]
    assert any(held(doc) for doc, *_ in docs) and not all(held(doc) for doc, *_ in docs)
    same(scores(spark.createDataFrame(docs, DOCS)).collect(), by_hand(docs, 2))


def test_empty_table_and_nothing_learned(spark):
    docs = spark.createDataFrame(some(3), DOCS)
    assert scores(docs.limit(0)).count() == 0
    only = [(i, "a b", "x") for i in range(60) if held(i)]
    row = scores(spark.createDataFrame(only, DOCS)).first()
    assert row["train_tokens"] == 0 and row["n_known"] == 0 and row["base_score"] == 0 and row["score"] == 0


def test_text_that_is_not_utf8(spark):
    docs = spark.sql("SELECT 4L AS doc_id, cast(X'61FF2062' AS string) AS text UNION ALL SELECT 5L, 'b'")
    assert sorted(row["n_tokens"] for row in scores(docs).collect()) == [2, 3]


def test_pieces_of_long_texts(spark, monkeypatch):
    docs = some(40)
    whole = [tuple(row) for row in scores(spark.createDataFrame(docs, DOCS)).collect()]
    monkeypatch.setattr(language_model, "_PIECE", 16)
    assert [words for text in ("ab  cd " * 9, "", "x" * 40) for words in [sum(language_model.pieces(text.encode()), [])]] == [
        [b"ab", b"cd"] * 9, [], [b"x" * 40]
    ]
    same(whole, by_hand(docs, 2))


def test_probabilities_of_all_words_sum_to_one():
    """In every state: the words of the model, an end and one unknown word, walked as texts of their own."""
    learned = [b"a b a c a b", b"b b a", b""]
    for history in (b"", b"a", b"a b", b"c a", b"unknown", b"a unknown"):
        nexts = [history + b" " + word for word in (b"a", b"b", b"c", b"unknown")]
        texts = [*learned, history, *nexts]
        chunk = Chunk(texts, 3, 2)
        counts = [chunk.counts(k, np.arange(len(texts)) < 3) for k in range(3)]
        model = Automaton(chunk, counts, 12, 4, 3, 2.0)
        weight, state = model.walk()
        last = [weight[chunk.begin[4 + i + 1] - 2] for i in range(4)]  # the step to the last word
        end = weight[chunk.begin[4] - 1]
        assert sum(10**x for x in [*last, end]) == pytest.approx(1)
        assert state[chunk.begin[4] - 1] == 0  # an end leads nowhere


def test_states_and_failure_arcs():
    chunk = Chunk([b"a b a b c", b"a b d"], 3, 0)
    model = Automaton(chunk, [chunk.counts(k, np.array([True, False])) for k in range(3)], 6, 4, 1, 2.0)
    number = {word: i for i, word in enumerate(chunk.words)}
    weight, state = model.walk()
    arcs, weights, begins, fails, _ = model.levels[1]
    run = chunk.of[2][chunk.begin[1] + 3]  # a b d, which was not seen
    assert not arcs[run] and begins[run] == state[chunk.begin[1] + 2] > 0  # from the state of a b
    below = chunk.of[1][chunk.begin[1] + 3]  # b d
    assert not model.levels[0][0][below]
    expected = fails[run] + model.levels[0][3][below] + model.root[number[b"d"]]
    assert weight[chunk.begin[1] + 3] == pytest.approx(expected) and fails[run] == pytest.approx(math.log10(2 / (2 + 2)))
    assert state[chunk.begin[1] + 3] == 0


def test_packing():
    numbers = np.array([0, 1, 255, 256, 2**40, 2**64 - 1], np.uint64)
    assert unpacked(packed(numbers)).tolist() == numbers.tolist() and not len(unpacked(packed(numbers[:0])))
