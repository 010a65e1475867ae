"""Token counts against the tokenizers library."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from feedloom.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
LETTERS = "ab 'sT1 \n\t\x1c\x85\xa0éß漢字½٣ः𝟘😀՘࢏🫨  ​﻿"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_any_text(library):
    random.seed(5)
    count = tokens.merger(PATH).count
    for _ in range(3000):
        text = "".join(random.choices(LETTERS, k=random.randint(0, 25)))
        if random.random() < 0.2:
            text = text[:5] + "<|endoftext|>" + text[5:]
        assert count(text) == library(text), text


def test_long_word_and_forgetting(library, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    count = tokens.Merger(PATH).count
    for text in ("a" * 20_000, "one two three four five six seven eight " * 20):
        assert count(text) == library(text)


def test_rows(spark, library):
    long = "word " * 600
    rows = [(1, "Hello <|endoftext|> world", 7), (None, "é", 8), (1, None, 9), (2, "", 1), (2, long, 2), (2, long, 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int")
    found = sorted(map(tuple, tokens.token_counts(docs, PATH).collect()), key=str)
    expected = [(i, len((t or "").encode()), library(t or ""), library(t or "") > 512) for i, t, _ in rows]
    assert found == sorted(expected, key=str)
    assert tokens.token_counts(docs.limit(0), PATH).count() == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        tokens.Merger(public_tokenizers.path("word_bpe_49k.json"))
