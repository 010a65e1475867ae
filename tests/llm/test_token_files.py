"""Elias-Fano sequences, the encoder and whole files."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from feedloom.llm import token_files
from feedloom.llm.token_files import EliasFano

PATH = public_tokenizers.path("word_bpe_49k.json")
LETTERS = "abÉÿß 'sT1 \n\t\x1c\x85\xa0éÉß漢字½٣ः𝟘😀՘࢏🫨  ​﻿\u0301\u0300가"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("n, top", [(0, 0), (1, 0), (1, 5), (5, 3), (1000, 10**9), (3000, 100), (700, 0), (600, 10**15)])
def test_elias_fano(n, top):
    values = np.sort(np.random.default_rng(n).integers(0, top + 1, n))
    written = EliasFano.of(values)
    data = written.to_bytes()
    read, end = EliasFano.read(memoryview(data), 0, n, written.low_bits)
    assert end == len(data) and len(read) == n
    assert read.all().tolist() == values.tolist() == [read.select(i) for i in range(n)]
    if n > 500:
        assert 8 * len(data) < n * (3 + max(0, np.log2(max(top, 1) / n))) + 256
    with pytest.raises(IndexError):
        read.select(n)


def test_encoder(library, monkeypatch):
    random.seed(5)
    encoder = token_files.Encoder(PATH, 1)
    assert encoder.bits == 16 and encoder._by_word and encoder._direct
    for word in ("Word", "DON'T", "it's,", "a<|endoftext|>", "<|endoftext|>", "e-mail", "end...", "X!?\"", "ab_c", "_", "ſt", "K,", "ÀÖØöøÿ", "e\u0301", "é\u0301", "ß", "×a", "İI"):
        assert np.frombuffer(encoder.encode(word), "<u2").tolist() == library(word), word
    for remembered in (1000, 4):
        monkeypatch.setattr(token_files, "REMEMBERED", remembered)
        for _ in range(2000):
            text = "".join(random.choices(LETTERS, k=random.randint(0, 30)))
            if random.random() < 0.2:
                text = text[:5] + random.choice(["<|endoftext|>", "<|startoftext|>"]) + text[5:]
            assert np.frombuffer(encoder.encode(text), "<u2").tolist() == library(text), text


def check(spark, library, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, start int, part int, ids_crc32 int")
    found = sorted(map(tuple, token_files.encoded(docs, PATH).collect()), key=lambda r: r[1])
    assert [r[1] for r in found] == [0, *np.cumsum([r[2] for r in found])[:-1].tolist()]
    assert [r[0] for r in found] == sorted([r[0] for r in rows], key=lambda x: (x is not None, x))
    ids = lambda text: np.array(library(text), "<u4").tobytes()
    expected = [(i, len(library(text)), zlib.crc32(ids(text))) for i, text, *_ in rows]
    assert sorted(map(str, ((i, n, crc) for i, _, n, crc in found))) == sorted(map(str, expected))


def test_files(spark, library, monkeypatch):
    random.seed(2)
    rows = [(i * 7 - 100, "".join(random.choices(LETTERS, k=random.randint(0, 60))), 0, 0, 0) for i in range(300)]
    rows += [(None, "x y", 0, 0, 0), (None, None, 0, 0, 0), (3, "same", 0, 0, 0), (3, "same", 0, 0, 0), (3, "other", 0, 0, 0), (10**15, "word " * 9000, 0, 0, 0)]
    random.shuffle(rows)
    check(spark, library, rows)


def test_parts_ascend():
    borders = [-(2**63), 3, 7, 7, 7, 9]
    found = [token_files.part_of(doc, tie, borders) for doc in (None, -5, 3, 4, 7, 8, 9, 10) for tie in (0, 2**30, 2**31, 2**32 - 1)]
    assert found == sorted(found) and set(found) == set(range(7))


def test_files_are_bounded(spark, library, monkeypatch):
    """Many small shards: no file holds more than it may, and all are read back."""
    monkeypatch.setattr(token_files, "SHARD_IDS", 20)
    monkeypatch.setattr(token_files, "FILE_SHARDS", 2)
    monkeypatch.setattr(token_files, "PART_BYTES", 300)
    rows = [(i // 3 if i % 4 else 7, f"{'word ' * (i % 9)}{i}", 0, 0, 0) for i in range(200)]
    check(spark, library, rows)
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/bounded"
    token_files.write(spark.createDataFrame(rows, "doc_id bigint, text string, start int, part int, ids_crc32 int"), folder, PATH)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).collect()
    for file in files:
        data, at, shards = memoryview(bytes(file["content"])), 0, 0
        while at < len(data):
            shard = token_files.Shard(data, at)
            assert shard.n_ids < 20 + 20
            at, shards = shard.end + 1, shards + 1
        assert 0 < shards <= 2
    assert len(files) > 20


def test_all_byte_values_survive(spark, library):
    """Ids of every low byte, line breaks among them, pass through the text writer."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [chr(c) for c in range(33, 127)] + [a + b + c for a in letters for b in letters for c in "aeiou"]
    rows = [(i, word, 0, 0, 0) for i, word in enumerate(words)]
    assert {b for word in words for x in library(word) for b in x.to_bytes(2, "little")} == set(range(256))
    check(spark, library, rows)


def test_text_that_is_not_utf8(spark):
    docs = spark.sql("SELECT 1L AS doc_id, cast(X'61FF62' AS string) AS text UNION ALL SELECT 2L, 'a\ufffdb'")
    rows = token_files.encoded(docs, PATH).collect()
    assert len({(row["n_tokens"], row["ids_crc32"]) for row in rows}) == 1


def test_shards_of_a_part(library):
    encoder = token_files.Encoder(PATH, 1)
    texts = ["a b c", "", "d " * 100]
    data = b"".join(token_files.shard_bytes(2, i, [None, 5 + i], [encoder.encode(t)] * 2, 16) + b"\n" for i, t in enumerate(texts))
    at = 0
    for i, text in enumerate(texts):
        shard = token_files.Shard(memoryview(data), at)
        at = shard.end + 1
        assert (shard.part, shard.place, len(shard), shard.document_ids()) == (2, i, 2, [None, 5 + i])
        assert shard.document(1).tolist() == library(text)
    assert at == len(data)
    with pytest.raises(ValueError, match="not a shard"):
        token_files.Shard(memoryview(data), 3)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert token_files.encoded(empty, PATH).count() == 0
