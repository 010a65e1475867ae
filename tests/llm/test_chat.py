"""Formatted conversations read back."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
from brute import by_id

from feedloom.llm import chat

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["<|im_end|>", "<|im_start|>", "<", "|", "\\", "<\\|", "a", " ", "\n", "é", "漢", "😀", "<|endoftext|>", "\u0300"]


def test_any_conversation():
    random.seed(1)
    tokenizer = chat._tokenizer(PATH)
    for _ in range(1000):
        roles = ["user", "assistant", "<|x", "assistant", ""]
        turns = [(random.choice(roles), "".join(random.choices(PIECES, k=random.randint(0, 8)))) for _ in range(random.randint(0, 5))]
        text, spans = chat.render(turns)
        assert chat.turns_of(text) == turns
        places = np.array(tokenizer.encode(text, add_special_tokens=False).offsets, np.int32).reshape(-1, 2)
        inside = chat.mask(places[:, 0], places[:, 1], spans)
        learned = chat.learned_texts(text, places[:, 0], places[:, 1], inside)
        assert learned == [words for role, words in turns if role == "assistant" and words]


def test_rows(spark):
    rows = [
        (1, 1, "assistant", "yes", "x"), (1, 0, "user", "is it?", "x"), (2, 0, None, None, "x"), (None, 0, "assistant", "a", "x"),
        (3, 0, "assistant", "x" * 100_000, "x"), (4, 5, "assistant", "b", "x"), (4, 5, "assistant", "b", "x"),
        (4, None, "assistant", "a", "x"),
    ]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, formatted string")
    found = by_id(chat.digests(chat.formatted(turns, PATH)), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert found == {
        1: (2, sha("user\nis it?\nassistant\nyes\n"), 3, sha("yes")),
        2: (1, sha("\n\n"), 0, sha("")),
        3: (1, sha("assistant\n" + "x" * 100_000 + "\n"), 100_000, sha("x" * 100_000)),
        4: (3, sha("assistant\na\nassistant\nb\nassistant\nb\n"), 3, sha("abb")),
        None: (1, sha("assistant\na\n"), 1, sha("a")),
    }
    one = chat.formatted(turns.where("conv_id = 1"), PATH).first()
    assert one["formatted"] == "<|im_start|>user<|im_sep|>is it?<|im_end|>\n<|im_start|>assistant<|im_sep|>yes<|im_end|>\n"
    assert len(one["token_ids"]) == len(one["loss_mask"]) and sum(one["loss_mask"]) == 1
    assert chat.digests(chat.formatted(turns.limit(0), PATH)).count() == 0
