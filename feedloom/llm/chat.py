"""Conversations as text and token ids, with a loss mask over the assistant's texts."""

from __future__ import annotations

import functools
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField

from feedloom.llm.common import exact, map_batches

# The template's control strings; each is one special token, so no token reaches over the border of a text.
START, BETWEEN, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
_AFTER = "\n"
_ESCAPE = re.compile(r"<(\\*)\|")
_UNESCAPE = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(f"{re.escape(START)}(.*?){re.escape(BETWEEN)}(.*?){re.escape(END)}{_AFTER}", re.DOTALL)


def escape(text: str) -> str:
    """The text with one more backslash in each ``<|``, ``<\\|``, ``<\\\\|`` ..: no control string is left in it."""
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def render(turns: list[tuple[str, str]], learned: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """A conversation's text and the sorted spans of its ``learned`` texts, in code points."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        opening, body = f"{START}{escape(role)}{BETWEEN}", escape(text)
        at += len(opening)
        if role == learned:
            spans.append((at, at + len(body)))
        at += len(body) + len(END) + len(_AFTER)
        parts += [opening, body, END, _AFTER]
    return "".join(parts), spans


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns that were rendered."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Whether each token lies in a span: the tokens of a span are found by binary search for its two borders."""
    inside = np.zeros(len(starts), bool)
    begin = np.array([a for a, _ in spans], np.int64)
    finish = np.array([b for _, b in spans], np.int64)
    first, last = np.searchsorted(starts, begin, "left"), np.searchsorted(ends, finish, "right")
    for a, b in zip(first, last, strict=True):
        inside[a:b] = True
    return inside


def learned_texts(formatted: str, starts: np.ndarray, ends: np.ndarray, inside: np.ndarray) -> list[str]:
    """The unescaped texts under a mask: one for each run of neighbouring tokens in it."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    return [unescape(formatted[starts[a] : ends[b - 1]]) for a, b in edges.reshape(-1, 2)]


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.add_special_tokens([AddedToken(control, normalized=False, special=True) for control in (START, BETWEEN, END)])
    return tokenizer


def formatted(turns: DataFrame, path: str, learned: str = "assistant") -> DataFrame:
    """Every conversation of ``turns`` (conv_id, turn, role, text), rendered whole and encoded once.

    Columns: ``conv_id``, ``formatted``, and for its tokens ``token_ids``,
    ``token_starts``, ``token_ends`` (code points) and ``loss_mask``, which is
    true for the tokens of ``learned`` texts and for nothing else.

    Turns stand in order of ``turn``, ties by role, then text, NULL first;
    repeated rows are repeated turns. A NULL role or text is empty; an empty
    text has no token. A row without a conv_id is a conversation of one turn
    without an id. No row gives no row; further columns are not read. One shuffle, by
    conversation; a conversation is one row and so fits into a task.
    """
    rows = exact(turns, "conv_id", "turn", "role", "text")
    rows = rows.withColumns({name: F.make_valid_utf8(name) for name in ("role", "text")})
    alone = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    conversations = rows.groupBy("conv_id", alone.alias("__alone")).agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")).drop("__alone")

    def encoded(batch: pa.RecordBatch) -> list[pa.Array]:
        columns: list[list] = [[], [], [], [], []]
        for conversation in batch.column(1):
            text, spans = render([(turn["role"] or "", turn["text"] or "") for turn in conversation.as_py()], learned)
            encoding = _tokenizer(path).encode(text, add_special_tokens=False)
            places = np.array(encoding.offsets, np.int32).reshape(-1, 2)
            inside = mask(places[:, 0], places[:, 1], spans)
            for column, value in zip(columns, (text, encoding.ids, places[:, 0], places[:, 1], inside), strict=True):
                column.append(value)
        numbers = pa.list_(pa.int32())
        types = (pa.string(), numbers, numbers, numbers, pa.list_(pa.bool_()))
        return [batch.column(0), *(pa.array(column, kind) for column, kind in zip(columns, types, strict=True))]

    numbers = ArrayType(IntegerType())
    fields = [
        turns.schema["conv_id"],
        StructField("formatted", StringType()),
        StructField("token_ids", numbers),
        StructField("token_starts", numbers),
        StructField("token_ends", numbers),
        StructField("loss_mask", ArrayType(BooleanType())),
    ]
    return map_batches(conversations, encoded, fields)


def digests(conversations: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations: turns from the text, learned texts from the mask.

    Columns: ``conv_id``, ``n_turns``, ``turns_sha256`` of role, line break,
    text, line break of each turn, ``loss_chars`` and ``loss_sha256`` of the
    learned texts one after another, ``formatted_chars``.
    """

    def read(batch: pa.RecordBatch) -> list[pa.Array]:
        rows = []
        for text, *tokens in zip(*(batch.column(i) for i in range(1, 5)), strict=True):
            text = text.as_py()
            turns = turns_of(text)
            starts, ends, inside = (token.values.to_numpy(zero_copy_only=False) for token in tokens)
            loss = "".join(learned_texts(text, starts, ends, inside))
            said = "".join(f"{role}\n{words}\n" for role, words in turns)
            rows.append((len(turns), _sha(said), len(loss), _sha(loss), len(text)))
        types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        columns = zip(*rows, strict=True) if rows else [[]] * len(types)
        return [batch.column(0), *(pa.array(list(column), kind) for column, kind in zip(columns, types, strict=True))]

    fields = [
        conversations.schema["conv_id"],
        StructField("n_turns", LongType()),
        StructField("turns_sha256", StringType()),
        StructField("loss_chars", LongType()),
        StructField("loss_sha256", StringType()),
        StructField("formatted_chars", LongType()),
    ]
    return map_batches(exact(conversations, "conv_id", "formatted", "token_starts", "token_ends", "loss_mask"), read, fields)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
