"""Token counts of texts by byte-pair merging, without building the tokens' ids."""

from __future__ import annotations

import functools
import heapq
import json

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField

from feedloom.llm.common import exact, map_batches

# Unicode white space, as the pre-tokenizer has it.
_SPACE = "\t-\r \x85\xa0  -     　"
# A text's pieces that the pre-tokenizer splits without looking at their neighbours.
_PIECE = regex.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
# Fixed value: the pre-tokenizer's pattern.
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Up to here all Unicode versions agree on what is a letter, a number or a space.
_AGREED = "԰"
#: Pieces, and words, whose counts one Python worker remembers; beyond that it starts again.
REMEMBERED = 800_000
_PLACE_BITS = 40
_PLACE = (1 << _PLACE_BITS) - 1


def byte_letters() -> list[str]:
    """A printable letter for each byte: itself where printable, else the next ones from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in printable]
    letters = {byte: chr(byte) for byte in printable} | {byte: chr(256 + i) for i, byte in enumerate(others)}
    return [letters[byte] for byte in range(256)]


class Merger:
    """Counts the tokens of a byte-level BPE vocabulary file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, before = described["model"], described["pre_tokenizer"]
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
        splits = before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
        if model["type"] != "BPE" or not plain or model.get("ignore_merges") or not splits or described["normalizer"]:
            raise ValueError(f"not a plain byte-level BPE vocabulary: {path}")
        number = model["vocab"]
        self._merges = {
            number[one] << _PLACE_BITS | number[two]: (rank << _PLACE_BITS, number[one + two])
            for rank, (one, two) in enumerate(model["merges"])
        }
        letters = byte_letters()
        self._bytes = [number[letter] for letter in letters]
        self._byte_of = {letter: number[letter] for letter in letters}
        special = [token["content"] for token in described["added_tokens"]]
        self._special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self._split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self._pieces: dict[str, int] = {}
        self._words: dict[str, int] = {}

    def count(self, text: str) -> int:
        parts = self._special.split(text) if self._special else [text]
        known, total = self._pieces, len(parts) - 1
        for part in parts:
            pieces = _PIECE.findall(part)
            try:
                total += sum(map(known.__getitem__, pieces))
            except KeyError:
                total += sum(map(self._piece, pieces))
        return total

    def _piece(self, piece: str) -> int:
        found = self._pieces.get(piece)
        if found is None:
            if max(piece) < _AGREED:
                found = sum(map(self._word, _WORD.findall(piece)))
            else:
                byte_of = self._byte_of
                found = sum(merged_length([byte_of[c] for c in word], self._merges) for word, _ in self._split(piece))
            _remember(self._pieces, piece, found)
        return found

    def _word(self, word: str) -> int:
        found = self._words.get(word)
        if found is None:
            numbers = self._bytes
            found = merged_length([numbers[byte] for byte in word.encode()], self._merges)
            _remember(self._words, word, found)
        return found


def _remember(known: dict[str, int], text: str, count: int) -> None:
    if len(text) < 100:
        if len(known) >= REMEMBERED:
            known.clear()
        known[text] = count


def merged_length(symbols: list[int], merges: dict[int, tuple[int, int]]) -> int:
    """Symbols of a word less the merges done in it.

    ``merges`` gives the rank and the merged symbol of a pair; its keys hold the
    first symbol above the second, its ranks leave room for a place below. The
    heap holds ranks and places of adjacent pairs, two lists link the symbols
    still there. The pair of lowest rank, and of those the leftmost, is merged
    until no pair has a rank; an entry whose pair has changed is passed over.
    """
    end = count = len(symbols)
    if end == 1:
        return 1
    pair = merges.get
    heap = [found[0] | i for i in range(end - 1) if (found := pair(symbols[i] << _PLACE_BITS | symbols[i + 1]))]
    if not heap:
        return count
    heapq.heapify(heap)
    left, right = list(range(-1, end)), list(range(1, end + 1))
    while heap:
        top = heapq.heappop(heap)
        i = top & _PLACE
        j = right[i]
        if j >= end or symbols[i] < 0:
            continue
        found = pair(symbols[i] << _PLACE_BITS | symbols[j])
        if not found or found[0] | i != top:
            continue
        symbols[i] = here = found[1]
        symbols[j] = -1
        right[i] = k = right[j]
        count -= 1
        if k < end:
            left[k] = i
            if found := pair(here << _PLACE_BITS | symbols[k]):
                heapq.heappush(heap, found[0] | i)
        h = left[i]
        if h >= 0 and (found := pair(symbols[h] << _PLACE_BITS | here)):
            heapq.heappush(heap, found[0] | h)
    return count


@functools.lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    """One per Python worker and file, so that its counts serve all tasks of the worker."""
    return Merger(path)


def token_counts(texts: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", limit: int = 512) -> DataFrame:
    """Bytes and tokens of every whole text; one row out for each row in, in any order.

    Columns: the id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than
    ``limit`` tokens). A NULL text is empty and has 0 of both. Ids are passed
    through as they are, so NULL and repeated ids keep their rows; other columns
    are not read. Strings of special tokens inside a text are one token each,
    as the library has it by default; no token is added, cut or padded. A text
    without white space is one word of any length, merged in n log n steps.

    Narrow: no shuffle, and a worker holds one Arrow batch and its remembered
    counts (``REMEMBERED`` pieces at most; a speed matter only).
    """

    def counted(batch: pa.RecordBatch) -> list[pa.Array]:
        count = merger(path).count
        strings = [text or "" for text in batch.column(1).to_pylist()]
        tokens = [count(text) for text in strings]
        return [
            batch.column(0),
            pa.array([len(text.encode()) for text in strings], pa.int64()),
            pa.array(tokens, pa.int64()),
            pa.array([n > limit for n in tokens], pa.bool_()),
        ]

    fields = [
        texts.schema[id_column],
        StructField("n_bytes", LongType()),
        StructField("n_tokens", LongType()),
        StructField("over_limit", BooleanType()),
    ]
    return map_batches(exact(texts, id_column, text_column), counted, fields)
