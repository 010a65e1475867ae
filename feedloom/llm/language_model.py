"""An n-gram language model of the corpus as a weighted automaton with failure arcs, and the texts' log-probabilities."""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from feedloom.llm.common import Scratch, arrow_rows, exact, in_python

#: Words of an n-gram at most, and the pseudo-count by which shorter histories weigh in.
ORDER = 2
STRENGTH = 500.0
#: Bytes of text that are scored with one automaton of their own n-grams; a longer text is alone.
CHUNK_BYTES = 8_000_000
#: Bytes of text whose n-grams are counted in one group, about.
GROUP_BYTES = 12_000_000
#: Bits by which the runs of a group are told apart.
KEY_BITS = 48
#: Rows that a task gets at once while groups are counted.
BATCH_ROWS = 500
_PIECE = 1 << 20
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SPACE = b" \t\n\x0b\x0c\r"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def held_out(id_column: str) -> Column:
    """Whether a row is not learned from; a row without an id is."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 1, F.lit(False))


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time, however long it is."""
    at = 0
    while len(text) - at > _PIECE:
        end = at + _PIECE
        while end < len(text) and text[end] not in _SPACE:
            end += 1
        yield text[at:end].translate(_LOWER).split()
        at = end
    yield text[at:].translate(_LOWER).split()


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers, byte by byte of all of them, so that what they share packs well; no more bytes than the largest has."""
    width = max(1, -(-int(numbers.max()).bit_length() // 8)) if len(numbers) else 1
    return bytes([width]) + numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    numbers = np.zeros((planes.shape[1], 8), np.uint8)
    numbers[:, : data[0]] = planes.T
    return numbers.view("<u8").ravel()


class Chunk:
    """The distinct n-grams of some texts and where they are.

    Words are numbered by bucket, the highest ``bits`` of their hashes, and
    within one by themselves; a text is ``start``, its words, and ``end``,
    which have the two numbers after the words. ``keys[k]`` has the ascending
    keys of all runs of k + 1 tokens within a text, ``of[k]`` the place in them
    of the run that ends at each token (-1: none).
    """

    def __init__(self, texts: list[bytes], order: int, bits: int):
        seen: dict[bytes, int] = defaultdict(itertools.count().__next__)  # a new word gets the next number
        parts, sizes = [], []
        for text in texts:
            size = 0
            for words in pieces(text):
                parts.append(np.fromiter(map(seen.__getitem__, words), np.int64, len(words)))
                size += len(words)
            sizes.append(size)
        words = sorted(seen)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        rank = np.argsort(bucket_of(hashes, bits), kind="stable")
        self.words, self.hashes = list(map(words.__getitem__, rank.tolist())), hashes[rank]
        number = np.empty(len(words), np.int64)
        number[np.fromiter(map(seen.__getitem__, self.words), np.int64, len(words))] = np.arange(len(words))
        self.n_words, self.start, self.end = len(words), len(words), len(words) + 1
        self.begin = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64) + 2)])
        self.tokens = np.empty(self.begin[-1], np.int64)
        inner = np.ones(len(self.tokens), bool)
        inner[self.begin[:-1]] = inner[self.begin[1:] - 1] = False
        self.tokens[self.begin[:-1]], self.tokens[self.begin[1:] - 1] = self.start, self.end
        self.tokens[inner] = number[np.concatenate([*parts, np.empty(0, np.int64)])]
        self.keys: list[np.ndarray] = [np.empty(0, np.uint64)]
        self.of = [self.tokens]
        places = np.arange(len(self.tokens)) - np.repeat(self.begin[:-1], np.diff(self.begin))
        token_key = np.concatenate([self.hashes, np.array([1, 2], np.uint64)])[self.tokens]
        key = token_key
        for k in range(1, order):
            key = _mixed(np.concatenate([np.zeros(1, np.uint64), key[:-1]]), token_key)
            there = np.flatnonzero(places >= k)
            distinct, inverse = np.unique(key[there] & _kept(bits), return_inverse=True)
            of = np.full(len(self.tokens), -1, np.int64)
            of[there] = inverse
            self.keys.append(distinct)
            self.of.append(of)

    def counts(self, k: int, learned: np.ndarray) -> np.ndarray:
        """How often each run of k + 1 tokens (k > 0), or each word, is in the texts marked in ``learned``."""
        mark = np.repeat(learned, np.diff(self.begin)) & (self.of[k] >= 0)
        if not k:
            mark &= self.tokens < self.n_words
        return np.bincount(self.of[k][mark], minlength=len(self.keys[k]) if k else self.n_words)


def bucket_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def _kept(bits: int) -> np.uint64:
    """The bits of a key that count: those of its bucket and ``KEY_BITS`` more."""
    return np.uint64((1 << 64) - (1 << max(0, 64 - bits - KEY_BITS)))


def _mixed(before: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A key of a run from that of the run before its last token and the last token's."""
    x = (before ^ (before >> np.uint64(29))) * _MIX + last
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Automaton:
    """States are histories that occur in the learned texts, the empty one is 0.

    A state has an arc for each word seen after its history, weighted with the
    word's smoothed log10-probability there; for other words a failure arc
    leads to the state of the history without its first word, weighted with
    what the smoothing leaves to shorter histories. The empty history has an
    arc for every word. Probabilities are those of hierarchical Dirichlet
    smoothing: (count + STRENGTH x the shorter history's probability) /
    (count of the history + STRENGTH).

    The arcs are numbered like the runs of the chunk: the run of k + 1 tokens
    is the arc from the state of its first k, and leads to its own state, or
    where it is none to that of the run without its first token.
    """

    def __init__(self, chunk: Chunk, counts: list[np.ndarray], n_tokens: int, n_types: int, n_texts: int, strength: float):
        self.chunk, self._states = chunk, 1
        single = np.concatenate([counts[0], [n_texts, n_texts]]).astype(np.float64)
        probability = (single + 0.5) / (n_tokens + 0.5 * (n_types + 1))
        self.root = np.log10(probability)
        history = single.copy()
        history[chunk.end] = 0  # nothing follows an end
        state = np.zeros(len(single), np.int64)
        if len(counts) > 1:
            state = self._new_states(history, state)
        #: For each level above the root: arcs that exist, their weights, the state each begins at (0: none longer), what
        #: failing there costs, and where they lead.
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.root_target = state
        for k in range(1, len(counts)):
            at = np.zeros(len(chunk.keys[k]), np.int64)
            there = np.flatnonzero(chunk.of[k] >= 0)
            at[chunk.of[k][there]] = there  # a place where each run ends
            count, last, shorter, before = counts[k].astype(np.float64), chunk.tokens[at], chunk.of[k - 1][at], chunk.of[k - 1][at - 1]
            smoothed = (count + strength * probability[shorter]) / (history[before] + strength)
            known = history[before] > 0
            fail = np.where(known, np.log10(strength / (history[before] + strength)), 0.0)
            longer = np.where(last == chunk.end, 0.0, count)
            target = self._new_states(longer, state[shorter]) if k + 1 < len(counts) else state[shorter]
            self.levels.append((count > 0, np.log10(smoothed), np.where(known, state[before], 0), fail, target))
            probability, state, history = smoothed, target, longer

    def _new_states(self, history: np.ndarray, shorter: np.ndarray) -> np.ndarray:
        """New states for the runs that occur, the shorter history's state for the others."""
        new = np.flatnonzero(history > 0)
        state = shorter.copy()
        state[new] = np.arange(len(new)) + self._states
        self._states += len(new)
        return state

    def walk(self) -> tuple[np.ndarray, np.ndarray]:
        """The weight of every token's step and the state after it, through all texts of the chunk from left to right.

        Before a token the automaton is in the state that the last token led
        to, which is that of the longest run behind it that is a history. From
        there it takes the token's arc, or failure arcs down to a state that
        has one. All texts take their steps at once: each level's arcs follow
        from the runs that end at the tokens, the lowest level first.
        """
        weight, state = self.root[self.chunk.tokens], self.root_target[self.chunk.tokens]
        for k, (arc, arc_weight, _, fail, target) in enumerate(self.levels, 1):
            there = np.flatnonzero(self.chunk.of[k] >= 0)
            run = self.chunk.of[k][there]
            weight[there] = np.where(arc[run], arc_weight[run], weight[there] + fail[run])
            state[there] = np.where(arc[run], target[run], state[there])
        return weight, state

    def scores(self) -> np.ndarray:
        """The log10-probability of each text's words and its end."""
        weight, _ = self.walk()
        weight[self.chunk.begin[:-1]] = 0.0  # where a text begins nothing is said yet
        return np.add.reduceat(weight, self.chunk.begin[:-1])


_ASKED = StructType(
    [StructField(name, kind) for name, kind in (("chunk", LongType()), ("length", IntegerType()), ("bucket", LongType()))]
    + [StructField("words", BinaryType()), StructField("keys", BinaryType()), StructField("counts", BinaryType())]
)


def _buckets(keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, begin, end) of the stretches of keys in order of their buckets."""
    bucket = bucket_of(keys, bits)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(keys)], strict=False):
        yield int(bucket[a]), a, b


def _chunked(batches: Iterator[pa.RecordBatch], order: int, bits: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """A chunk's texts in one row, its documents in order, and rows that ask for the counts of the chunk's distinct n-grams."""
    from pyspark import TaskContext

    chunk_id = TaskContext.get().partitionId() << 32

    def close(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        chunk = Chunk([text for _, _, text in rows], order, bits)
        learned = np.array([not held for _, held, _ in rows], bool)
        out: list[dict] = [
            {"chunk": chunk_id, "kind": 0, "length": 1, "bucket": i, "id": doc, "held": held, "size": len(text)}
            for i, (doc, held, text) in enumerate(rows)
        ]
        texts = zstandard.compress(b"".join(text for _, _, text in rows))
        yield pa.RecordBatch.from_pylist([{"chunk": chunk_id, "kind": 0, "length": 0, "texts": texts}, *out], schema)
        for k in range(order):
            counts, keys = chunk.counts(k, learned), chunk.keys[k] if k else chunk.hashes
            for bucket, a, b in _buckets(keys, bits):
                row = {"chunk": chunk_id, "kind": 1, "length": k + 1, "bucket": bucket, "counts": packed(counts[a:b])}
                if k:
                    low = max(0, 64 - bits - KEY_BITS)
                    row["keys"] = packed((keys[a:b] << np.uint64(bits)) >> np.uint64(bits + low))
                else:
                    row["words"] = b" ".join(chunk.words[a:b])
                yield pa.RecordBatch.from_pylist([row], schema)

    rows, size = [], 0
    for batch in batches:
        for doc, held, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            text = text or b""
            if rows and size + len(text) > CHUNK_BYTES:
                yield from close(rows)
                chunk_id += 1
                rows, size = [], 0
            rows.append((doc, held, text))
            size += len(text) + 16
    if rows:
        yield from close(rows)


def _grouped(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows of sorted batches, gathered by the values of some columns."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            own = tuple(row[column] for column in columns)
            if own != key and rows:
                yield key, rows
                rows = []
            key = own
            rows.append(row)
    if rows:
        yield key, rows


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every asking row the counts of all chunks; a row of chunk -1 has the types and tokens of a bucket of words."""
    names = ["chunk", "length", "bucket", "counts", "types", "total"]
    for (length, bucket), rows in _grouped(batches, ["length", "bucket"]):
        out, types, total = [], None, None
        if length == 1:
            sums: dict[bytes, int] = defaultdict(int)
            for row in rows:
                for word, count in zip(row["words"].split(b" "), unpacked(row["counts"]).tolist(), strict=True):
                    sums[word] += count
            for row in rows:
                out.append((row["chunk"], packed(np.array([sums[word] for word in row["words"].split(b" ")], np.int64))))
            types, total = sum(count > 0 for count in sums.values()), sum(sums.values())
        else:
            keys = [unpacked(row["keys"]) for row in rows]
            distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            sums_of = np.zeros(len(distinct), np.int64)
            np.add.at(sums_of, inverse, np.concatenate([unpacked(row["counts"]) for row in rows]).astype(np.int64))
            cuts = np.cumsum([0, *(len(x) for x in keys)])
            for row, a, b in zip(rows, cuts, cuts[1:], strict=False):
                out.append((row["chunk"], packed(sums_of[inverse[a:b]])))
        for chunk, counts in out:
            columns = [[chunk], [length], [bucket], [counts], [None], [None]]
            yield _answer(columns, names)
        if length == 1:
            yield _answer([[-1], [1], [bucket], [None], [types], [total]], names)


def _answer(columns: list, names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names)


def _scored(batches, order: int, bits: int, strength: float, n_tokens: int, n_types: int, n_texts: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for _, rows in _grouped(batches, ["chunk"]):
        joined = zstandard.decompress(rows[0]["texts"])
        docs = [row for row in rows if row["kind"] == 0 and row["length"]]
        cuts = np.cumsum([0, *(row["size"] for row in docs)]).tolist()
        chunk = Chunk([joined[a:b] for a, b in itertools.pairwise(cuts)], order, bits)
        counts = []
        for k in range(order):
            own = [unpacked(row["counts"]) for row in rows if row["kind"] and row["length"] == k + 1]  # buckets ascend, as keys do
            counts.append(np.concatenate([*own, np.empty(0, np.uint64)]).astype(np.int64))
        automaton = Automaton(chunk, counts, n_tokens, n_types, n_texts, strength)
        inner = np.ones(len(chunk.tokens), bool)
        inner[chunk.begin[:-1]] = False
        known = np.concatenate([counts[0], [n_texts, n_texts]]) > 0
        per_text = [np.add.reduceat(np.where(inner, x[chunk.tokens], 0), chunk.begin[:-1]) for x in (known.astype(np.int64), automaton.root)]
        columns = [
            [row["id"] for row in docs], [row["held"] for row in docs], np.diff(chunk.begin) - 1, per_text[0],
            [n_tokens] * len(docs), per_text[1], automaton.scores(),
        ]
        yield pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(columns, schema, strict=True)], schema=schema)


def scores(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    order: int = ORDER,
    strength: float = STRENGTH,
) -> DataFrame:
    """Log10-probabilities of every whole text under models of all texts that are not held out; a row for each row.

    Columns: the id; ``held_out``; ``n_tokens`` (words parted by ASCII white
    space, A-Z lower-cased, and one end); ``n_known``, those that learned texts
    have; ``train_tokens``, all tokens of learned texts; ``base_score`` with
    single tokens, each (count + 0.5) / (N + 0.5 (V + 1)); ``score`` with the
    automaton of up to ``order`` tokens (see ``Automaton``).

    A NULL or empty text is one end. Rows without an id are learned from and
    keep their NULL; repeated rows count and are scored each. Without a learned
    token every factor is 1. No row gives no row; other columns are not read.

    The model is never in one place. Texts are cut into chunks of
    ``CHUNK_BYTES`` as they are read; a chunk sends each distinct n-gram once,
    with its count, to the group of n-grams of like hash (words themselves for
    single tokens, keys for longer runs), and gets the counts of the
    whole corpus back in the order it asked. A frequent n-gram is one entry a
    chunk and so no hot key. From these a chunk builds the part of the
    automaton that its texts can reach. The runs of a group, a million or so
    whatever the size of the corpus, are told apart by ``KEY_BITS`` bits: a
    look-up meets another run's count with a probability of 4 in 10^9.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    id_type = docs.schema[id_column].dataType
    rows = exact(docs, id_column, text_column).toDF("id", "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, size / GROUP_BYTES))))
    rows = rows.select("id", held_out("id").alias("held"), F.col("text").cast("binary"))
    wide = StructType(
        [_ASKED["chunk"], StructField("kind", IntegerType()), StructField("id", id_type), StructField("held", BooleanType())]
        + [StructField("size", LongType()), StructField("texts", BinaryType()), *_ASKED.fields[1:]]
    )
    wide_arrow = to_arrow_schema(wide)
    chunked = in_python(rows, lambda batches: _chunked(batches, order, bits, wide_arrow), wide)
    texts, asked = scratch.write_parts(chunked, "chunks", "kind", [0, 1])
    n_texts = texts.where("length = 1 AND NOT held").count()

    answer = StructType([*_ASKED.fields[:3], _ASKED["counts"], StructField("types", LongType()), StructField("total", LongType())])
    groups = asked.select(*_ASKED.names).repartition("length", "bucket").sortWithinPartitions("length", "bucket", "chunk")
    with arrow_rows(spark, BATCH_ROWS):
        answers = scratch.write(in_python(groups, _answers, answer), "counts")
    scratch.drop(asked)
    n_types, n_words = answers.agg(F.coalesce(F.sum("types"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    n_tokens = n_words + n_texts
    n_types += bool(n_texts)

    fields = [
        docs.schema[id_column],
        *(StructField(name, kind) for name, kind in (("held_out", BooleanType()), ("n_tokens", LongType()), ("n_known", LongType()))),
        *(StructField(name, kind) for name, kind in (("train_tokens", LongType()), ("base_score", DoubleType()), ("score", DoubleType()))),
    ]
    result = StructType(fields)
    result_arrow = to_arrow_schema(result)
    none = F.lit(None)
    told = answers.where("chunk >= 0").select(
        "chunk", F.lit(1).alias("kind"), none.cast(id_type).alias("id"), none.cast("boolean").alias("held"), none.cast("long").alias("size"),
        none.cast("binary").alias("texts"), "length", "bucket", "counts",
    )
    own = texts.select("chunk", F.lit(0).alias("kind"), "id", "held", "size", "texts", "length", "bucket", none.cast("binary").alias("counts"))
    both = own.union(told).repartition("chunk").sortWithinPartitions("chunk", "kind", "length", "bucket")
    return in_python(both, lambda batches: _scored(batches, order, bits, strength, n_tokens, n_types, n_texts, result_arrow), result)
