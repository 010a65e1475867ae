"""Token ids of documents in binary files whose document boundaries are Elias-Fano encoded.

A file is a sequence of shards. A shard holds consecutive documents:

    magic       4 bytes "EFTK"
    header      9 numbers of 64 bits: part, place in the part, documents, documents without an id, ids,
                smallest document id, bits of a token id, low bits of the boundaries, low bits of the document ids
    ids         the token ids of all documents, one after another
    boundaries  Elias-Fano: where each document ends
    document ids Elias-Fano, less the smallest one

An Elias-Fano sequence of n ascending numbers is n times the low bits of each,
packed; a bit vector with a one for each number at (high bits + its place); and
the place of every 256th one, in 32 bits. All numbers are little-endian.
"""

from __future__ import annotations

import bisect
import functools
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from feedloom.llm.common import Scratch, exact, in_python
from feedloom.llm.tokens import byte_letters
from feedloom.session import new_path

MAGIC = b"EFTK"
_HEADER = struct.Struct("<9q")
_SAMPLE = 256
#: Ids after which a shard is closed, at the end of a document, and shards of a file.
SHARD_IDS = 1 << 21
FILE_SHARDS = 8
#: Bytes of text in a partition of the sort, about, and partitions at most; larger ones have more files.
PART_BYTES = 16_000_000
PARTS = 10_000
_LEARNED = 200  # words encoded in one go; the library takes longer for each word of longer texts
#: Words whose ids one Python worker remembers at least; those not used for as many other words are forgotten.
REMEMBERED = 700_000


# A word's letters and what stands behind them; an apostrophe can belong to letters that follow it.
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
# The vocabulary's letter for each byte.
_LETTERS = dict(enumerate(byte_letters()))


class EliasFano:
    """An ascending sequence of numbers from 0 in about 2 + log2(largest / n) bits each."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self._low, self._high, self._samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        values = np.asarray(values, np.int64)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        bits = (values[:, None] >> np.arange(low_bits)) & 1
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> low_bits) + np.arange(n)
        high = np.zeros((int(ones[-1]) + 1 if n else 0) + 7 >> 3, np.uint8)
        np.bitwise_or.at(high, ones >> 3, (1 << (ones & 7)).astype(np.uint8))
        return cls(n, low_bits, low, high, ones[::_SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        return struct.pack("<q", len(self._high)) + self._low.tobytes() + self._high.tobytes() + self._samples.tobytes()

    @classmethod
    def read(cls, data: memoryview, at: int, n: int, low_bits: int) -> tuple[EliasFano, int]:
        """The sequence at a place of a file, and the place behind it."""
        (high,) = struct.unpack_from("<q", data, at)
        sizes = ((n * low_bits + 7) // 8, high, 4 * ((n + _SAMPLE - 1) // _SAMPLE))
        parts, at = [], at + 8
        for size in sizes:
            parts.append(np.frombuffer(data, np.uint8, size, at))
            at += size
        return cls(n, low_bits, parts[0], parts[1], parts[2].view("<u4")), at

    def __len__(self) -> int:
        return self.n

    def select(self, i: int) -> int:
        """The i-th number: from the sampled place of a one on, count ones by bytes."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, left = int(self._samples[i // _SAMPLE]), i % _SAMPLE
        byte = place >> 3
        ones = np.bitwise_count(self._high[byte : byte + 1 + _SAMPLE * 8]).astype(np.int64)
        left += int(np.bitwise_count(self._high[byte] & np.uint8((1 << (place & 7)) - 1)))
        while True:
            sums = np.cumsum(ones)
            if sums[-1] > left:
                break
            left -= int(sums[-1])
            byte += len(ones)
            ones = np.bitwise_count(self._high[byte : byte + 1 + _SAMPLE * 8]).astype(np.int64)
        within = int(np.searchsorted(sums, left, side="right"))
        left -= int(sums[within - 1]) if within else 0
        bits = np.flatnonzero(np.unpackbits(self._high[byte + within : byte + within + 1], bitorder="little"))
        high = (byte + within) * 8 + int(bits[left]) - i
        return high << self.low_bits | self._low_part(i)

    def _low_part(self, i: int) -> int:
        start, end = i * self.low_bits, (i + 1) * self.low_bits
        window = int.from_bytes(self._low[start >> 3 : (end + 7) >> 3].tobytes(), "little")
        return window >> (start & 7) & ((1 << self.low_bits) - 1)

    def all(self) -> np.ndarray:
        """All numbers, for a reader of the whole sequence."""
        bits = np.unpackbits(self._low, count=self.n * self.low_bits, bitorder="little").reshape(self.n, self.low_bits)
        low = bits.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))
        ones = np.flatnonzero(np.unpackbits(self._high, bitorder="little"))[: self.n]
        return (ones - np.arange(self.n) << self.low_bits) + low


class Shard:
    """One shard of a file: ids and boundaries, read in place."""

    def __init__(self, data: memoryview, at: int = 0):
        if bytes(data[at : at + 4]) != MAGIC:
            raise ValueError("not a shard of token ids")
        header = _HEADER.unpack_from(data, at + 4)
        self.part, self.place, n, self.without_id, self.n_ids, self.smallest, id_bits, low, low_ids = header
        at += 4 + _HEADER.size
        self.ids = np.frombuffer(data, f"<u{id_bits // 8}", self.n_ids, at)
        self.ends, at = EliasFano.read(data, at + self.ids.nbytes, n, low)
        self._documents, self.end = EliasFano.read(data, at, n - self.without_id, low_ids)

    def __len__(self) -> int:
        return len(self.ends)

    def document(self, i: int) -> np.ndarray:
        """The ids of one document, found by two selects."""
        return self.ids[self.ends.select(i - 1) if i else 0 : self.ends.select(i)]

    def document_ids(self) -> list[int | None]:
        return [None] * self.without_id + (self._documents.all() + self.smallest).tolist()


def shard_bytes(part: int, place: int, documents: list[int | None], ids: list[bytes], id_bits: int) -> bytes:
    """A shard of documents in ascending order (those without an id first) with their ids as bytes."""
    known = [document for document in documents if document is not None]
    smallest = known[0] if known else 0
    ends = EliasFano.of(np.cumsum([len(x) // (id_bits // 8) for x in ids]))
    numbers = EliasFano.of(np.array(known, np.int64) - smallest)
    n_ids = sum(map(len, ids)) // (id_bits // 8)
    header = (part, place, len(ids), len(ids) - len(known), n_ids, smallest, id_bits, ends.low_bits, numbers.low_bits)
    return b"".join([MAGIC, _HEADER.pack(*header), *ids, ends.to_bytes(), numbers.to_bytes()])


class Encoder:
    """Ids of texts by a word-level vocabulary file of the ``tokenizers`` library, as little-endian bytes.

    White space is dropped by the vocabulary's normalizer and ends every word, so
    each run of other characters is encoded once and remembered. New ones that
    are not plain letters are
    encoded many at a time; the places of their ids tell them apart. Texts with a
    control character that only some take for white space are encoded as they are.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        bits = 16 if self._tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 32
        self.bits, self._type = bits, f"<u{bits // 8}"
        self._end = np.array([end_id], self._type).tobytes()
        spaces = "a b\tc\n d\x85e\xa0f g　h"
        self._by_word = self._ids(spaces) == b"".join(map(self._ids, spaces.split()))
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._runs: dict[str, bytes] = {}
        self._direct = True
        self._direct = all(self._simple(word) == self._ids(word) for word in ("Ab", "zebra", "house,", "Wide--", "q.)", "mixed\"!", "Élan,", "größe", "ÿÀ"))

    def _ids(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, self._type).tobytes()

    def _simple(self, word: str) -> bytes | None:
        """The ids of a word of Latin letters, with ASCII punctuation behind or not; None for other words.

        Such a word is its letters and its punctuation to the vocabulary's
        rules, so both are merged at once and remembered each for itself.
        """
        parts = _SIMPLE.fullmatch(word) if self._direct else None
        if not parts:
            return None
        letters, signs = parts.groups()
        return self._run(letters.lower()) + (self._run(signs) if signs else b"")

    def _run(self, run: str) -> bytes:
        found = self._runs.get(run)
        if found is None:
            if len(self._runs) > REMEMBERED:
                self._runs.clear()
            spelled = run if run.isascii() else run.encode().decode("latin-1").translate(_LETTERS)
            ids = [token.id for token in self._tokenizer.model.tokenize(spelled)]
            found = self._runs[run] = struct.pack(f"<{len(ids)}{'H' if self.bits == 16 else 'I'}", *ids)
        return found

    def _learn(self, words: list[str]) -> None:
        others, known = [], self._known
        for word in words:
            ids = self._simple(word)
            if ids is None:
                others.append(word)
            else:
                known[word] = ids
        size = self.bits // 8
        for at in range(0, len(others), _LEARNED):
            some = others[at : at + _LEARNED]
            encoding = self._tokenizer.encode(" ".join(some), add_special_tokens=False)
            data = np.array(encoding.ids, self._type).tobytes()
            starts = np.cumsum([0, *(len(word) + 1 for word in some)])
            places = np.array([place for place, _ in encoding.offsets], np.int64)
            cuts = (size * np.searchsorted(places, starts)).tolist()
            for word, a, b in zip(some, cuts, cuts[1:], strict=False):
                known[word] = data[a:b]

    def encode(self, text: str) -> bytes:
        """The ids of a whole text and the end id."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of whole texts, each with the end id; words new to all of them are encoded together."""
        if len(self._known) > REMEMBERED:
            self._older, self._known = self._known, {}
        known, older = self._known, self._older
        split = [text.split() if self._plain(text) else None for text in texts]
        found = [words and list(map(known.get, words)) for words in split]
        gaps = [ids and None in ids and [i for i, own in enumerate(ids) if own is None] for ids in found]
        unknown = {words[i] for words, some in zip(split, gaps, strict=True) if some for i in some}
        if unknown:
            before = [word for word in unknown if word in older]
            known.update(zip(before, map(older.__getitem__, before), strict=True))
            self._learn(list(unknown.difference(before)))
            for words, ids, some in zip(split, found, gaps, strict=True):
                for i in some or ():
                    ids[i] = known[words[i]]
        return [
            (self._ids(text) if words is None else b"".join(ids)) + self._end for text, words, ids in zip(texts, split, found, strict=True)
        ]

    def _plain(self, text: str) -> bool:
        return self._by_word and not any(c in text for c in "\x1c\x1d\x1e\x1f")


@functools.lru_cache(maxsize=2)
def encoder(path: str, end_id: int) -> Encoder:
    """One per Python worker, so that its words serve all tasks of the worker."""
    return Encoder(path, end_id)


def part_of(doc: int | None, tie: int, borders: list[int]) -> int:
    """The part of a document: ascending with its id, and among equal ids, which several borders may have, with ``tie``."""
    doc = -(2**63) if doc is None else doc
    low = bisect.bisect_left(borders, doc)
    return low + (tie * (bisect.bisect_right(borders, doc) - low + 1) >> 32)


def _some(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Stretches (begin, length) of a column of texts that hold a bounded number of bytes, or one text."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        many = max(1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 300_000, side="right")) - at)
        yield at, many
        at += many


def write(docs: DataFrame, folder: str, path: str, end_id: int = 1, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Write the ids of every whole text to files in ``folder``, in ascending order of the ids of the documents.

    Texts are encoded as they are read; what is shuffled and sorted are the ids
    of 16 or 32 bits. The borders of the partitions are quantiles of the ids
    alone, and ids that several borders have are dealt out by a hash of their
    tokens, so that a hot id is split too. Each partition becomes files of at most ``FILE_SHARDS`` shards; a shard has
    ``SHARD_IDS`` ids and less than one document more, and is all that a task
    holds. Shards carry their places, so the files hold the documents in order.
    Spark's writer commits them: a lost or repeated task leaves its files once.
    Every document ends with ``end_id``; a NULL text is empty; documents
    without an id come first; repeated ids stay, in an order fixed by their
    token ids. No row gives no shard. Ids of documents are whole numbers.
    """
    docs = exact(docs, id_column, text_column).toDF("doc", "text")
    docs = docs.select(F.col("doc").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, min(PARTS, -(-size // PART_BYTES)))
    shares = [i / parts for i in range(1, parts)]
    order = F.coalesce("doc", F.lit(-(2**63)))  # as sorting has it, NULL first
    borders = docs.agg(F.percentile_approx(order, shares, 10_000)).first()[0] or [] if shares else []
    names = ["part", "doc", "n", "tie", "ids"]
    fields = StructType([*(StructField(name, LongType()) for name in names[:4]), StructField("ids", BinaryType())])

    def in_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, end_id)
        for batch in batches:
            for at, many in _some(batch.column(1)):
                ids = coder.encode_all(batch.column(1).slice(at, many).to_pylist())
                numbers = batch.column(0).slice(at, many)
                ties = [zlib.crc32(own) for own in ids]
                own_parts = [part_of(doc, tie, borders) for doc, tie in zip(numbers.to_pylist(), ties, strict=True)]
                n = [len(own) * 8 // coder.bits for own in ids]
                columns = [pa.array(own_parts, pa.int64()), numbers, pa.array(n, pa.int64()), pa.array(ties, pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)

    ranges = in_python(docs, in_ids, fields).repartitionById(parts, F.col("part").cast("int"))
    ranges = ranges.sortWithinPartitions("doc", "tie", "ids")
    bits = encoder(path, end_id).bits

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, held, documents, ids = TaskContext.get().partitionId(), 0, 0, [], []

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([shard_bytes(part, place, documents, ids, bits)], pa.binary())], ["value"])

        for batch in batches:
            for document, n, own in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                documents.append(document)
                ids.append(own)
                held += n
                if held >= SHARD_IDS:
                    yield closed()
                    place, held, documents, ids = place + 1, 0, [], []
        if documents:
            yield closed()

    binary = in_python(ranges.select("doc", "n", "ids"), shards, "value binary")
    # The text writer takes the bytes as they are, whatever they are; it ends each shard with a line break, which the
    # reader skips. A row is a shard, so the writer's bound on rows is one on the size of a file.
    binary.select(F.col("value").cast(StringType())).write.option("maxRecordsPerFile", FILE_SHARDS).text(folder)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, part, place, shard_ids, in_shard, n_tokens, ids_crc32) of every document in the files of ``folder``.

    ``in_shard`` is where its ids begin in the shard (part, place), which has
    ``shard_ids`` in all; both bounds come from the boundaries' select.
    """
    names = ["doc_id", "part", "place", "shard_ids", "in_shard", "n_tokens", "ids_crc32"]
    schema = StructType([StructField(name, LongType()) for name in names])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                data, at = memoryview(content.as_buffer()), 0
                while at < len(data):
                    shard = Shard(data, at)
                    at = shard.end + 1
                    yield _described(shard, names)

    return in_python(files, documents, schema)


def _described(shard: Shard, names: list[str]) -> pa.RecordBatch:
    ends = [shard.ends.select(i) for i in range(len(shard))]
    bounds = list(zip([0, *ends], ends, strict=False))
    checks = [zlib.crc32(shard.ids[start:end].astype("<u4").tobytes()) for start, end in bounds]
    same = [[x] * len(shard) for x in (shard.part, shard.place, shard.n_ids)]
    columns = [shard.document_ids(), *same, [a for a, _ in bounds], [b - a for a, b in bounds], checks]
    return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], names)


def encoded(docs: DataFrame, path: str, end_id: int = 1, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """What the files hold of every document, read back from them.

    Columns: the id, ``start`` (ids of all documents before it), ``n_tokens``
    (with the end id), ``ids_crc32`` of its ids as unsigned 32-bit numbers. See
    ``write`` for NULLs, ties, repeated and missing rows; columns other than
    the two named are not read. The files stay in the shared folder.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    folder = new_path(spark, "token-files")
    write(docs, folder, path, end_id, id_column, text_column)
    found = scratch.write(read_documents(spark, folder), "token-documents")
    shards = found.groupBy("part", "place").agg(F.max("shard_ids").alias("ids"))  # one row for each few million ids
    before = F.sum("ids").over(Window.orderBy("part", "place").rowsBetween(Window.unboundedPreceding, -1))
    shards = shards.select("part", "place", F.coalesce(before, F.lit(0)).alias("before"))
    start = (F.col("before") + F.col("in_shard")).alias("start")
    return found.join(shards, ["part", "place"]).select(F.col("doc_id").alias(id_column), start, "n_tokens", "ids_crc32")
