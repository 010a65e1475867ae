"""Documents that hold benchmark items up to a few edits, by pieces that must occur exactly."""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from feedloom.llm.common import exact, in_python

#: Edits allowed for each character of an item.
ERROR_RATE = 0.08
#: Items with fewer characters must stand in the text as whole words.
SHORTEST = 32
#: Characters of items that are searched for at once, and so sent to the executors; more items go in further blocks.
BLOCK_CHARACTERS = 8 << 20
_OTHER = re.compile(r"[\W_]+")


def normal(text: str | None) -> str:
    """Letters and digits in folded case, single spaces for all else, at both ends too."""
    return f" {_OTHER.sub(' ', (text or '').casefold()).strip()} "


def budget(item: str, rate: float = ERROR_RATE) -> int:
    return int(rate * len(item))


def myers(pattern: str, text: str, most: int) -> int:
    """The least edit distance of ``pattern`` to any part of ``text``, or ``most + 1`` if it is above ``most``.

    Bit-parallel: bit i of the two vectors says whether the distance grows or
    falls between the pattern's first i and i + 1 characters, and a text
    character costs one step on whole numbers as long as the pattern.
    """
    m = len(pattern)
    if not m:
        return 0
    every, top = (1 << m) - 1, 1 << (m - 1)
    places: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        places[c] |= 1 << i
    grows, falls, distance, least = every, 0, m, min(m, most + 1)
    for c in text:
        equal = places.get(c, 0)
        vertical = equal | falls
        horizontal = (((equal & grows) + grows) ^ grows) | equal
        up = falls | (every & ~(horizontal | grows))
        down = grows & horizontal
        if up & top:
            distance += 1
        elif down & top:
            distance -= 1
        if distance < least:
            least = distance
            if not least:
                break
        up, down = up << 1 & every, down << 1 & every
        grows = down | (every & ~(vertical | up))
        falls = up & vertical
    return least


class Searcher:
    """Finds the items of a block in a text.

    An item with a budget of k edits is cut into k + 1 pieces. Where it occurs
    with k edits or fewer, at least one piece has none and stands there exactly.
    One automaton finds all pieces of all items; around each hit the stretch
    that the item can cover is verified.
    """

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self._items = []
        pieces: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, text in items:
            item = normal(text)
            bare = item.strip()
            if not bare:
                continue
            k = budget(bare, rate)
            item = bare if len(bare) >= SHORTEST else item
            cuts = [len(item) * j // (k + 1) for j in range(k + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                pieces[item[a:b]].append((len(self._items), a))
            self._items.append((number, item, k))
        self._automaton = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self._automaton.add_word(piece, (len(piece), places))
        if pieces:
            self._automaton.make_automaton()
        self._any = bool(pieces)

    def find(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item, distance, allowed) of each item that the text holds."""
        if not self._any or not text:
            return []
        text = normal(text)
        starts: dict[int, set[int]] = defaultdict(set)
        for end, (length, places) in self._automaton.iter(text):
            for i, offset in places:
                starts[i].add(end + 1 - length - offset)
        found = []
        for i, places in starts.items():
            number, item, k = self._items[i]
            distance = self._distance(text, item, k, sorted(places))
            if distance <= k:
                found.append((number, distance, k))
        return found

    @staticmethod
    def _distance(text: str, item: str, k: int, starts: list[int]) -> int:
        """The least distance in the stretches around the starts; overlapping stretches are one."""
        if item in text:
            return 0
        least, at = k + 1, 0
        while k and at < len(starts):
            begin, end = starts[at] - k, starts[at] + len(item) + k
            while at < len(starts) and starts[at] - k <= end:
                end = starts[at] + len(item) + k
                at += 1
            least = min(least, myers(item, text[max(0, begin) : end], least - 1))
            if not least:
                break
        return least


_searchers: dict[str, Searcher] = {}


def _searcher(key: str, items: list[tuple[int, str]], rate: float) -> Searcher:
    """One per Python worker and block of items."""
    if key not in _searchers:
        _searchers.clear()
        _searchers[key] = Searcher(items, rate)
    return _searchers[key]


def _blocks(items: DataFrame, id_column: str, text_column: str) -> Iterator[tuple[str, list[tuple[int, str]]]]:
    """The benchmark in blocks of a bounded size, each under a key of its own."""
    items = exact(items, id_column, text_column).toDF("item", "text").where("text IS NOT NULL").distinct()
    characters = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-characters // BLOCK_CHARACTERS))
    for block in range(count):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(count)) == block).collect()
        yield uuid.uuid4().hex, [(row["item"], row["text"]) for row in rows]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    rate: float = ERROR_RATE,
) -> DataFrame:
    """One row for each document and benchmark item that it holds: the id, the item's id, ``distance``, ``allowed``.

    Texts and items are compared in folded case, letters and digits only. An
    item is held if some part of the whole text is within ``allowed`` =
    ``rate`` x its characters edits of it; ``distance`` is the least number.
    Items without a letter or digit, NULL items and texts, and rows without an
    id match nothing. Rows that repeat a document's id give its items once, at
    their least distance, and so do items that repeat an id. Other columns are
    not read.

    The benchmark is the query set and goes to the executors in blocks of
    ``BLOCK_CHARACTERS``; every block is held against all documents, each read
    in one narrow pass. Only hits are shuffled.
    """
    rows = exact(docs, id_column, text_column).where(F.col(id_column).isNotNull())
    names = [id_column, item_column, "distance", "allowed"]
    schema = StructType([docs.schema[id_column], *(StructField(name, LongType()) for name in names[1:])])
    found = None
    for key, items in _blocks(benchmark.where(F.col(item_column).isNotNull()), item_column, item_text_column):

        def hits(batches: Iterator[pa.RecordBatch], key=key, items=items) -> Iterator[pa.RecordBatch]:
            search = _searcher(key, items, rate)
            for batch in batches:
                matches = [search.find(text.as_py()) for text in batch.column(1)]
                of = pa.array(np.repeat(np.arange(len(matches)), [len(x) for x in matches]), pa.int64())
                flat = [match for some in matches for match in some]
                columns = [pa.array([match[i] for match in flat], pa.int64()) for i in range(3)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(of), *columns], names)

        part = in_python(rows, hits, schema)
        found = part if found is None else found.union(part)
    return found.groupBy(id_column, item_column).agg(F.min("distance").alias("distance"), F.min("allowed").alias("allowed"))


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    rate: float = ERROR_RATE,
) -> DataFrame:
    """The rows whose text holds no benchmark item, with or without an id, as ``contaminated`` has it, with all their columns.

    No shuffle.
    """
    place = docs.columns.index(text_column)
    for key, items in _blocks(benchmark, item_column, item_text_column):

        def kept(batches: Iterator[pa.RecordBatch], key=key, items=items) -> Iterator[pa.RecordBatch]:
            search = _searcher(key, items, rate)
            for batch in batches:
                yield batch.filter(pa.array([not search.find(text.as_py()) for text in batch.column(place)], pa.bool_()))

        docs = in_python(docs, kept, docs.schema)
    return docs
