"""Ranked search of texts for every query of a set: summed accumulators and skipping, document by document."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from feedloom.llm.common import Scratch, exact, in_python

#: Characters of queries that are held against the documents in one go.
QUERY_CHARACTERS = 4_000_000
#: Postings of one shard of the index; a task builds, searches and forgets one after another.
SHARD_POSTINGS = 500_000
#: Documents of a block that has one bound.
BLOCK = 64
#: The shortest lists are summed beforehand while they hold at most this share of a shard's documents together.
SUMMED_SHARE = 0.25

# Bytes of a term: digits, letters, everything beyond ASCII; only A-Z change their case.
_SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
_FOLD = bytes.maketrans(_SEPARATORS + bytes(range(65, 91)), b" " * len(_SEPARATORS) + bytes(range(97, 123)))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Shard:
    """An inverted index of some documents, in ascending order of their ids.

    ``gain`` is what a posting adds to a document's score for each time its
    term is in the query. Every list knows the largest gain of each of its
    blocks of documents.
    """

    def __init__(self, n_docs: int, doc: np.ndarray, term: np.ndarray, gain: np.ndarray, n_terms: int):
        order = np.argsort(term, kind="stable")
        self.n_docs, self.doc, self.gain, term = n_docs, doc[order], gain[order], term[order]
        self.begin = np.searchsorted(term, np.arange(n_terms + 1))
        block = self.doc // BLOCK
        first = np.flatnonzero(np.diff(term, prepend=-1) | np.diff(block, prepend=-1))
        self._largest = np.maximum.reduceat(self.gain, first) if len(first) else self.gain
        self._block = block[first]
        self._block_begin = np.searchsorted(term[first], np.arange(n_terms + 1))

    def best(self, query: list[tuple[int, int]], k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Scores and documents of the ``k`` best above 0 that score at least ``floor``, the best first, ties by document.

        ``query`` has terms and how often each is in it. The shortest lists are
        summed, document by document, into one list, which then is a list like
        the others: sorted, with a bound for each block. The long lists are not
        read through: from the first document on, the next blocks whose bounds
        together can reach the ``k``-th best score so far are scored, the rest
        is passed over.
        """
        lists = [(self.begin[t], self.begin[t + 1], t, times) for t, times in query if self.begin[t] < self.begin[t + 1]]
        lists.sort(key=lambda x: (x[1] - x[0], x[2]))
        room, short = int(self.n_docs * SUMMED_SHARE), 0
        while short < len(lists) and lists[short][1] - lists[short][0] <= room:
            room -= lists[short][1] - lists[short][0]
            short += 1
        summed_doc, summed = self._sum(lists[:short])
        bound = np.zeros(-(-self.n_docs // BLOCK), np.int64)
        np.maximum.at(bound, summed_doc // BLOCK, summed)
        for _, _, t, times in lists[short:]:
            blocks = slice(self._block_begin[t], self._block_begin[t + 1])
            bound[self._block[blocks]] += times * self._largest[blocks]
        if len(summed) >= k:
            floor = max(floor, int(np.partition(summed, len(summed) - k)[len(summed) - k]))
        scores, docs = np.empty(0, np.int64), np.empty(0, np.int64)
        at, step = 0, 4
        while at < len(bound):
            reach = np.flatnonzero(bound[at:] >= max(floor, 1))[:step] + at
            if not len(reach):
                break
            score = self._score(reach, summed_doc, summed, lists[short:])
            hit = np.flatnonzero(score >= max(floor, 1))
            scores = np.concatenate([scores, score[hit]])
            docs = np.concatenate([docs, reach[hit // BLOCK] * BLOCK + hit % BLOCK])
            first = np.lexsort((docs, -scores))[:k]
            scores, docs = scores[first], docs[first]
            if len(scores) == k:
                floor = max(floor, int(scores[-1]))
            at, step = int(reach[-1]) + 1, step * 2
        return scores, docs

    def _sum(self, lists: list[tuple[int, int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
        if not lists:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        docs = np.concatenate([self.doc[a:b] for a, b, _, _ in lists])
        gains = np.concatenate([self.gain[a:b] * times for a, b, _, times in lists])
        order = np.argsort(docs, kind="stable")
        docs, gains = docs[order], gains[order]
        first = np.flatnonzero(np.diff(docs, prepend=-1))
        return docs[first], np.add.reduceat(gains, first)

    def _score(self, blocks: np.ndarray, summed_doc: np.ndarray, summed: np.ndarray, lists) -> np.ndarray:
        """The scores of all documents of some ascending blocks."""
        score, starts = np.zeros(len(blocks) * BLOCK, np.int64), blocks * BLOCK
        shift = np.arange(len(blocks)) * BLOCK - starts

        def add(docs: np.ndarray, gains: np.ndarray, times: int) -> None:
            low, high = np.searchsorted(docs, starts), np.searchsorted(docs, starts + BLOCK)
            sizes = high - low
            ends = np.cumsum(sizes)
            hits = np.arange(ends[-1]) + np.repeat(low - ends + sizes, sizes)
            score[docs[hits] + np.repeat(shift, sizes)] += gains[hits] * times  # a document is in a list once

        add(summed_doc, summed, 1)
        for a, b, _, times in lists:
            add(self.doc[a:b], self.gain[a:b], times)
        return score


def _postings(batches: Iterator[pa.RecordBatch], places: dict[bytes, int], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Each document with a term: its id, number of terms, and those of its terms that queries have, with their numbers."""
    place = places.get
    for batch in batches:
        rows, sizes, terms, times, ends = [], [], [], [], [0]
        for i, text in enumerate(batch.column(1)):
            found = terms_of(text.as_py() or b"")
            if not found:
                continue
            rows.append(i)
            sizes.append(len(found))
            counts = Counter(map(place, found))
            counts.pop(None, None)
            terms.extend(counts)
            times.extend(counts.values())
            ends.append(len(terms))
        lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, times)]
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()), *lists], names)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    gathered, size = [], 0
    for batch in batches:
        step = max(1, batch.num_rows * SHARD_POSTINGS // max(1, len(batch.column(2).flatten()) * 4))
        for at in range(0, batch.num_rows, step):  # a batch may hold more than a shard
            part = batch.slice(at, step)
            gathered.append(part)
            size += len(part.column(2).flatten())
            if size >= SHARD_POSTINGS:
                yield pa.Table.from_batches(gathered)
                gathered, size = [], 0
    if gathered:
        yield pa.Table.from_batches(gathered)


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return pc.list_flatten(column).to_numpy().astype(np.int64)


def _search(batches, queries: list[list[tuple[int, int]]], weights: np.ndarray, n: int, terms: int, k: int) -> Iterator[pa.RecordBatch]:
    """The best documents of a task for each query; what an earlier shard had spares work in the next ones."""
    so_far: list[np.ndarray] = [np.empty(0, np.int64)] * len(queries)
    for table in _shards(batches):
        table = table.take(pc.sort_indices(table.column(0), null_placement="at_end"))
        lengths, inverse = np.unique(table.column(1).to_numpy(), return_inverse=True)
        damping = np.array([100 - 75 + 75 * int(length) * n // terms for length in lengths], np.int64)[inverse]
        held = pc.list_value_length(table.column(2)).to_numpy()
        doc = np.repeat(np.arange(table.num_rows), held)
        term, times = _flat(table.column(2)), _flat(table.column(3))
        gain = weights[term] * (1_000_000_000 * times // (1000 * times + 8 * damping[doc]))
        shard = Shard(table.num_rows, doc, term, gain, len(weights))
        numbers, scores, docs = [], [], []
        for number, query in enumerate(queries):
            floor = int(so_far[number][-1]) if len(so_far[number]) == k else 0
            score, place = shard.best(query, k, floor)
            so_far[number] = -np.sort(-np.concatenate([so_far[number], score]))[:k]
            numbers.append(np.full(len(score), number, np.int32))
            scores.append(score)
            docs.append(place)
        if numbers:
            ids = table.column(0).combine_chunks().take(pa.array(np.concatenate(docs)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(numbers)), ids, pa.array(np.concatenate(scores))], ["query", "doc", "score"])


def _blocks(items: DataFrame) -> Iterator[list[tuple[object, str]]]:
    """The queries in blocks of a bounded size."""
    items = items.where("text IS NOT NULL").distinct()
    count = max(1, -(-(items.agg(F.sum(F.length("text"))).first()[0] or 0) // QUERY_CHARACTERS))
    for block in range(count):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == block).collect()
        yield [(row["item"], row["text"]) for row in rows]


def ranked(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """The ``k`` documents of highest score for each item: the item's id, ``rank`` from 1, the document's id, ``score``.

    Terms are runs of digits, letters and characters beyond ASCII; A-Z are
    lower-cased. The score sums over the item's terms, repeats included, a
    whole-number BM25: ``weight x (10^9 tf div (1000 tf + 8 m))`` with weight =
    floor(1000 ln((2N + 2) / (2 df + 1))) and m = 25 + 75 n N div L. All
    statistics count all documents. Equal scores rank by ascending id.

    Every row is a document of its own, repeated ids and texts included; rows
    without an id rank last among equals. NULL and empty texts are no
    documents; items without a term, or with none that is in a document, have
    no rows. Equal rows of items count once; unlike texts under one id, NULL
    included, are ranked apart. Other columns are not read.

    Texts are read once, into the postings of the items' terms, which are
    written to the shared folder. The items are the query set and go out in
    blocks of ``QUERY_CHARACTERS`` with their terms' weights. Each task cuts
    its postings into shards of bounded size, builds their index and returns
    its best; what is shuffled is k rows for each item and shard at most.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    texts = exact(docs, id_column, text_column).toDF("doc", "text").select("doc", F.col("text").cast("binary"))
    doc_type, item_type = docs.schema[id_column].dataType, items.schema[item_column].dataType
    numbers = ArrayType(IntegerType())
    names = ["doc", "n", "terms", "times"]
    schema = StructType([StructField(name, kind) for name, kind in zip(names, (doc_type, LongType(), numbers, numbers), strict=True)])
    hits = StructType([StructField("query", IntegerType()), StructField("doc", doc_type), StructField("score", LongType())])
    result = None
    for block in _blocks(exact(items, item_column, item_text_column).toDF("item", "text")):
        places: dict[bytes, int] = {}
        queries = [
            [(places.setdefault(term, len(places)), times) for term, times in Counter(terms_of(text.encode())).items()] for _, text in block
        ]
        known = spark.sparkContext.broadcast(places)
        found = in_python(texts, lambda batches, known=known: _postings(batches, known.value, names), schema)
        postings = scratch.write(found, "postings")
        n, total = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        held = postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # a row for a query term
        weights = np.zeros(len(places), np.int64)
        for row in held:
            weights[row["term"]] = math.floor(1000 * math.log((2 * n + 2) / (2 * row["count"] + 1)))
        shared = spark.sparkContext.broadcast((queries, weights))
        search = in_python(postings, lambda batches, s=shared, n=n, total=total: _search(batches, *s.value, n, total, k), hits)
        number = StructType([StructField("query", IntegerType()), StructField("item", item_type)])
        own = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], number)
        best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
        part = search.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).join(F.broadcast(own), "query")
        part = part.select(F.col("item").alias(item_column), "rank", F.col("doc").alias(id_column), "score")
        result = part if result is None else result.union(part)
    return result


RANKED_SQL = r"""
WITH texts AS (SELECT row_number() OVER () AS place, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
sizes AS (SELECT place, doc_id, len(terms) AS n FROM texts WHERE len(terms) > 0),
whole AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
postings AS (SELECT place, term, count(*) AS tf FROM (SELECT place, unnest(terms) AS term FROM texts) GROUP BY place, term),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM postings, whole GROUP BY term, n_docs),
asked AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scores AS (SELECT item_id, place, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms)))) AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN sizes USING (place), whole GROUP BY item_id, place, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score::BIGINT AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10"""
