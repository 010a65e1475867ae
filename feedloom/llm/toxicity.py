"""Toxicity of texts by their nearest labelled examples."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from feedloom.llm.common import Scratch, exact, in_python, salted

#: Labelled rows that are learned from, those of least hash; the only thing that is bounded.
EXAMPLES = 12_000
#: Terms of a vector: all that tell the labels of the examples apart beyond chance, however many; README has what others cost.
_CHANCE = 10.83  # chi-squared of one degree of freedom, one in a thousand
_RARE = 5
NEIGHBOURS = 10
#: Votes weigh as the cosine to this power; a vote of PRIOR for the share of toxic examples is always there.
SHARPNESS = 4
PRIOR = 0.3
THRESHOLD = 0.7
BLOCK = 64
_WORD = re.compile(r"[^\W\d_]+")
_BEGINNINGS = range(4, 8)


def terms_of(word: str) -> list[str]:
    """A word's terms: itself and its beginnings of 4 to 7 letters."""
    return [word, *(f"{word[:k]}*" for k in _BEGINNINGS if k < len(word))]


def words_of(text: str | None) -> Counter[str]:
    return Counter(_WORD.findall((text or "").casefold()))


def held_out(id_column: str) -> Column:
    """Whether a row's label is kept for the test."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Vocabulary:
    """Counts a text's terms."""

    def __init__(self, terms: list[str]):
        self.place = {term: i for i, term in enumerate(terms)}
        self._of_word: dict[str, tuple[int, ...]] = {}

    def __reduce__(self):
        return Vocabulary, (list(self.place),)

    def count(self, text: str | None) -> dict[int, int]:
        known, counts = self._of_word, {}
        for word, n in words_of(text).items():
            places = known.get(word)
            if places is None:
                places = tuple(self.place[term] for term in terms_of(word) if term in self.place)
                if len(known) >= 300_000:
                    known.clear()
                if len(word) < 50:
                    known[word] = places
            for place in places:
                counts[place] = counts.get(place, 0) + n
        return counts


class BlockMaxIndex:
    """Exact nearest neighbours by cosine, from inverted lists with the largest weight of each block.

    Examples stand in an order that keeps like ones together, ``BLOCK`` to a
    block. A term's list has the examples with it and their weights, and where
    each block begins. The largest weights of a query's terms in a block bound
    the cosines in it; blocks are visited from the highest bound on, until it
    is below the last neighbour's cosine.
    """

    def __init__(self, vectors: list[dict[int, float]], n_terms: int):
        self.n = len(vectors)
        self._blocks = -(-self.n // BLOCK)
        lists: list[list[tuple[int, float]]] = [[] for _ in range(n_terms)]
        for i, vector in enumerate(vectors):
            for term, weight in vector.items():
                lists[term].append((i, weight))
        self._of = np.array([i for postings in lists for i, _ in postings], np.int64)
        self._weight = np.array([weight for postings in lists for _, weight in postings], np.float64)
        starts = np.concatenate([[0], np.cumsum([len(postings) for postings in lists])]).astype(np.int64)
        self._begin = np.empty((n_terms, self._blocks + 1), np.int64)
        self._largest = np.zeros((n_terms, self._blocks))
        borders = np.arange(self._blocks + 1) * BLOCK
        for term in range(n_terms):
            a, b = starts[term], starts[term + 1]
            self._begin[term] = a + np.searchsorted(self._of[a:b], borders)
            np.maximum.at(self._largest[term], self._of[a:b] // BLOCK, self._weight[a:b])

    def nearest(self, vector: dict[int, float], k: int, without: int = -1) -> list[tuple[float, int]]:
        """The k examples of highest cosine above 0, ties by place: (cosine, -place), the best first."""
        if not vector or not self.n:
            return []
        terms, weights = np.fromiter(vector, np.int64), np.fromiter(vector.values(), np.float64)
        bounds = weights @ self._largest[terms]
        order = np.argsort(-bounds, kind="stable")
        bounds = bounds[order] * (1 + 1e-12)
        some = int(np.searchsorted(-bounds, 0.0))
        best, places, at, step = np.empty(0), np.empty(0, np.int64), 0, 8
        while at < some and (len(best) < k or bounds[at] >= best[-1]):
            cosines, of = self._cosines(terms, weights, np.sort(order[at : min(at + step, some)]))
            hit = np.flatnonzero((cosines > 0) & (of != without) & (cosines >= (best[-1] if len(best) == k else 0.0)))
            best, places = np.concatenate([best, cosines[hit]]), np.concatenate([places, of[hit]])
            first = np.lexsort((places, -best))[:k]
            best, places = best[first], places[first]
            at, step = at + step, step * 4
        return list(zip(best.tolist(), (-places).tolist(), strict=True))

    def _cosines(self, terms: np.ndarray, weights: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cosines of all examples of some ascending blocks, and the examples' places."""
        begin = self._begin[terms][:, blocks].ravel()
        sizes = self._begin[terms][:, blocks + 1].ravel() - begin
        ends = np.cumsum(sizes)
        hits = np.arange(ends[-1]) + np.repeat(begin - ends + sizes, sizes)
        local = np.tile(np.arange(len(blocks)) * BLOCK - blocks * BLOCK, len(terms))
        where = self._of[hits] + np.repeat(local, sizes)
        summed = np.bincount(where, np.repeat(np.repeat(weights, len(blocks)), sizes) * self._weight[hits], len(blocks) * BLOCK)
        return summed, (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()


class Model:
    """What is learned from the examples and sent to the executors; its size is bounded by EXAMPLES and their texts."""

    def __init__(self, terms: list[str], weights: list[float], ids: list[int], toxic: list[int], counts: list[dict[int, int]]):
        self.vocabulary = Vocabulary(terms)
        self._idf = weights
        vectors = [self.vector(some) for some in counts]
        leading = [min(vector, key=lambda t, v=vector: (-v[t], t), default=len(terms)) for vector in vectors]
        order = sorted(range(len(ids)), key=lambda i: (leading[i], toxic[i], ids[i]))
        self.ids, self.toxic = [ids[i] for i in order], [toxic[i] for i in order]
        self.place = {number: i for i, number in enumerate(self.ids)}
        self.index = BlockMaxIndex([vectors[i] for i in order], len(terms))
        self._share = sum(toxic) / len(toxic) if toxic else 0.0
        self.steps, self.levels = [0.0, 1.0], [0.0, 1.0]

    def vector(self, counts: dict[int, int]) -> dict[int, float]:
        weights = {term: (1 + math.log(n)) * self._idf[term] for term, n in counts.items()}
        length = math.sqrt(sum(weight * weight for weight in weights.values()))
        return {term: weight / length for term, weight in weights.items()} if length else {}

    def vote(self, text: str | None, without: int = -1) -> tuple[float, list[int]]:
        """The weighted share of toxic neighbours, and the neighbours' ids."""
        near = self.index.nearest(self.vector(self.vocabulary.count(text)), NEIGHBOURS, without)
        toxic = sum(cosine**SHARPNESS * self.toxic[-i] for cosine, i in near) + PRIOR * self._share
        return toxic / (sum(cosine**SHARPNESS for cosine, _ in near) + PRIOR), [self.ids[-i] for _, i in near]

    def calibrate(self, votes: list[tuple[float, int]]) -> None:
        """Learn what share of texts with a vote is toxic, growing with the vote, from votes without the text itself.

        Pools of neighbouring votes whose shares would fall are one; each share
        counts one more text of the overall share.
        """
        pools: list[list[float]] = []
        by_vote: dict[float, list[float]] = {}
        for vote, toxic in votes:
            entry = by_vote.setdefault(vote, [0.0, 0.0])
            entry[0] += toxic
            entry[1] += 1
        for vote in sorted(by_vote):
            toxic, n = by_vote[vote]
            pools.append([vote * n, toxic, n])
            while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
                last = pools.pop()
                pools[-1] = [x + y for x, y in zip(pools[-1], last, strict=True)]
        if pools:
            self.steps = [total / n for total, _, n in pools]
            levels = [(toxic + self._share) / (n + 1) for _, toxic, n in pools]
            self.levels = np.maximum.accumulate(levels).tolist()

    def score(self, vote: float) -> float:
        return float(np.interp(vote, self.steps, self.levels))


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> Model:
    """Learn from the labelled rows that are not held out; IDF weights count every document.

    An id with unlike labels, without a label of 0 or 1, or with unlike texts is
    not learned from. Examples and votes reach the driver in a bounded number
    (``EXAMPLES``), and with them the terms that tell their labels apart, none
    of which is left out; counting is done by Spark.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    docs = exact(docs, id_column, text_column).toDF("doc", "text")
    known = exact(labels, id_column, label_column).toDF("doc", "toxic").where("toxic IN (0, 1) AND doc IS NOT NULL")
    known = known.where(~held_out("doc")).groupBy("doc").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other"))
    known = known.where("toxic = other").select("doc", F.col("toxic").cast("int").alias("toxic"), salted("doc", "toxic:").alias("hash"))
    known = scratch.write(docs.select("doc").distinct().join(known, "doc").orderBy("hash", "doc").limit(EXAMPLES), "labelled")
    texts = docs.join(F.broadcast(known), "doc").groupBy("doc").agg(  # at most EXAMPLES rows of three numbers
        F.first("toxic").alias("toxic"), F.min("text").alias("text"), F.max("text").alias("last")
    )
    examples = scratch.write(texts.where("text <=> last").select("doc", "toxic", "text"), "examples")

    pairs = StructType([StructField("term", StringType()), StructField("toxic", IntegerType())])
    found = in_python(examples.select("toxic", "text"), _terms, pairs).groupBy("term")
    n, n_toxic = examples.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    counts = found.agg(F.count("*").alias("n"), F.sum("toxic").alias("k")).where(F.col("n") >= _RARE)
    expected = F.col("n") * F.lit(n_toxic / max(n, 1))
    off = (F.col("k") - expected) * (F.col("k") - expected)
    telling = counts.select("term", F.try_add(F.try_divide(off, expected), F.try_divide(off, F.col("n") - expected)).alias("x"))
    telling = telling.where(F.col("x") > _CHANCE)
    terms = [row["term"] for row in telling.orderBy(F.desc("x"), "term").collect()]

    vocabulary = spark.sparkContext.broadcast(Vocabulary(terms))
    places = StructType([StructField("place", IntegerType()), StructField("n", LongType())])
    holding = in_python(docs.select("text"), lambda batches: _document_counts(batches, vocabulary.value), places)
    in_docs = {row["place"]: row["n"] for row in holding.groupBy("place").agg(F.sum("n").alias("n")).collect()}
    n_docs = in_docs.get(-1, 0)
    weights = [math.log1p(n_docs / in_docs[place]) if in_docs.get(place) else 0.0 for place in range(len(terms))]

    rows = examples.collect() if terms else []
    model = Model(
        terms, weights, [row["doc"] for row in rows], [row["toxic"] for row in rows], [vocabulary.value.count(row["text"]) for row in rows]
    )
    shared = spark.sparkContext.broadcast(model)
    votes = StructType([StructField("vote", DoubleType()), StructField("toxic", IntegerType())])
    cast = in_python(examples.select("doc", "toxic", "text"), lambda batches: _votes(batches, shared.value), votes)
    model.calibrate([(row["vote"], row["toxic"]) for row in cast.collect()])
    return model


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            terms = {term for word in words_of(text.as_py()) for term in terms_of(word)}
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([toxic] * len(terms), pa.int32())], ["term", "toxic"])


def _document_counts(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    """In how many documents of a task each term is; -1 stands for all documents."""
    counts: Counter[int] = Counter()
    for batch in batches:
        for text in batch.column(0):
            counts.update(vocabulary.count(text.as_py()).keys())
            counts[-1] += 1
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())], ["place", "n"])


def _votes(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column(0).to_pylist(), batch.column(2), strict=True)
        votes = [model.vote(text.as_py(), model.place.get(doc, -1))[0] for doc, text in pairs]
        yield pa.RecordBatch.from_arrays([pa.array(votes, pa.float64()), batch.column(1)], ["vote", "toxic"])


def scored(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row's id, ``held_out``, ``score``, ``predicted`` and ``evidence``, the ids of its nearest examples.

    The score is a function of the whole text; an example is not its own
    neighbour, so no row's label is in its own score. A NULL or empty text, and
    one without a telling term, has the score of the overall share; without any
    learned label that is 0. Rows without an id are scored and not held out;
    repeated rows are scored each. No row gives no row; further columns are not
    read. Narrow: no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = exact(docs, id_column, text_column).select(id_column, text_column, held_out(id_column))
    fields = [
        docs.schema[id_column],
        StructField("held_out", BooleanType()),
        StructField("score", DoubleType()),
        StructField("predicted", IntegerType()),
        StructField("evidence", ArrayType(LongType())),
    ]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1), strict=True)
            votes = [shared.value.vote(text.as_py(), shared.value.place.get(doc, -1)) for doc, text in rows]
            scores = [shared.value.score(vote) for vote, _ in votes]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(scores, pa.float64()),
                    pa.array([int(x >= THRESHOLD) for x in scores], pa.int32()),
                    pa.array([evidence for _, evidence in votes], pa.list_(pa.int64())),
                ],
                [field.name for field in fields],
            )

    return in_python(rows, score, StructType(fields))


def accepted(docs: DataFrame, model: Model, text_column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The rows that are not predicted toxic, with all their columns. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place, number = docs.columns.index(text_column), docs.columns.index(id_column)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(number).to_pylist(), batch.column(place), strict=True)
            votes = (shared.value.vote(text.as_py(), shared.value.place.get(doc, -1))[0] for doc, text in rows)
            yield batch.filter(pa.array([shared.value.score(vote) < THRESHOLD for vote in votes], pa.bool_()))

    return in_python(docs, kept, docs.schema)
