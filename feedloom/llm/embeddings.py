"""Near-duplicate vectors by counting window collisions of their projections."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, LongType, StructField, StructType

from feedloom.llm.cells import Forest, Groups, dealt, whole_groups
from feedloom.llm.common import Scratch, exact, in_python
from feedloom.llm.components import components

COSINE = 0.95
#: Share of the pairs at exactly the least cosine that meet in a cell; closer pairs meet more often.
RECALL = 0.9995
#: Vectors that a cell would hold if all directions were alike.
PER_CELL = 256
#: Misses that half the windows' width allows on the axes together, see ``Windows``.
MISSES = 3
SEED = 20
_USABLE = """
    size(embedding) > 0 AND NOT exists(embedding, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity'))
    AND exists(embedding, x -> x <> 0)
"""


def cell_plan(vectors: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """(projections to a table, tables): each doubling of the vectors adds a projection, the tables keep the recall."""
    projections = max(1, math.ceil(math.log2(max(2, vectors / PER_CELL))))
    alike = (1 - math.acos(cosine) / math.pi) ** projections
    return projections, max(1, math.ceil(math.log(1 - recall) / math.log1p(-alike)))


@functools.lru_cache(maxsize=8)
def directions(dimension: int, count: int) -> np.ndarray:
    """Random directions, one to a column; the same for a dimension and count everywhere."""
    return np.random.default_rng([SEED, dimension]).standard_normal((count, dimension)).T


@functools.lru_cache(maxsize=8)
def axes(dimension: int) -> np.ndarray:
    """A random orthonormal basis, one axis to a column."""
    return np.linalg.qr(np.random.default_rng([SEED, dimension, 1]).standard_normal((dimension, dimension)))[0]


class Windows:
    """Counts in how many of its projections a pair lies within a window around the other.

    Projections on an orthonormal basis keep distances: the squares of a pair's
    differences sum to 2 - 2 cos. At most ``MISSES`` of them can be wider than
    half the window, so a pair of the least cosine or more collides on all other
    axes: the count that is asked for loses no link.
    """

    def __init__(self, units: np.ndarray, cosine: float):
        self._places = units @ axes(units.shape[1])
        span = 2 - 2 * cosine
        self._half = math.sqrt(span / (MISSES + 1)) * (1 + 1e-9) + 1e-12
        self._widest = math.sqrt(span) * (1 + 1e-9) + 1e-12

    def order(self, group: np.ndarray) -> np.ndarray:
        """Rows sorted by group, then along the first axis."""
        return np.lexsort((self._places[:, 0], group))

    def passing(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs collide often enough; those with too many misses on the first axes are not looked at further."""
        kept = np.flatnonzero(np.abs(self._places[a, 0] - self._places[b, 0]) <= self._widest)
        misses = np.zeros(len(kept), np.int16)
        for at in range(0, self._places.shape[1], 8):
            some = self._places[:, at : at + 8]
            misses += (np.abs(some[a[kept]] - some[b[kept]]) > self._half).sum(axis=1, dtype=np.int16)
            few = misses <= MISSES
            kept, misses = kept[few], misses[few]
        return kept


def units_of(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of unit length, in double precision."""
    length = len(vectors[0])
    rows = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, length)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _keyed(batches: Iterator[pa.RecordBatch], projections: int, tables: int) -> Iterator[pa.RecordBatch]:
    """Rows (node, rows, embedding) with the number of their cell in each table."""
    for batch in batches:
        vectors = batch.column(2)
        lengths = vectors.value_lengths().to_numpy()
        for length in np.unique(lengths).tolist():
            same = batch.take(pa.array(np.flatnonzero(lengths == length)))
            signs = units_of(same.column(2)) @ directions(length, projections * tables) > 0
            keys = signs.reshape(-1, tables, projections) @ (1 << np.arange(projections, dtype=np.int64))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, tables, dtype=np.int32)), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([*same.columns, flat], ["node", "rows", "embedding", "keys"])


def _compared(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """Links of the pairs of whole groups, vectors of one length at a time."""
    for groups in whole_groups(batches):
        lengths = groups.table.column("embedding").combine_chunks().value_lengths().to_numpy()
        for length in np.unique(lengths).tolist():
            yield _links_of(Groups(groups.table.filter(pa.array(lengths == length))), cosine)


def _links_of(groups: Groups, cosine: float) -> pa.RecordBatch:
    """Rows (node, node, its links here) and, with 0 links, the ends of a spanning forest."""
    embedding, keys = (groups.table.column(name).combine_chunks() for name in ("embedding", "keys"))
    rows, grid = (groups.table.column(name).to_numpy() for name in ("rows", "grid"))
    units, node = units_of(embedding), groups.node
    keys = keys.flatten().to_numpy().reshape(len(node), -1)
    windows, tables = Windows(units, cosine), np.arange(keys.shape[1])
    order = windows.order(groups.group)
    counts, forest = np.zeros(len(node), np.int64), Forest(len(node))
    for left, right in groups.pairs(order):
        for at in range(0, len(left), 1 << 17):
            a, b = order[left[at : at + (1 << 17)]], order[right[at : at + (1 << 17)]]
            kept = windows.passing(a, b)
            a, b = a[kept], b[kept]
            near = np.einsum("ij,ij->i", units[a], units[b]) >= cosine
            a, b = a[near], b[near]
            met = ((keys[a] == keys[b]) & (tables < grid[a][:, None])).any(axis=1)  # counted in an earlier table
            a, b = a[~met], b[~met]
            np.add.at(counts, a, rows[b])
            np.add.at(counts, b, rows[a])
            forest.add(a, b)
    low, high = forest.ends(node)
    linked, nothing = np.flatnonzero(counts), np.zeros(len(low), np.int64)
    ends = (np.concatenate([node[linked], low]), np.concatenate([node[linked], high]), np.concatenate([counts[linked], nothing]))
    return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in ends], ["low", "high", "links"])


def near_duplicates(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", cosine: float = COSINE, recall: float = RECALL
) -> DataFrame:
    """How many vectors each vector is linked to, and the smallest id that it reaches by links.

    Columns: the id, ``n_links``, ``component_id``, ``kept`` (its id is the
    component's). A pair is linked if it is found and its cosine, in double
    precision, is at least ``cosine``. NULL, empty and zero vectors and those
    with a NULL or non-finite component are linked to nothing, and neither are
    vectors of different lengths or rows without an id (no component, not
    kept). Copies of a vector are linked; rows that repeat an id count as
    vectors. No row gives no row; other columns are not read.

    Copies are one vector with a number of rows. Counting collisions of all
    pairs would look at a fixed share of them, so pairs are dealt out first:
    in each of several tables, a vector's cell is given by the signs of some
    random projections, and two vectors at the least cosine share a cell of
    some table with probability ``recall``. In a cell, vectors are sorted along
    an axis, pairs in each other's window are counted over all axes (see
    ``Windows``) and those that pass are verified. A link is counted in the
    first table in which its ends meet; of the links only counts and a spanning
    forest leave the task. Large cells are dealt out in parts, see ``dealt``.
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession)
    given = exact(vectors, id_column, vector_column).toDF("id", "embedding")
    usable = given.where("id IS NOT NULL").where(_USABLE)
    distinct = usable.groupBy("embedding").agg(F.min("id").cast("long").alias("node"), F.count("*").alias("rows"))
    distinct = scratch.write(distinct.select("node", "rows", "embedding"), "vectors")
    projections, tables = cell_plan(distinct.count(), cosine, recall)

    keyed_schema = StructType([*distinct.schema.fields, StructField("keys", ArrayType(LongType()))])
    keyed = in_python(distinct, lambda batches: _keyed(batches, projections, tables), keyed_schema)
    cells = keyed.select("*", F.posexplode("keys").alias("grid", "key"))
    cells = cells.withColumn("cell", F.xxhash64("grid", "key", F.size("embedding")))
    pairs = dealt(cells, "rows", "embedding", "keys", "grid")
    ends = StructType([StructField(name, LongType()) for name in ("low", "high", "links")])
    found = scratch.write(in_python(pairs, lambda batches: _compared(batches, cosine), ends), "vector-links")

    linked = found.where("low = high").groupBy(F.col("low").alias("node")).agg(F.sum("links").alias("links"))
    reached = components(spark, found.select("low", "high"))
    classes = distinct.join(linked, "node", "left").join(reached, "node", "left")
    classes = classes.select(
        "embedding",
        (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    )
    classes = scratch.write(classes, "vector-classes")
    known = given.join(classes, (given["embedding"] == classes["embedding"]) & given["id"].isNotNull(), "left")
    component = F.coalesce("component_id", F.col("id").cast("long"))
    return known.select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"),
    )
