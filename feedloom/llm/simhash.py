"""Near-duplicate documents by SimHash fingerprints, found in the space of their bit counts."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from feedloom.llm.cells import CELL, Forest, dealt, whole_groups
from feedloom.llm.common import Scratch, exact, in_python, map_batches
from feedloom.llm.components import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Blocks that the 32 two-bit segments fall into; any two points within the distance agree on BLOCKS - DISTANCE of them.
BLOCKS = 7


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text, as a signed number; 0 for a text without words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, and the six ASCII spaces only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = [end - 1 for end in accumulate(len(word) + 1 for word in words)]
    starts = [0, *(end + 1 for end in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :], strict=False)]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], "<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, ``fp``) of every row: lower-case words A-Z, shingles with repeats, a bit set where over half the hashes have it."""

    def hashed(batch: pa.RecordBatch) -> list[pa.Array]:
        return [batch.column(0), pa.array([fingerprint(text, shingle) for text in batch.column(1).to_pylist()], pa.int64())]

    fields = [docs.schema[id_column], StructField("fp", LongType())]
    return map_batches(exact(docs, id_column, text_column), hashed, fields)


def block_masks(blocks: int, distance: int) -> list[int]:
    """For each choice of ``blocks - distance`` blocks, the bits of their segments, as signed numbers."""
    blocks_of = [range(64)[2 * (32 * i // blocks) : 2 * (32 * (i + 1) // blocks)] for i in range(blocks)]
    masks = [sum(1 << bit for block in chosen for bit in block) for chosen in combinations(blocks_of, blocks - distance)]
    return [mask - (1 << 64) if mask >> 63 else mask for mask in masks]


def segment_counts(fp: Column) -> Column:
    """A fingerprint's point: the number of ones in each of its 32 two-bit segments, packed two bits each."""
    other, lower = F.shiftrightunsigned(fp, 1), F.lit(0x5555555555555555).cast("long")
    both, either = fp.bitwiseAND(other).bitwiseAND(lower), fp.bitwiseXOR(other).bitwiseAND(lower)
    return F.shiftleft(both, 1).bitwiseOR(either)


def links(spark: SparkSession, points: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, cell: int = CELL) -> DataFrame:
    """Links that join the same points as all pairs of ``points`` (``node``, ``fp``, each distinct) within the distance.

    Range join on a grid. A point's coordinates are the ones of its segments;
    the Manhattan distance of two points is at most the Hamming distance of
    their fingerprints. A ball of radius ``distance`` leaves at least
    ``blocks - distance`` of the blocks of coordinates as they are, so two
    points in range meet in a cell of one of the grids over that many blocks.
    Cell mates are first held against the Manhattan bound, then compared bit by
    bit. Of the links in a cell only a spanning forest leaves the task, so a
    dense group gives no more links than it has points.

    Cells with more than ``cell`` points are dealt out in parts, see ``dealt``.
    """
    masks = F.array(*(F.lit(mask).cast("long") for mask in block_masks(blocks, distance)))
    grids = points.select("node", "fp", F.posexplode(masks).alias("grid", "mask"))
    cells = grids.select("node", "fp", F.xxhash64("grid", segment_counts(F.col("fp")).bitwiseAND(F.col("mask"))).alias("cell"))
    ends = StructType([StructField("low", LongType()), StructField("high", LongType())])
    return in_python(dealt(cells, "fp", size=cell), lambda batches: _forests(batches, distance), ends).distinct()


def _forests(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    for groups in whole_groups(batches):
        fp = groups.table.column("fp").to_numpy().view(np.uint64)
        counts = fp - ((fp >> np.uint64(1)) & np.uint64(0x5555555555555555))
        forest = Forest(len(fp))
        for a, b in groups.pairs(np.arange(len(fp))):
            near = _manhattan(counts[a], counts[b]) <= distance
            a, b = a[near], b[near]
            near = np.bitwise_count(fp[a] ^ fp[b]) <= distance
            forest.add(a[near], b[near])
        yield pa.RecordBatch.from_arrays([pa.array(end) for end in forest.ends(groups.node)], ["low", "high"])


def _manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of packed two-bit counts 0, 1, 2: their differences are 0, 1 or 2 where the bits differ by 0, by 1 or 3, by 2."""
    differing = a ^ b
    odd = differing & np.uint64(0x5555555555555555)
    two = (differing >> np.uint64(1)) & ~odd & np.uint64(0x5555555555555555)
    return np.bitwise_count(odd) + 2 * np.bitwise_count(two)


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """The fingerprint of every row and the smallest id that it reaches by links of fingerprints.

    Columns: the id, ``fingerprint`` (16 lower-case hex digits), ``component_id``.
    Fingerprints that differ in ``distance`` bits at most are linked, equal
    ones too, those of texts without words (zero; a NULL text is empty) like
    any other. A row without an id has a fingerprint, is linked to nothing and
    has no component; rows that repeat an id keep their places and are not
    linked by it. No row gives no row; columns other than the two named are
    not read.

    Texts are read once: the ids and fingerprints go to the shared folder.
    Copies meet by equal fingerprints before any comparison, so a group of
    copies is one point whatever its size.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    hashed = fingerprints(docs, id_column, text_column, shingle).withColumnRenamed(id_column, "doc")
    hashed = scratch.write(hashed, "fingerprints")
    classes = _classes(spark, hashed, distance)
    return hashed.join(classes, "fp", "left").select(
        F.col("doc").alias(id_column),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.expr("CASE WHEN doc IS NOT NULL THEN component END").alias("component_id"),
    )


def _classes(spark: SparkSession, hashed: DataFrame, distance: int) -> DataFrame:
    """(fp, root, component): the least fingerprint that one with an id reaches, and the least id of all that reach it.

    Fingerprints are the nodes, not ids: unlike texts under one id are not
    linked by it. Two groups may have the same least id, never the same root.
    """
    scratch = Scratch(spark)
    points = scratch.write(hashed.where("doc IS NOT NULL").groupBy("fp").agg(F.min("doc").alias("least")), "points")
    reached = components(spark, links(spark, points.select(F.col("fp").alias("node"), "fp"), distance))
    reached = reached.withColumnsRenamed({"node": "fp", "component": "root"})
    rooted = scratch.write(points.join(reached, "fp", "left"), "rooted")
    ids = scratch.write(rooted.where("root IS NOT NULL").groupBy("root").agg(F.min("least").alias("component")), "ids")
    linked = rooted.where("root IS NOT NULL").join(ids, "root").select("fp", "root", "component")
    alone = rooted.where("root IS NULL").select("fp", F.col("fp").alias("root"), F.col("least").alias("component"))
    return scratch.write(linked.union(alone), "classes")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each group of linked fingerprints, with all its columns: that of least id, then of least text hash.

    Groups are of rows, whatever their ids: unlike texts under one id stay one
    each, and rows without an id come behind those with one. Of rows equal in
    id and text one stays.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    hash_of = F.coalesce(F.md5(docs[text_column]), F.lit(""))
    keys = docs.select(F.struct(docs[id_column].alias("doc"), hash_of.alias("hash")).alias("key"), docs[text_column].alias("text"))
    hashed = scratch.write(fingerprints(keys, "key", "text").select("key.doc", "key.hash", "fp"), "fingerprints")
    classes = _classes(spark, hashed.select(F.lit(0).alias("doc"), "fp"), DISTANCE).select("fp", "root")
    first = F.min(F.struct(F.col("doc").isNull().alias("no_id"), "doc", "hash"))
    kept = hashed.join(classes, "fp").groupBy("root").agg(first.alias("kept")).select("kept.*")
    rows = docs.select(F.struct("*").alias("row"), docs[id_column].alias("id"), hash_of.alias("text_hash"))
    turn = F.row_number().over(Window.partitionBy("id", "text_hash").orderBy("text_hash"))
    same = rows["id"].eqNullSafe(kept["doc"]) & (rows["text_hash"] == kept["hash"])
    firsts = rows.join(kept, same, "left_semi").withColumn("turn", turn).where("turn = 1")
    return firsts.select("row.*")
