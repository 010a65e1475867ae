"""Text lines of a feed with their exact position, read in parallel.

Files are cut into blocks wherever Spark likes. Inside a block the lines are in
order, so a line's number is the number of lines in the file's earlier blocks
plus its place in its own block. One narrow pass counts the lines per block;
only that small table is ordered, never the lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from feedloom.session import configure, stage

FILE, BLOCK, LINE_ID, TEXT = "source_file", "__block", "__line_id", "__text"
#: A block table is broadcast up to this measured size, about a million blocks; lines are not shuffled then.
BROADCAST_BYTES = 128 << 20


def as_paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_lines(
    spark: SparkSession, paths: str | Sequence[str], keep: Column | None = None, line_end: str | None = None, **more: Column
) -> DataFrame:
    """The lines of one file, a folder, a glob or a list of these.

    Lines not satisfying ``keep`` (a condition on the line text; default: not
    empty) are dropped before the ids are given. Lines end with LF, CR or both,
    or with ``line_end`` only. ``more`` adds columns of the file's metadata.
    """
    configure(spark)
    keep = F.length(TEXT) > 0 if keep is None else keep
    return (
        spark.read.text(as_paths(paths), lineSep=line_end)
        .select(
            F.col("_metadata.file_path").alias(FILE),
            F.col("_metadata.file_block_start").alias(BLOCK),
            F.col("value").alias(TEXT),
            *(column.alias(name) for name, column in more.items()),
        )
        .where(keep)
        .withColumn(LINE_ID, F.monotonically_increasing_id())
    )


def block_index(lines: DataFrame, first_line: Column, **sums: Column) -> DataFrame:
    """Per block: its first line id, its lines and the lines before it in the file.

    ``first_line`` marks the lines that may be a file's first line; the column
    of that name holds the file's first line if it was marked, else NULL. Only
    marked lines of a file's first block enter the grouping key, so the pass is
    a plain hash aggregation of counts. ``sums`` adds totals per block.
    """
    marked = F.when((F.col(BLOCK) == 0) & first_line, F.col(TEXT))
    groups = lines.groupBy(FILE, BLOCK, marked.alias("line")).agg(
        F.count("*").alias("n"),
        F.min(LINE_ID).alias("first_id"),
        *[F.sum(c).alias(name) for name, c in sums.items()],
    )
    blocks = groups.groupBy(FILE, BLOCK).agg(
        F.sum("n").alias("n"),
        F.min("first_id").alias("first_id"),
        F.min_by("line", "first_id").alias("line"),
        *[F.sum(name).alias(name) for name in sums],
    )
    # One row per block (128 MB by default), so a file's window stays small.
    in_file = Window.partitionBy(FILE).orderBy(BLOCK)
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    return stage(
        blocks.select(
            FILE,
            BLOCK,
            "first_id",
            "n",
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("lines_before"),
            F.first("line").over(in_file).alias("first_line"),
            *sums,
        ),
        "blocks",
    )


def with_all_first_lines(lines: DataFrame, index: DataFrame) -> DataFrame:
    """``index`` with the first line of every file, reading the feed again only if some are missing."""
    unknown = index.where(F.col("first_line").isNull())
    if unknown.isEmpty():
        return index
    starts = unknown.where(F.col("lines_before") == 0).select(FILE, BLOCK, F.col("first_id").alias(LINE_ID))
    found = lines.join(starts, [FILE, BLOCK, LINE_ID]).select(FILE, F.col(TEXT).alias("found_line"))
    completed = index.join(found, FILE, "left").withColumn(
        "first_line", F.coalesce("first_line", "found_line")
    )
    return stage(completed.drop("found_line"), "blocks")


def if_small(blocks: DataFrame) -> DataFrame:
    """A block table marked for broadcast if its rows, measured, are small enough."""
    fixed = 32 + 16 * len(blocks.columns)
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in blocks.schema if f.dataType == StringType()]
    lists = [8 * F.greatest(F.size(f.name), F.lit(0)) for f in blocks.schema if isinstance(f.dataType, ArrayType)]
    size = blocks.agg(F.sum(sum([*texts, *lists], F.lit(fixed)))).first()[0] or 0
    return F.broadcast(blocks) if size <= BROADCAST_BYTES else blocks


def with_block_columns(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """Lines with the columns of their block; a line without a block, or outside its lines, is an error.

    ``blocks`` has one row per block; if it holds ``first_id`` and ``n``, a
    line's place must be one of the ``n`` counted ones. Both reads of a feed cut
    it alike unless settings or files change in between, and then some line is
    out of place. The error is part of every column taken from the block table:
    a check beside them would be lost when a later filter, which NULL does not
    pass, makes the optimizer turn the outer join into an inner one.

    The block table is broadcast while it is small, which is measured; beyond
    that it is an ordinary join on (file, block), one block to a group.
    """
    own = [c for c in blocks.columns if c not in (FILE, BLOCK)]
    found = blocks.select(FILE, BLOCK, F.lit(True).alias("__found"), *own)
    joined = lines.join(if_small(found), [FILE, BLOCK], "left")
    known = F.col("__found").isNotNull()
    if "first_id" in own and "n" in own:
        known = known & (F.col(LINE_ID) - F.col("first_id")).between(F.lit(0), F.col("n") - 1)
    lost = F.raise_error(F.lit("the feed changed while it was read"))
    checked = {c: F.when(known, F.col(c)).otherwise(lost.cast(blocks.schema[c].dataType)) for c in own}
    return joined.select(*lines.columns, *(column.alias(c) for c, column in checked.items()))


def line_number() -> Column:
    """Number of a line in its file, from 0, after ``with_block_columns``."""
    return F.col("lines_before") + F.col(LINE_ID) - F.col("first_id")
