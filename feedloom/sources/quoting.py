"""CSV records whose quoted cells contain line breaks, put together in parallel.

A line either leaves the quoting state as it is, flips it, or fixes it, so the
state at any line follows from running sums: first inside each block (one
bounded window per block), then over the few rows of the block table. No file
is read by a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions.text import quoted
from feedloom.session import stage
from feedloom.sources import lines as L

#: A quoted cell starts the line or follows a separator; quotes inside it are doubled.
COMPLETE_CELL = r'(?<![^,])"[^"]*+(?:""[^"]*+)*+"'
_CELL = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|(?!")[^,]*+)'
#: A line whose quoted cells are all complete.
_CLOSED_LINE = rf"\A{_CELL}(?:,{_CELL})*+\z"
#: From inside a quoted cell up to and including its closing quote.
_CLOSING = r'\A[^"]*+(?:""[^"]*+)*+"'


def ends_open(text: str) -> str:
    """Whether a line that starts outside quotes ends inside a quoted cell (SQL text)."""
    return f"(instr({text}, '\"') > 0 AND NOT {text} RLIKE {quoted(_CLOSED_LINE)})"


def _ends_open_from_inside(text: str) -> str:
    """Whether a line that starts inside a quoted cell ends inside one (SQL text)."""
    rest = f"regexp_replace({text}, {quoted(_CLOSING)}, '')"
    return f"(NOT {text} RLIKE {quoted(_CLOSING)} OR {ends_open(rest)})"


def _chain(df: DataFrame, window, from_outside: str, from_inside: str) -> DataFrame:
    """Running state along a window, for either state before its first row.

    Adds ``after_outside`` / ``after_inside``: the state behind each row if the
    window began outside / inside quotes.
    """
    outside, inside = F.col(from_outside), F.col(from_inside)
    fixes = outside == inside
    flips = F.sum((outside & ~inside).cast("bigint")).over(window)
    df = df.withColumn("__flips", flips)
    fixed = F.last(F.when(fixes, F.struct(outside.alias("state"), F.col("__flips"))), ignorenulls=True).over(window)
    df = df.withColumn("__fixed", fixed)

    def after(start: bool) -> Column:
        base = F.coalesce(F.col("__fixed.state"), F.lit(start))
        turned = (F.col("__flips") - F.coalesce(F.col("__fixed.__flips"), F.lit(0))) % 2 == 1
        return base != turned

    return df.withColumns({"after_outside": after(False), "after_inside": after(True)}).drop("__flips", "__fixed")


def assemble_quoted(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records instead of lines, and their block table (see ``lines.block_index``).

    ``lines`` must end with LF only and include the empty ones: inside quotes
    all of that is content. Only the lines of records that span several lines
    are grouped.
    """
    in_block = Window.partitionBy(L.FILE, L.BLOCK).orderBy(L.LINE_ID)
    up_to_here = in_block.rowsBetween(Window.unboundedPreceding, 0)
    marked = lines.selectExpr("*", f"{ends_open(L.TEXT)} AS __out", f"{_ends_open_from_inside(L.TEXT)} AS __in")
    states = _chain(marked, up_to_here, "__out", "__in").drop("__out", "__in")
    for start in (False, True):
        name = "inside" if start else "outside"
        before = F.coalesce(F.lag(f"after_{name}").over(in_block), F.lit(start))
        states = states.withColumn(f"before_{name}", before)
        starts = ~F.col(f"before_{name}") & ~F.col(L.TEXT).isin("", "\r")
        states = states.withColumn(f"starts_{name}", F.sum(starts.cast("bigint")).over(up_to_here))
    states = stage(states, "quoting")

    # The block table: state behind each block and records starting in it, for either state before it.
    blocks = states.groupBy(L.FILE, L.BLOCK).agg(
        F.max_by("after_outside", L.LINE_ID).alias("end_outside"),
        F.max_by("after_inside", L.LINE_ID).alias("end_inside"),
        F.max("starts_outside").alias("starts_outside"),
        F.max("starts_inside").alias("starts_inside"),
    )
    in_file = Window.partitionBy(L.FILE).orderBy(L.BLOCK)
    chained = _chain(blocks, in_file.rowsBetween(Window.unboundedPreceding, 0), "end_outside", "end_inside")
    carry = F.coalesce(F.lag("after_outside").over(in_file), F.lit(False))
    chained = chained.withColumn("inside", carry).withColumn(
        "n", F.when(F.col("inside"), F.col("starts_inside")).otherwise(F.col("starts_outside"))
    )
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    chained = stage(
        chained.select(
            L.FILE,
            L.BLOCK,
            "inside",
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("records_before"),
            F.last("after_outside").over(in_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(
                "unfinished"
            ),
            F.sum("n").over(Window.partitionBy(L.FILE)).alias("file_records"),
        ),
        "quoting-blocks",
    )
    broken = chained.where("unfinished").select(L.FILE).first()
    if broken is not None:
        raise ValueError(f"a quoted value is not closed at the end of {broken[0]}")

    known = L.with_block_columns(states, chained)
    pick = lambda name: F.when(F.col("inside"), F.col(f"{name}_inside")).otherwise(F.col(f"{name}_outside"))
    placed = known.select(
        L.FILE,
        (F.col("records_before") + pick("starts")).alias("__record"),
        "file_records",
        (~pick("before") & ~pick("after")).alias("__whole"),
        L.BLOCK,
        L.LINE_ID,
        L.TEXT,
    )
    whole = placed.where(F.col("__whole") & ~F.col(L.TEXT).isin("", "\r")).select(
        L.FILE, "__record", "file_records", L.TEXT
    )
    pieces = F.array_sort(F.collect_list(F.struct(L.BLOCK, L.LINE_ID, L.TEXT)))
    joined = (
        placed.where(~F.col("__whole"))
        .groupBy(L.FILE, "__record", "file_records")
        .agg(F.array_join(F.transform(pieces, lambda p: p[L.TEXT]), "\n").alias(L.TEXT))
    )
    # From here on a file is one block and a record's id is its number in the file.
    records = whole.unionByName(joined).select(
        L.FILE,
        F.lit(0).cast("bigint").alias(L.BLOCK),
        F.col("__record").alias(L.LINE_ID),
        F.regexp_replace(L.TEXT, r"\r\z", "").alias(L.TEXT),
        "file_records",
    )
    first = records.where(F.col(L.LINE_ID) == 1).select(
        L.FILE,
        L.BLOCK,
        F.lit(1).cast("bigint").alias("first_id"),
        F.col("file_records").alias("n"),
        F.lit(0).cast("bigint").alias("lines_before"),
        F.col(L.TEXT).alias("first_line"),
    )
    return records.drop("file_records"), stage(first, "blocks")
