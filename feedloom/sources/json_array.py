"""Files that are one JSON array, cut into elements in parallel also where they are a single line.

The text is read in pieces that end with a closing curly bracket, wherever it
stands, so a file splits anywhere. Whether a piece begins inside a string, and
at what depth, follows from what is before it: a block maps either state at its
beginning to one at its end and to a change of depth, and these maps are put
together over the small block table. With the state at its beginning, each
block is then cut on its own; only the elements that lie across blocks meet.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.functions.text import is_blank, quoted, trimmed
from feedloom.session import stage
from feedloom.sources import lines as L

RAW = "__raw"
#: JSON as the standard has it.
STRICT = "map('allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false')"
_LAST = "~"
_PIECE = "__piece"
#: Weight of the pieces that one task orders: bytes of text, and so many bytes a piece for its numbers.
TASK_BYTES, PIECE_BYTES = 8 << 20, 100


def values(text: str) -> str:
    """The JSON values of a comma-separated list, as texts; NULL unless the whole text is such a list (SQL text).

    A parser stops at the end of the first array. A value of ours behind the
    list shows whether it came that far.
    """
    parsed = f"from_json(concat('[', {text}, ',\"{_LAST}\"]'), 'array<string>', {STRICT})"
    return f"transform(array({parsed}), x -> if(size(x) > 1 AND element_at(x, -1) <=> '{_LAST}', slice(x, 1, size(x) - 1), NULL))[0]"


def array_pieces(spark: SparkSession, paths: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The pieces of files, without the bracket at their end, and the staged block table.

    A block has ``block_no``, ``first_id``, ``n``, ``pieces_before``,
    ``is_array`` (the file's first character that is not blank is ``[``),
    ``open_id``, the file's last piece if no bracket ends it, and ``bytes``.
    """
    pieces = L.read_lines(spark, paths, F.lit(True), "}", file_size=F.col("_metadata.file_size"))
    begins = F.expr(f"ascii(left({trimmed(L.TEXT)}, 1))")
    blocks = pieces.groupBy(L.FILE, L.BLOCK).agg(
        F.count("*").alias("n"),
        F.min(L.LINE_ID).alias("first_id"),
        F.max(L.LINE_ID).alias("last_id"),
        F.sum(F.octet_length(L.TEXT)).alias("bytes"),
        F.max("file_size").alias("size"),
        F.min_by(F.when(F.col(L.BLOCK) == 0, begins), L.LINE_ID).alias("begins"),
    )
    whole, in_file = Window.partitionBy(L.FILE), Window.partitionBy(L.FILE).orderBy(L.BLOCK)
    # All pieces and a bracket behind each make up the file; of a compressed one the sizes say nothing, and its last
    # piece counts as open, as it is in every array that is whole.
    closed = F.sum("bytes").over(whole) + F.sum("n").over(whole) == F.col("size")
    last = F.lead(L.BLOCK).over(in_file).isNull()
    index = blocks.select(
        L.FILE,
        L.BLOCK,
        F.monotonically_increasing_id().alias("block_no"),
        "first_id",
        "n",
        F.coalesce(F.sum("n").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("pieces_before"),
        F.coalesce(F.max("begins").over(whole) == ord("["), F.lit(False)).alias("is_array"),
        F.when(last & ~closed, F.col("last_id")).alias("open_id"),
        "bytes",
    )
    return pieces.drop("file_size"), stage(index, "piece-blocks")


def _tasks(index: DataFrame) -> int:
    """How many tasks the blocks of arrays are dealt out to: a task's share is the same whatever the feed's size.

    Left to Spark, tasks grow with the feed until their compressed rows have
    its advised size, many times as much in memory where lines are alike.
    """
    blocks, size = index.where("is_array").agg(F.count("*"), F.sum(F.col("bytes") + F.col("n") * PIECE_BYTES)).first()
    return max(1, min(2 * blocks, math.ceil((size or 0) / TASK_BYTES)))


def _depth(text: str) -> str:
    size = f"octet_length({text})"
    opened, closed = (f"({size} - octet_length(translate({text}, '{pair}', '')))" for pair in ("{[", "}]"))
    return f"({opened} - {closed})"


def _measured(pieces: DataFrame, index: DataFrame) -> DataFrame:
    """Pieces of arrays with their quotes and their change of depth from outside and from inside a string."""
    arrays = index.where("is_array").drop("is_array", "bytes")
    rows = L.with_block_columns(pieces.join(F.broadcast(arrays.select(L.FILE).distinct()), L.FILE, "left_semi"), arrays)
    is_open = F.coalesce(F.col(L.LINE_ID) == F.col("open_id"), F.lit(False))
    rows = rows.withColumn("__open", is_open).where(~(F.col("__open") & F.expr(is_blank(L.TEXT))))
    bare = rows.withColumn("__bare", F.regexp_replace(L.TEXT, r"(?s)\\.", ""))
    quotes = F.octet_length("__bare") - F.octet_length(F.translate("__bare", '"', ""))
    strings = r'"[^"]*+(?:"|\z)'
    from_inside = F.regexp_replace("__bare", r'\A[^"]*+(?:"|\z)', "")
    bare = bare.withColumns({"__quotes": quotes, "__out": F.regexp_replace("__bare", strings, ""), "__in": F.regexp_replace(from_inside, strings, "")})
    ends_outside = F.when(F.col("__open"), F.lit(0)).otherwise(F.lit(1))
    odd = F.col("__quotes") % 2
    return bare.withColumns(
        {
            "__quotes": odd.cast("long"),
            "__out": (F.expr(_depth("__out")) - ends_outside * (1 - odd)).cast("long"),
            "__in": (F.expr(_depth("__in")) - ends_outside * odd).cast("long"),
        }
    ).drop("__bare")


def _earlier(column: str, window) -> Column:
    return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _block_states(pieces: DataFrame, index: DataFrame, tasks: int) -> DataFrame:
    """The staged block table with the state at each block's beginning and end."""
    in_block = Window.partitionBy("block_no").orderBy(L.LINE_ID)
    numbers = _measured(pieces, index).select("block_no", L.LINE_ID, "__quotes", "__out", "__in").repartition(tasks, "block_no")
    inside = _earlier("__quotes", in_block) % 2 == 1
    numbers = numbers.withColumn("__inside", inside)
    maps = numbers.groupBy("block_no").agg(
        F.sum("__quotes").alias("quotes"),
        F.sum(F.when(F.col("__inside"), F.col("__in")).otherwise(F.col("__out"))).alias("from_outside"),
        F.sum(F.when(F.col("__inside"), F.col("__out")).otherwise(F.col("__in"))).alias("from_inside"),
    )
    in_file = Window.partitionBy(L.FILE).orderBy(L.BLOCK)
    states = index.where("is_array").join(maps, "block_no", "left").fillna(0, ["quotes", "from_outside", "from_inside"])
    states = states.withColumn("inside_before", _earlier("quotes", in_file) % 2 == 1)
    states = states.withColumn("change", F.when(F.col("inside_before"), F.col("from_inside")).otherwise(F.col("from_outside")))
    states = states.withColumn("depth_before", _earlier("change", in_file))
    states = states.withColumn("depth_after", F.col("depth_before") + F.col("change"))
    states = states.withColumn("inside_after", F.col("inside_before") != (F.col("quotes") % 2 == 1))
    last = F.lead(L.BLOCK).over(in_file).isNull()
    return stage(
        states.select(
            L.FILE, "block_no", "pieces_before", "inside_before", "depth_before",
            # Whether no element lies across the block's end; behind a file's last block there is none.
            (last | (~F.col("inside_after") & (F.col("depth_after") <= 1))).alias("whole_end"),
            (last & (F.col("inside_after") | (F.col("depth_after") != 0))).alias("unfinished"),
        ),
        "block-states",
    )


def array_elements(pieces: DataFrame, index: DataFrame, on_broken: str) -> DataFrame:
    """``source_file``, ``record_number`` and the text of every element; NULL where the file is not JSON."""
    tasks = _tasks(index)
    states = _block_states(pieces, index, tasks)
    if on_broken == "fail":
        broken = states.where("unfinished").select(L.FILE).first()
        if broken is not None:
            raise ValueError(f"not valid JSON: {broken[0]}")
    small = states.select("block_no", "pieces_before", "inside_before", "depth_before", "whole_end")
    in_block = Window.partitionBy("block_no").orderBy(L.LINE_ID)
    rows = _measured(pieces, index).drop("pieces_before").repartition(tasks, "block_no").join(L.if_small(small), "block_no")
    inside = F.col("inside_before") != (_earlier("__quotes", in_block) % 2 == 1)
    rows = rows.withColumn("__inside", inside)
    rows = rows.withColumn("__change", F.when(F.col("__inside"), F.col("__in")).otherwise(F.col("__out")))
    rows = rows.withColumn("__depth", F.col("depth_before") + _earlier("__change", in_block))
    first = (F.col("pieces_before") == 0) & (F.col(L.LINE_ID) == F.col("first_id"))
    behind = (F.col("__depth") <= 0) & ~first
    starts = first | behind | ((F.col("__depth") == 1) & ~F.col("__inside"))
    rows = rows.withColumns({"__first": first, "__behind": behind, "__start": starts})
    rows = rows.withColumns(
        {
            "__chunk": F.last(F.when(F.col("__start"), F.col(L.LINE_ID)), ignorenulls=True).over(in_block),
            "__closes": F.col("__depth") + F.col("__change") == 0,
            _PIECE: F.concat(L.TEXT, F.when(F.col("__open"), "").otherwise("}")),
        }
    )
    # A block's chunks, grouped where its pieces already are: each holds whole elements, but for the first without a
    # beginning and the last without an end.
    ordered = F.array_sort(F.collect_list(F.struct(L.LINE_ID, _PIECE)))
    chunks = rows.groupBy("block_no", L.FILE, L.BLOCK, "__chunk", "whole_end").agg(
        F.array_join(F.transform(ordered, lambda p: p[_PIECE]), "").alias("body"),
        F.bool_or("__first").alias("first"),
        F.bool_or("__behind").alias("behind"),
        F.bool_or("__closes").alias("closes"),
    )
    tail = F.max("__chunk").over(Window.partitionBy("block_no"))
    across = F.col("__chunk").isNull() | ((F.col("__chunk") == tail) & ~F.col("whole_end"))
    chunks = stage(chunks.withColumn("across", across).drop("whole_end"), "array-chunks")

    in_file = Window.partitionBy(L.FILE).orderBy(L.BLOCK, F.col("__chunk").isNotNull())
    home = F.last(F.when(F.col("__chunk").isNotNull(), F.struct(L.BLOCK, "__chunk")), ignorenulls=True).over(in_file)
    parts = F.array_sort(F.collect_list(F.struct("at", "tail", "body")))
    met = (
        chunks.where("across")
        .withColumn("home", home)  # two parts at most to a block of the file
        .select(L.FILE, "home", F.col(L.BLOCK).alias("at"), F.col("__chunk").isNotNull().alias("tail"), "body", "first", "behind", "closes")
        .groupBy(L.FILE, "home")
        .agg(
            F.array_join(F.transform(parts, lambda p: p["body"]), "").alias("body"),
            *(F.bool_or(flag).alias(flag) for flag in ("first", "behind", "closes")),
        )
        .select(L.FILE, f"home.{L.BLOCK}", "home.__chunk", "body", "first", "behind", "closes")
    )
    whole = chunks.where("NOT across").select(L.FILE, L.BLOCK, "__chunk", "body", "first", "behind", "closes")
    elements = stage(_elements(whole.unionByName(met)), "elements")
    return _numbered(elements, tasks)


def _elements(chunks: DataFrame) -> DataFrame:
    """(file, block, chunk, all): the elements of each chunk in order, one NULL for a chunk that is not JSON.

    A chunk begins with the array's bracket if it is the first, else with a
    comma, and has elements; the closing one may be the closing bracket alone,
    or, if it is also the first, the two brackets.
    """
    body = F.expr(trimmed("body"))
    opener = F.when(F.col("first"), F.lit("[")).otherwise(F.lit(","))
    opened = F.col("body").startswith(opener) & ~F.col("behind")
    inner = F.when(opened, F.substring(F.col("body"), 2, 2**31 - 1))
    inner = F.when(F.col("closes"), F.when(F.col("body").endswith("]"), F.regexp_replace(inner, r"\]\z", ""))).otherwise(inner)
    ends = F.col("closes") & (F.col("body") == "]") & ~F.col("first")
    empty = F.col("closes") & F.col("first") & F.expr(is_blank("inner")) & F.col("inner").isNotNull()
    parsed = chunks.withColumn("body", body).withColumn("inner", inner).withColumn("none", ends | empty)
    parsed = parsed.where(~F.col("none")).select(L.FILE, L.BLOCK, "__chunk", F.expr(values("inner")).alias("all"))
    return parsed.withColumn("all", F.expr("coalesce(transform(all, x -> coalesce(x, 'null')), array(cast(NULL AS string)))"))


def _numbered(elements: DataFrame, tasks: int) -> DataFrame:
    """Numbers 1, 2, 3... per file, from the counts of chunks and blocks."""
    in_block, in_file = Window.partitionBy(L.FILE, L.BLOCK).orderBy("__chunk"), Window.partitionBy(L.FILE).orderBy(L.BLOCK)
    sizes = elements.select(L.FILE, L.BLOCK, "__chunk", F.size("all").alias("size"))
    blocks = sizes.groupBy(L.FILE, L.BLOCK).agg(F.sum("size").alias("size"))
    blocks = stage(blocks.select(L.FILE, L.BLOCK, _earlier("size", in_file).alias("lines_before")), "element-blocks")
    placed = elements.repartition(tasks, L.FILE, L.BLOCK).withColumn("__before", _earlier_sizes(in_block))
    placed = placed.select(L.FILE, L.BLOCK, "__before", F.posexplode("all").alias("__at", RAW))
    numbered = L.with_block_columns(placed, blocks)
    return numbered.select(L.FILE, (F.col("lines_before") + F.col("__before") + F.col("__at") + 1).alias("record_number"), RAW)


def _earlier_sizes(in_block) -> Column:
    return F.coalesce(F.sum(F.size("all")).over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
