"""JSON feeds: one object per line, an array of objects, or objects in any layout.

Files with one object per line are read line by line. Other objects in any
layout are cut into elements in parallel: no line starts inside a string, so a
line's nesting depth is a running sum of its brackets, first inside each block,
then over the small block table. Arrays, which often are one line, are cut in
``json_array``, at brackets and not at lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.functions.text import is_blank, name, quoted, trimmed
from feedloom.schema import LIST, STRUCT, Field
from feedloom.session import stage
from feedloom.sources import lines as L
from feedloom.sources.json_array import RAW, STRICT, array_elements, array_pieces, values

_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
#: A line of a one-object-per-line file; an object glued to another one is not.
_GLUED = r"\}\s*\{"
#: From the last match up to the next pair of glued objects, skipping strings.
_UP_TO_GLUED = rf"\G((?:[^\"}}]++|{_STRING}|\}}(?!\s*+\{{))*+)\}}\s*+\{{"


def _one_object(text: str) -> str:
    t = trimmed(text)
    return f"(left({t}, 1) = '{{' AND right({t}, 1) = '}}' AND NOT {text} RLIKE {quoted(_GLUED)})"


def _depth_change(text: str) -> str:
    bare = f"regexp_replace({text}, {quoted(_STRING)}, '')"
    size = f"octet_length({bare})"
    opened, closed = (f"({size} - octet_length(translate({bare}, '{pair}', '')))" for pair in ("{[", "}]"))
    return f"cast({opened} - {closed} AS bigint)"


def read_json_elements(spark: SparkSession, paths: str | Sequence[str], on_broken: str = "fail") -> DataFrame:
    """``source_file``, ``record_number`` and the text of every element.

    The text is NULL where a part of a file is not JSON: text before or behind
    an object or an array, a missing comma or one too many, an object that is
    not closed. The last one fails at once unless ``on_broken`` is "dead_letter".
    """
    pieces, index = array_pieces(spark, paths)
    files = index.groupBy(L.FILE).agg(F.max("is_array").alias("is_array"))
    arrays, others = files.agg(F.count_if("is_array"), F.count_if(~F.col("is_array"))).first()
    parts = []
    if others or not arrays:
        # Files of other layouts beside arrays are named one by one: reading arrays line by line would not end.
        named = [row[0] for row in files.where(~F.col("is_array")).collect()] if arrays else paths
        parts.append(_objects(spark, named, on_broken))
    if arrays:
        parts.append(array_elements(pieces, index, on_broken))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _objects(spark: SparkSession, paths: str | Sequence[str], on_broken: str) -> DataFrame:
    """Elements of files that are no arrays."""
    rows = L.read_lines(spark, paths, keep=F.expr(f"NOT {is_blank(L.TEXT)}"))
    index = L.block_index(rows, F.lit(False), other=F.expr(f"if({_one_object(L.TEXT)}, 0L, 1L)"))
    index = index.withColumn("free_form", F.max(F.col("other") > 0).over(Window.partitionBy(L.FILE)))
    facts = index.agg(F.count("*").alias("blocks"), F.count_if("free_form").alias("free")).first()
    plain = L.with_block_columns(rows, index.select(L.FILE, L.BLOCK, "first_id", "n", "lines_before", "free_form"))
    plain = plain.where("NOT free_form").select(
        L.FILE,
        (L.line_number() + 1).alias("record_number"),
        # Bound to ``free_form``, or a check of the text would be pushed below the join, to lines of other files.
        F.expr(f"CASE WHEN free_form THEN '' WHEN size({values(L.TEXT)}) = 1 THEN {L.TEXT} END").alias(RAW),
    )
    if facts["free"] == 0:
        return plain
    free = _assemble(rows, index.where("free_form"), on_broken)
    return plain.unionByName(free) if facts["free"] < facts["blocks"] else free


def _assemble(rows: DataFrame, index: DataFrame, on_broken: str) -> DataFrame:
    """Objects in any layout, the lines between them included."""
    in_block = Window.partitionBy(L.FILE, L.BLOCK).orderBy(L.LINE_ID)
    in_file = Window.partitionBy(L.FILE).orderBy(L.BLOCK)
    earlier_blocks = in_file.rowsBetween(Window.unboundedPreceding, -1)
    earlier_lines = in_block.rowsBetween(Window.unboundedPreceding, -1)

    files = index.select(L.FILE, L.BLOCK, "first_id", "n", "lines_before")
    # 1. Nesting depth of every line, relative to its block.
    lines = (
        L.with_block_columns(rows.join(files.select(L.FILE, L.BLOCK), [L.FILE, L.BLOCK], "left_semi"), files)
        .withColumn("__change", F.expr(_depth_change(L.TEXT)))
        .withColumn("__depth", F.coalesce(F.sum("__change").over(earlier_lines), F.lit(0)))
        .withColumn("__file_start", L.line_number() == 0)
        .drop("first_id", "n", "lines_before")
    )
    lines = stage(lines, "depths")
    blocks = lines.groupBy(L.FILE, L.BLOCK).agg(F.sum("__change").alias("change"))
    blocks = stage(
        blocks.select(
            L.FILE,
            L.BLOCK,
            F.coalesce(F.sum("change").over(earlier_blocks), F.lit(0)).alias("depth_before"),
            F.sum("change").over(Window.partitionBy(L.FILE)).alias("end_depth"),
        ),
        "depth-blocks",
    )
    if on_broken == "fail":
        broken = blocks.where("end_depth <> 0").select(L.FILE).first()
        if broken is not None:
            raise ValueError(f"not valid JSON: {broken[0]}")

    # 2. A chunk is a run of lines holding whole elements: it starts where nothing is open.
    lines = (
        L.with_block_columns(lines, blocks)
        .withColumn("__start", (F.col("depth_before") + F.col("__depth") == 0) | F.col("__file_start"))
        .withColumn("__chunk", F.last(F.when(F.col("__start"), F.col(L.LINE_ID)), ignorenulls=True).over(in_block))
        .withColumn("__next", F.coalesce(F.lead("__start").over(in_block), F.lit(False)))
        .select(L.FILE, L.BLOCK, L.LINE_ID, L.TEXT, "__start", "__chunk", "__next")
    )
    lines = stage(lines, "chunks")
    tails = lines.groupBy(L.FILE, L.BLOCK).agg(F.max("__chunk").alias("tail"))
    tails = stage(
        tails.select(
            L.FILE,
            L.BLOCK,
            F.last(F.when(F.col("tail").isNotNull(), F.struct(F.col(L.BLOCK).alias("block"), "tail")), True)
            .over(earlier_blocks)
            .alias("open"),
        ),
        "chunk-blocks",
    )
    alone = F.col("__start") & F.col("__next")
    whole = lines.where(alone).select(L.FILE, L.BLOCK, F.col("__chunk"), F.col(L.TEXT).alias("body"))
    pieces = F.array_sort(F.collect_list(F.struct("__at", L.LINE_ID, L.TEXT)))
    grouped = (
        L.with_block_columns(lines.where(~alone), tails)
        .select(
            L.FILE,
            F.when(F.col("__chunk").isNull(), F.col("open.block")).otherwise(F.col(L.BLOCK)).alias("__home"),
            F.coalesce("__chunk", "open.tail").alias("__chunk"),
            F.col(L.BLOCK).alias("__at"),
            L.LINE_ID,
            L.TEXT,
        )
        .groupBy(L.FILE, F.col("__home").alias(L.BLOCK), "__chunk")
        .agg(F.array_join(F.transform(pieces, lambda p: p[L.TEXT]), "\n").alias("body"))
    )
    chunks = whole.unionByName(grouped)

    # 3. The elements of a chunk, in order; only objects are allowed.
    listed = F.regexp_replace(F.expr(trimmed("body")), _UP_TO_GLUED, "$1},{")
    elements = (
        chunks.withColumn("__listed", listed)
        .withColumn("__all", F.expr(values("__listed")))
        .select(L.FILE, L.BLOCK, "__chunk", F.posexplode_outer("__all").alias("__pos", "element"))
        .selectExpr(L.FILE, L.BLOCK, "__chunk", "__pos", f"if(left({trimmed('element')}, 1) = '{{', element, NULL) AS {RAW}")
    )
    elements = stage(elements, "elements")

    # 4. Numbers 1, 2, 3... per file.
    counts = elements.groupBy(L.FILE, L.BLOCK).agg(F.count("*").alias("n"))
    offsets = stage(
        counts.select(
            L.FILE,
            L.BLOCK,
            F.coalesce(F.sum("n").over(earlier_blocks), F.lit(0)).alias("lines_before"),
        ),
        "element-blocks",
    )
    place = F.row_number().over(Window.partitionBy(L.FILE, L.BLOCK).orderBy("__chunk", "__pos"))
    numbered = L.with_block_columns(elements.withColumn("__place", place), offsets)
    return numbered.select(L.FILE, (F.col("lines_before") + F.col("__place")).alias("record_number"), RAW)


def _parsed(fields: Sequence[Field], typed: bool) -> str:
    """The raw record as a struct; text members only, or lists and structs as such."""
    kinds = {LIST: "array<string>"} if typed else {}
    columns = [
        f"{name(f.name)} {f.ddl if typed and f.kind == STRUCT else kinds.get(f.kind, 'string')}" for f in fields
    ]
    schema = quoted(", ".join(columns + ["__corrupt string"]))
    strict = STRICT.removesuffix(")") + ", 'columnNameOfCorruptRecord', '__corrupt')"
    return f"from_json({RAW}, {schema}, {strict})"


def read_json(
    spark: SparkSession, paths: str | Sequence[str], fields: Sequence[str | Field], on_broken: str = "fail"
) -> DataFrame:
    """Records of JSON files: plain members as text, lists as lists, structs as structs of text.

    Result: ``record_number``, ``source_file``, ``parse_error`` (an element that
    is not an object), the fields, the element's text ``__raw`` and, only for
    elements with a list or struct of the wrong type, all members as text in
    ``__text``. Unknown members are ignored. A file that is not JSON fails the
    job; with ``on_broken="dead_letter"`` its unreadable parts become error rows.
    """
    if on_broken not in ("fail", "dead_letter"):
        raise ValueError("on_broken must be 'fail' or 'dead_letter'")
    fields = [Field(f) if isinstance(f, str) else f for f in fields]
    parsed = read_json_elements(spark, paths, on_broken).withColumn("__v", F.expr(_parsed(fields, typed=True)))
    parsed = parsed.withColumn(
        "__text", F.expr(f"if(__v.__corrupt IS NULL, NULL, {_parsed(fields, typed=False)})")
    )
    no_object = f"coalesce(left({trimmed(RAW)}, 1) <> '{{', true)"
    if on_broken == "fail":
        not_json = f"{RAW} IS NULL OR (__text.__corrupt IS NOT NULL AND NOT {no_object})"
        failure = f"cast(raise_error(concat('not valid JSON: ', {L.FILE})) AS boolean)"
        parsed = parsed.where(f"CASE WHEN {not_json} THEN {failure} ELSE true END")
    return parsed.selectExpr(
        "record_number",
        L.FILE,
        f"CASE WHEN __v IS NULL OR __text.__corrupt IS NOT NULL OR {no_object}"
        " THEN 'record has an invalid structure' END AS parse_error",
        *[f"__v.{name(f.name)} AS {name(f.name)}" for f in fields],
        RAW,
        "__text",
    )
