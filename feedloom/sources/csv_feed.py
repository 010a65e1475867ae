"""CSV feeds: header binding by name, ragged rows, record numbers.

Every file may order its columns differently or lack some. The header of each
file becomes a vector of positions, held in the block table, and each row picks
its cells through that vector: one scan whatever the mix of headers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.text import cell, has_control, is_blank, name, quoted, trimmed
from feedloom.sources import lines as L
from feedloom.sources.quoting import COMPLETE_CELL, assemble_quoted, ends_open


def cell_count(text: str) -> str:
    """Number of cells: separators outside quoted cells, plus one."""
    bare = f"if(instr({text}, '\"') = 0, {text}, regexp_replace({text}, {quoted(COMPLETE_CELL)}, ''))"
    return f"(octet_length({bare}) - octet_length(replace({bare}, ',', '')) + 1)"


def _cells(text: str, width: int) -> str:
    """The cells of a line; ``odd`` is not NULL when they are not ``width``."""
    schema = ", ".join(f"c{i} string" for i in range(width)) + ", odd string"
    options = f"map('escape', '\"', 'maxColumns', '{width + 20480}', 'columnNameOfCorruptRecord', 'odd')"
    return f"from_csv({text}, '{schema}', {options})"


def _as_array(struct: str, width: int) -> str:
    return "array(" + ", ".join(f"{struct}.c{i}" for i in range(width)) + ")"


def _has_cell(text: str, value: str) -> str:
    """Whether a line has a cell with just this value; few lines but headers have."""
    alone = rf'(?:\A|[,"])[\s\ufeff]*\Q{value}\E\s*(?:[,"]|\z)'
    return f"(contains({text}, {quoted(value)}) AND {text} RLIKE {quoted(alone)})"


def _bind_headers(index: DataFrame, columns: Sequence[str], width: int) -> DataFrame:
    """The block table with header width and, per wanted column, its position (last one wins)."""
    bound = index.selectExpr("*", f"{cell_count('first_line')} AS header_width", f"{_cells('first_line', width)} AS __h")
    bound = bound.withColumn(
        "__names",
        F.expr(f"transform(slice({_as_array('__h', width)}, 1, header_width), h -> ltrim('\\ufeff', {trimmed('h')}))"),
    )
    # Counted from the end; a column that is absent has no position.
    positions = ", ".join(
        f"if(array_contains(__names, {quoted(c)}), size(__names) - array_position(reverse(__names), {quoted(c)}), NULL)"
        for c in columns
    )
    nameless = f"if(exists(__names, h -> {is_blank('h')}), raise_error(concat('a header name is missing in ', {L.FILE})), {L.FILE})"
    return bound.selectExpr(
        f"{nameless} AS {L.FILE}",
        L.BLOCK,
        "first_id",
        "n",
        "lines_before",
        "header_width",
        f"cast(array({positions}) AS array<int>) AS positions",
    )


@dataclass(frozen=True)
class CsvScan:
    """The records of CSV files as text, and what the counting pass learned about them."""

    rows: DataFrame
    index: DataFrame
    width: int
    records: int


def open_csv(
    spark: SparkSession, paths: str | Sequence[str], column: str | None = None, multi_line: bool | None = None
) -> CsvScan:
    """Count and index the files; ``column`` is a name their headers should contain, if one is known."""
    rows = L.read_lines(spark, paths)
    marker = F.lit(False) if column is None else F.expr(_has_cell(L.TEXT, column))
    opens = "0L" if multi_line is False else f"cast({ends_open(L.TEXT)} AS bigint)"
    index = L.block_index(rows, marker, open_lines=F.expr(opens))
    learned = [
        F.expr(f"max({cell_count('first_line')})").alias("width"),
        F.expr("coalesce(sum(n), 0) - count(DISTINCT source_file)").alias("records"),
    ]
    unknown = F.count_if(F.col("first_line").isNull()).alias("unknown")
    facts = index.agg(*learned, F.sum("open_lines").alias("open_lines"), unknown).first()
    if (facts["open_lines"] or 0) > 0:
        rows, index = assemble_quoted(L.read_lines(spark, paths, keep=F.lit(True), line_end="\n"))
        facts = index.agg(*learned).first()
    elif facts["unknown"] > 0:
        index = L.with_all_first_lines(rows, index)
        facts = index.agg(*learned).first()
    return CsvScan(rows, index, facts["width"] or 1, facts["records"])


def read_csv(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], multi_line: bool | None = None
) -> DataFrame:
    """Records of CSV files with a header, every cell as trimmed text or NULL.

    Result: ``record_number`` (1, 2, 3... per file, good and bad rows alike),
    ``source_file``, ``parse_error`` (a row whose cells do not match its header)
    and ``columns``; absent ones are NULL, others are ignored.

    Quoted cells may hold line breaks. By default the counting pass finds out
    whether any do; ``multi_line=False`` skips that check.
    """
    return scanned(open_csv(spark, paths, columns[0], multi_line), columns)


def scanned(scan: CsvScan, columns: Sequence[str], clean: bool = True) -> DataFrame:
    """The records of an opened scan, see ``read_csv``; ``clean=False`` leaves the cells untrimmed."""
    width = scan.width
    numbered = L.with_block_columns(scan.rows, _bind_headers(scan.index, columns, width))
    parsed = numbered.withColumn("record_number", L.line_number()).where("record_number > 0").selectExpr(
        "record_number",
        L.FILE,
        "positions",
        "header_width",
        L.TEXT,
        f"{_cells(L.TEXT, width)} AS __row",
    )
    # The parser tells rows of the usual width from others; only the others are counted.
    count = cell_count(L.TEXT)
    ragged = f"format_string('row has %d column(s) but the header has %d', {count}, header_width)"
    suspect = f"__row.odd IS NOT NULL OR header_width <> {width}"
    checked = parsed.selectExpr(
        "record_number",
        L.FILE,
        f"CASE WHEN {suspect} THEN if({count} <> header_width, {ragged}, NULL) END AS parse_error",
        "positions",
        f"{_as_array('__row', width)} AS __cells",
        f"{has_control(L.TEXT)} AS __control",
    )
    picked = checked.selectExpr(
        "record_number",
        L.FILE,
        "parse_error",
        "__control",
        *[f"if(parse_error IS NULL, get(__cells, positions[{i}]), NULL) AS {name(c)}" for i, c in enumerate(columns)],
    )
    if not clean:
        return picked.drop("__control")
    return picked.selectExpr(
        "record_number", L.FILE, "parse_error", *[f"{cell(name(c), '__control')} AS {name(c)}" for c in columns]
    )


def header_names(scan: CsvScan) -> list[str]:
    """Column names of a scan's files, in the order they first appear; none for empty files."""
    cells = scan.index.select("first_line").distinct().selectExpr(f"{_cells('first_line', scan.width)} AS __h")
    named = cells.selectExpr(f"posexplode({_as_array('__h', scan.width)}) AS (place, name)")
    named = named.where("name IS NOT NULL").selectExpr("place", f"{trimmed('name')} AS name")
    return [r[0] for r in named.groupBy("name").agg(F.min("place").alias("place")).orderBy("place", "name").collect()]
