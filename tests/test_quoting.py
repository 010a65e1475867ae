"""Quoted cells that span lines, against a character-by-character reader."""

from __future__ import annotations

import csv
import io
import random

import pytest
from fixtures import write
from pyspark.sql import functions as F

from feedloom.sources.csv_feed import cell_count, read_csv
from feedloom.sources.quoting import _ends_open_from_inside, ends_open


def walk(line: str, inside: bool = False) -> tuple[bool, int]:
    """Whether a line ends inside quotes, and its number of cells."""
    cells, at_start, i = 1, not inside, 0
    while i < len(line):
        c = line[i]
        if inside:
            if c == '"':
                if line[i + 1 : i + 2] == '"':
                    i += 1
                else:
                    inside = False
            at_start = False
        elif c == '"' and at_start:
            inside, at_start = True, False
        elif c == ",":
            cells, at_start = cells + 1, True
        else:
            at_start = False
        i += 1
    return inside, cells


@pytest.fixture(scope="module")
def lines():
    rng = random.Random(7)
    return ["".join(rng.choice('a,""b ,"') for _ in range(rng.randint(0, 14))) for _ in range(4000)]


def test_open_state_from_outside(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "t string")
    for row in df.selectExpr("t", f"{ends_open('t')} AS open").collect():
        assert row["open"] == walk(row["t"])[0], row["t"]


def test_open_state_from_inside(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "t string")
    for row in df.selectExpr("t", f"{_ends_open_from_inside('t')} AS open").collect():
        assert row["open"] == walk(row["t"], inside=True)[0], row["t"]


def test_cell_count_of_complete_lines(spark, lines):
    complete = [x for x in lines if not walk(x)[0]]
    df = spark.createDataFrame([(x,) for x in complete], "t string")
    for row in df.selectExpr("t", f"{cell_count('t')} AS n").collect():
        assert row["n"] == walk(row["t"])[1], row["t"]


def test_multi_line_cells_in_small_blocks(small_blocks, tmp_path):
    """Random cells with line breaks, quotes and separators come back whole and in order."""
    rng = random.Random(11)
    pieces = ["a", "bc", " d", ",", '"', '""', "\n", "\n\n", "é", "x,y"]
    rows = [
        [str(n)] + ["z" + "".join(rng.choice(pieces) for _ in range(rng.randint(0, 9))) + "z" for _ in range(2)]
        for n in range(1, 301)
    ]
    buffer = io.StringIO()
    writer = csv.writer(buffer, lineterminator="\n")
    writer.writerow(["id", "one", "two"])
    writer.writerows(rows)
    source = write(tmp_path / "m.csv", buffer.getvalue())
    assert small_blocks.read.text(source).select(F.col("_metadata.file_block_start")).distinct().count() > 10
    got = read_csv(small_blocks, source, ["id", "one", "two"]).orderBy("record_number").collect()
    assert [(r["record_number"], r["parse_error"], r["id"], r["one"], r["two"]) for r in got] == [
        (n, None, *row) for n, row in enumerate(rows, 1)
    ]


def test_crlf_files_keep_breaks_inside_quotes(spark, tmp_path):
    source = write(tmp_path / "w.csv", 'id,note\r\n1,"a\r\nb"\r\n\r\n2,c\r\n')
    rows = read_csv(spark, source, ["id", "note"]).orderBy("record_number").collect()
    assert [(r["id"], r["note"]) for r in rows] == [("1", "a\r\nb"), ("2", "c")]


def test_unclosed_quote_fails_the_file(spark, tmp_path):
    source = write(tmp_path / "u.csv", 'id,note\n1,"a\n2,b\n')
    with pytest.raises(ValueError, match="not closed"):
        read_csv(spark, source, ["id", "note"])
