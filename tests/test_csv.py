"""CSV reading: headers, numbering, ragged rows, clean-up."""

from __future__ import annotations

import pytest
from fixtures import VALID, csv_text, variation, write
from pyspark.sql import functions as F

from feedloom.plans.employee import EMPLOYEE
from feedloom.sources.csv_feed import header_names, open_csv, read_csv
from feedloom.sources.reader import read_feed


def test_reads_all_fields(spark, tmp_path):
    row = read_feed(spark, write(tmp_path / "a.csv", csv_text([VALID])), EMPLOYEE, "csv").first()
    assert (row["record_number"], row["parse_error"], row["salary"], row["is_active"]) == (1, None, 72000, True)
    assert row["skills"] == ["Routing", "SQL"] and row["address"]["street"] == "4, Harbour Lane"
    assert row["emergency_contact"]["phone"] == "5550002222" and row["source_file"].endswith("/a.csv")
    assert row["source_creation_time"] is not None


@pytest.mark.parametrize(
    ("changes", "error"),
    [
        ({"salary": "abc"}, "salary must be a whole number"),
        ({"salary": "1.5"}, "salary must be a whole number"),
        ({"salary": "99999999999999999999"}, "salary must be a whole number"),
        ({"is_active": "yes"}, "is_active must be true or false"),
        ({"salary": "abc", "is_active": "yes"}, "salary must be a whole number"),
        ({"salary": "+7", "is_active": "FALSE"}, None),
        ({"salary": "", "is_active": " "}, None),
    ],
)
def test_conversion_errors(spark, tmp_path, changes, error):
    row = read_feed(spark, write(tmp_path / "a.csv", csv_text([variation(1, **changes)])), EMPLOYEE, "CSV").first()
    assert row["parse_error"] == error
    if error:
        assert row["employee_id"] is None and row["address"] is None


def test_cells_are_trimmed_and_blank_is_null(spark, tmp_path):
    rows = [variation(1, last_name="", skills=" Java ; ;SQL ", department="\t Sea \x01", job_title="  ", first_name=" a")]
    row = read_feed(spark, write(tmp_path / "a.csv", csv_text(rows)), EMPLOYEE, "CSV").first()
    assert row["last_name"] is None and row["job_title"] is None
    assert row["skills"] == ["Java", "SQL"] and row["department"] == "Sea" and row["first_name"] == " a"


def test_ragged_rows_are_numbered_and_reported(spark, tmp_path):
    source = write(tmp_path / "a.csv", "﻿id,name\n1,a\n\n2\n   \n3,x,y\n4,\"b,\"\"c\"\n")
    df = read_csv(spark, source, ["id", "name"])
    expected = [
        (1, None), (2, "row has 1 column(s) but the header has 2"), (3, "row has 1 column(s) but the header has 2"),
        (4, "row has 3 column(s) but the header has 2"), (5, None),
    ]
    assert [tuple(r) for r in df.select("record_number", "parse_error").orderBy("record_number").collect()] == expected
    good = df.where("parse_error IS NULL").orderBy("record_number").collect()
    assert [(r["id"], r["name"]) for r in good] == [("1", "a"), ("4", 'b,"c')]
    assert df.count() == 5


def test_three_cells_under_the_full_header(spark, tmp_path):
    source = write(tmp_path / "a.csv", csv_text([]) + "EMP0001,a,b\n")
    assert read_feed(spark, source, EMPLOYEE, "CSV").first()["parse_error"] == "row has 3 column(s) but the header has 23"


def test_files_with_different_headers(spark, tmp_path):
    one = write(tmp_path / "1.csv", "name, id ,extra\nann,1,x\n")
    two = write(tmp_path / "2.csv", "id\n2\n")
    three = write(tmp_path / "3.csv", "id,name,id\n0,cy,3\n")
    rows = read_csv(spark, [one, two, three], ["id", "name"]).orderBy("id").collect()
    assert [(r["id"], r["name"], r["record_number"]) for r in rows] == [("1", "ann", 1), ("2", None, 1), ("3", "cy", 1)]


def test_header_without_the_expected_names(spark, tmp_path):
    source = write(tmp_path / "a.csv", "\n\nkey,label\n1,a\n2\n")
    rows = read_csv(spark, source, ["id", "name"]).orderBy("record_number").collect()
    assert [(r["id"], r["parse_error"]) for r in rows] == [
        (None, None), (None, "row has 1 column(s) but the header has 2"),
    ]
    assert header_names(open_csv(spark, source)) == ["key", "label"]


def test_header_names_in_the_data_do_no_harm(spark, tmp_path):
    source = write(tmp_path / "a.csv", "id,name\nid,name\nid,name\n")
    rows = read_csv(spark, source, ["id", "name"]).orderBy("record_number").collect()
    assert [(r["record_number"], r["id"], r["name"]) for r in rows] == [(1, "id", "name"), (2, "id", "name")]


def test_nameless_header_column_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="header name is missing"):
        read_csv(spark, write(tmp_path / "a.csv", "id,,name\n1,2,3\n"), ["id"]).collect()


def test_empty_and_header_only_files(spark, tmp_path):
    write(tmp_path / "a.csv", "")
    write(tmp_path / "b.csv", "id,name\n")
    assert read_csv(spark, str(tmp_path), ["id", "name"]).count() == 0


def test_numbers_do_not_depend_on_blocks(small_blocks, tmp_path):
    for f in range(3):
        text = "id,f\n" + "".join(f"{n},{f}\n" + ("\n" if n % 7 == 0 else "") for n in range(1, 500 + 100 * f))
        write(tmp_path / f"{f}.csv", text)
    df = read_csv(small_blocks, str(tmp_path / "*.csv"), ["id", "f"])
    wrong = df.where(F.col("id").cast("bigint") != F.col("record_number"))
    assert wrong.count() == 0
    assert {r["f"]: r["count"] for r in df.groupBy("f").count().collect()} == {"0": 499, "1": 599, "2": 699}


@pytest.mark.parametrize("kind", ["csv", "json"])
def test_a_feed_that_is_cut_otherwise_loses_no_line_silently(spark, tmp_path, kind):
    """Built under one split size and run under another: all rows, or an error."""
    from feedloom.sources.json_feed import read_json_elements

    for f in range(3):
        lines = [f'{{"id": {n}, "text": "abcdefghij"}}' if kind == "json" else f"{n},abcdefghij" for n in range(60)]
        write(tmp_path / f"{f}.{kind}", "\n".join(lines if kind == "json" else ["id,text", *lines]) + "\n")
    source, setting = str(tmp_path / f"*.{kind}"), "spark.sql.files.maxPartitionBytes"
    read = (lambda: read_json_elements(spark, source)) if kind == "json" else (lambda: read_csv(spark, source, ["id", "text"]))
    usual = {k: spark.conf.get(k) for k in (setting, "spark.sql.files.openCostInBytes")}
    failed = 0
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        for built, run in ((200, 300), (300, 200), (97, 1000), (5000, 130), (200, 200)):
            spark.conf.set(setting, str(built))
            rows = read()
            plan = rows._jdf.queryExecution().optimizedPlan().toString()
            assert "Join LeftOuter" in plan and "Join Inner" not in plan
            spark.conf.set(setting, str(run))
            try:
                found = rows.select("source_file", "record_number").collect()
            except Exception as error:
                assert "the feed changed while it was read" in str(error)
                failed += 1
            else:
                assert sorted(r["record_number"] for r in found) == sorted(list(range(1, 61)) * 3)
    finally:
        for k, v in usual.items():
            spark.conf.set(k, v)
    assert 0 < failed < 5
