"""Validation rules: one case per rule, exact messages."""

from __future__ import annotations

from fixtures import json_record

from feedloom.functions import rules as R
from feedloom.functions.text import cell, is_blank, is_uuid, to_boolean, to_long, utf16_length
from feedloom.operators.route import check_constraints, validate
from feedloom.plans.employee import EMPLOYEE
from feedloom.schema import Feed, Field

SCHEMA = ", ".join(f"`{f.name}` {f.ddl}" for f in EMPLOYEE.fields)

CASES = [
    ({}, None),
    ({"employee_id": "EMP1"}, "employee_id must be exactly 7 characters (found 4)"),
    ({"employee_id": None}, "employee_id is required"),
    ({"first_name": "Al"}, "first_name must be between 3 and 15 characters (found 2)"),
    ({"first_name": " \t "}, "first_name is required"),
    ({"first_name": "\u2003\u2003\u2003"}, "first_name is required"),
    ({"last_name": None}, None),
    ({"last_name": "x" * 16}, "last_name must be between 0 and 15 characters (found 16)"),
    ({"email": "a@b.io"}, "email must be between 13 and 30 characters (found 6)"),
    ({"email": "mira.solberg.example.com"}, "email has an invalid format"),
    ({"email": "mira.solberg@example.com\n"}, "email has an invalid format"),
    ({"email": "mira@example.c"}, "email has an invalid format"),
    ({"phone_number": "123"}, "phone_number must be exactly 10 characters (found 3)"),
    ({"hire_date": "2022-02-30"}, "hire_date must be a real date in yyyy-MM-dd format"),
    ({"hire_date": "30-02-2022"}, "hire_date must be a real date in yyyy-MM-dd format"),
    (
        {"hire_date": "2022-2-3"},
        "hire_date must be exactly 10 characters (found 8); hire_date must be a real date in yyyy-MM-dd format",
    ),
    ({"hire_date": "2024-02-29"}, None),
    ({"department": "d" * 21}, "department must be between 0 and 20 characters (found 21)"),
    ({"job_title": "j" * 31}, "job_title must be between 0 and 30 characters (found 31)"),
    ({"job_title": "j" * 29 + "😀"}, "job_title must be between 0 and 30 characters (found 31)"),
    ({"job_title": "é" * 30}, None),
    ({"currency": "eur"}, "currency must be a 3-letter uppercase ISO code such as INR or USD"),
    ({"employment_status": "PT"}, "employment_status must be between 3 and 13 characters (found 2)"),
    ({"salary": -1}, "salary must not be negative"),
    ({"salary": 0}, None),
    ({"salary": None}, None),
    ({"skills": ["Kubernetes"] * 20}, "skills must not exceed 100 characters in total"),
    ({"skills": None}, None),
    (
        {"employee_id": " ", "manager_id": "", "is_active": None},
        "employee_id is required; manager_id is required; is_active is required (true or false)",
    ),
]


def records(spark, changes):
    rows = [json_record(n, **c) for n, c in enumerate(changes, 1)]
    for n, row in enumerate(rows):
        row["n"] = n
    return spark.createDataFrame(rows, SCHEMA + ", n int")


def test_every_rule_and_message(spark):
    checked = validate(records(spark, [c for c, _ in CASES]), EMPLOYEE).orderBy("n").collect()
    for row, (changes, message) in zip(checked, CASES, strict=True):
        assert row["error_message"] == message, changes
        assert row["error_type"] == ("VALIDATION_ERROR" if message else None)


def test_error_list_keeps_rule_order(spark):
    df = records(spark, [{"employee_id": None, "salary": -5, "currency": "x"}])
    assert df.selectExpr(R.errors_of(EMPLOYEE.rules)).first()[0] == [
        "employee_id is required",
        "currency must be exactly 3 characters (found 1)",
        "currency must be a 3-letter uppercase ISO code such as INR or USD",
        "salary must not be negative",
    ]


def test_constraints_of_any_table(spark):
    feed = Feed(
        "runs",
        "id",
        (Field("id"), Field("state"), Field("note")),
        (R.Required("state"),),
        (R.NotNull("id"), R.MaxLength("note", 3), R.OneOf("state", ("A", "it's")), R.NoNul("note")),
    )
    rows = [("1", "A", "abc"), (None, "A", "a"), ("3", "A", "abcd"), ("4", "B", None), ("5", "it's", "a\x00"), ("6", "", "abcdef")]
    df = check_constraints(validate(spark.createDataFrame(rows, "id string, state string, note string"), feed), feed)
    assert [(r["error_type"], r["error_message"]) for r in df.collect()] == [
        (None, None),
        ("LOAD_ERROR", 'null value in column "id" violates not-null constraint'),
        ("LOAD_ERROR", 'value too long for column "note" of type character varying(3)'),
        ("LOAD_ERROR", 'value of column "state" violates check constraint'),
        ("LOAD_ERROR", 'invalid byte sequence in column "note": 0x00'),
        ("VALIDATION_ERROR", "state is required"),
    ]


def test_long_rejected_text_is_a_load_error(spark):
    df = records(spark, [{"first_name": "f" * 32}, {}]).selectExpr("*", "cast(NULL AS string) error_type", "'' error_message")
    kinds = [r["error_type"] for r in check_constraints(df, EMPLOYEE).orderBy("n").collect()]
    assert kinds == ["LOAD_ERROR", None]


def test_text_helpers(spark):
    rows = [("+7",), ("-12",), ("1e3",), ("7L",), (" 5",), ("9223372036854775808",), ("TRUE",), ("t",), (None,), ("",), ("a😀",), ("\x7f",)]
    df = spark.createDataFrame(rows, "t string")
    got = df.selectExpr(to_long("t"), to_boolean("t"), is_blank("t"), utf16_length("t"), cell("t")).collect()
    assert [r[0] for r in got] == [7, -12, *[None] * 10]
    assert [r[1] for r in got] == [*[None] * 6, True, *[None] * 5]
    assert [r[2] for r in got] == [False] * 8 + [True, True, False, False]
    assert got[10][3] == 3 and got[4][4] == "5" and got[9][4] is None
    ids = spark.sql(f"SELECT {is_uuid('uuid()')}, {is_uuid(chr(39) + 'run-1' + chr(39))}, {is_uuid('cast(NULL AS string)')}")
    assert tuple(ids.first()) == (True, False, False)


def test_row_level_sql_states(spark):
    df = spark.createDataFrame([("22001",), ("23505",), ("08006",), (None,)], "s string")
    assert [r[0] for r in df.selectExpr(R.is_row_level("s")).collect()] == [True, True, False, False]
