"""Encryption, decryption, redaction."""

from __future__ import annotations

import json

import pytest
from fixtures import KEY, json_record
from test_rules import records

from feedloom.functions.protect import (
    check_key, decrypt_failed, decrypt_if_present, decrypted, encrypt_columns, encrypt_numbered,
)
from feedloom.functions.records import redacted_record
from feedloom.operators.prepare import encrypt_sensitive, fill_missing, target_columns
from feedloom.plans.employee import EMPLOYEE
from feedloom.session import stage


def test_round_trip_fresh_ivs_and_form(spark):
    df = spark.range(200).selectExpr("id", "if(id = 199, repeat('é', 300), '72000') AS plain")
    sealed = stage(encrypt_columns(df, {"a": "plain", "b": "plain"}, KEY), "t")
    assert sealed.selectExpr("count(DISTINCT a) + count(DISTINCT b)").first()[0] == 400
    assert sealed.where(r"a RLIKE r'\Av1:[A-Za-z0-9+/]{16}:[A-Za-z0-9+/]+=*\z'").count() == 200
    assert sealed.where(decrypted("a", KEY) != sealed["plain"]).count() == 0
    assert sealed.where(decrypt_if_present("b", KEY, strict=True) == sealed["plain"]).count() == 200
    # Also without storing in between: the IV is drawn once per row.
    assert encrypt_columns(df, {"a": "plain"}, KEY).where(decrypted("a", KEY) == df["plain"]).count() == 200


def test_numbered_encryption(spark):
    """Keys and IVs follow from the place: none is used twice, and tampering with the place shows."""
    df = spark.range(300).selectExpr("concat('f', id % 3) AS source_file", "id DIV 3 AS record_number", "concat('same', '') AS p")
    sealed = stage(encrypt_numbered(df, {"a": "p", "b": "p"}, KEY), "numbered")
    pairs = sealed.selectExpr("explode(array(a, b)) AS v").selectExpr("v", r"regexp_extract(v, '^v2:([^:]*:[^:]*):', 1) AS pair")
    assert pairs.selectExpr("count(DISTINCT pair)", "count(DISTINCT v)").first() == (600, 600)
    assert sealed.where((decrypted("a", KEY) == "same") & (decrypted("b", KEY) == "same")).count() == 300
    assert sealed.where(decrypted("a", "k" * 32).isNotNull()).count() == 0
    other = sealed.selectExpr("concat(left(a, 28), substr(lead(a) OVER (ORDER BY source_file, record_number), 29)) AS moved", "a")
    other = other.selectExpr("if(substr(a, 4, 24) = substr(moved, 4, 24), concat('v2:', substr(moved, 4, 24), substr(moved, 28, 17), substr(a, 45)), a) AS x", "a", "moved")
    assert other.where(decrypt_failed("x", KEY)).count() == other.where("x <> a").count() > 200
    twice = encrypt_numbered(df, {"a": "p"}, KEY)
    assert sorted(map(str, twice.collect())) == sorted(map(str, twice.collect()))  # a repeated task writes the same
    blank = encrypt_numbered(spark.createDataFrame([("f", 1, " "), (None, 2, None)], "source_file string, record_number int, p string"), {"a": "p"}, KEY)
    assert [r["a"] for r in blank.collect()] == [None, None]
    with pytest.raises(Exception, match="a record without record_number"):
        encrypt_numbered(spark.createDataFrame([("f", None, "x")], "source_file string, record_number int, p string"), {"a": "p"}, KEY).collect()


def test_blank_values_are_not_encrypted(spark):
    df = spark.createDataFrame([(None,), ("",), (" \t",), ("x",)], "p string")
    assert [r[0] is None for r in encrypt_columns(df, {"a": "p"}, KEY).select("a").collect()] == [True, True, True, False]


def test_bad_values_do_not_decrypt(spark):
    df = encrypt_columns(spark.createDataFrame([("secret",)], "p string"), {"s": "p"}, KEY)
    good = stage(df, "t").first()["s"]
    version, iv, body = good.split(":")
    flipped = body[:4] + ("A" if body[4] != "A" else "B") + body[5:]
    values = [
        good, f"v2:{iv}:{body}", f"{version}:{iv}:{flipped}", "plain", f"{good}:x", f"v1:{iv}:*{body}", f"v1:AAAA:{body}",
        "", " ", None,
    ]
    rows = spark.createDataFrame([(v,) for v in values], "s string")
    got = rows.select(decrypt_if_present("s", KEY), decrypt_failed("s", KEY)).collect()
    assert [r[0] for r in got] == ["secret", *[None] * 6, "", " ", None]
    assert [r[1] for r in got] == [False, *[True] * 6, False, False, False]
    assert rows.limit(1).select(decrypted("s", KEY[::-1])).first()[0] is None
    with pytest.raises(Exception, match="could not be decrypted"):
        rows.select(decrypt_if_present("s", KEY, strict=True)).collect()


def test_key_must_have_32_bytes(spark):
    for bad in (None, "", "  ", "short", "é" * 32):
        with pytest.raises(ValueError, match="Encryption key must"):
            check_key(bad)
    assert len(check_key("é" * 16)) == 32


def test_key_is_not_shown_in_plans(spark, capsys):
    df = encrypt_columns(spark.range(3).selectExpr("cast(id AS string) AS p"), {"s": "p"}, KEY)
    df.select("s", decrypted("s", KEY)).explain(True)
    shown = capsys.readouterr().out
    assert KEY not in shown and KEY.encode().hex().upper() not in shown.upper()


def test_redaction_hides_only_values_that_are_there(spark):
    df = records(spark, [{}, {"salary": None, "emergency_contact": None, "last_name": None}])
    shown = [json.loads(r[0]) for r in df.orderBy("n").selectExpr(redacted_record(EMPLOYEE)).collect()]
    assert shown[0]["phone_number"] == shown[0]["salary"] == shown[0]["emergency_contact"]["phone"] == "[REDACTED]"
    assert shown[0]["emergency_contact"]["name"] == "Jon Solberg" and shown[0]["skills"] == ["Routing", "SQL"]
    assert shown[1]["salary"] is None and shown[1]["emergency_contact"] is None and shown[1]["last_name"] is None


def test_filling_and_stored_form(spark):
    changes = {
        "last_name": None, "department": "", "job_title": "  ", "salary": None, "skills": None, "address": None,
        "emergency_contact": {"name": "", "phone": None},
    }
    filled = fill_missing(records(spark, [changes]), EMPLOYEE)
    row = filled.first()
    assert (row["last_name"], row["department"], row["job_title"], row["salary"], row["skills"]) == (" ", " ", "  ", None, [])
    assert set(row["address"]) == {" "} and set(row["emergency_contact"]) == {" "}
    stored = encrypt_sensitive(filled, EMPLOYEE, KEY).selectExpr(*target_columns(EMPLOYEE)).first().asDict()
    assert stored["salary_encrypted"] is None and stored["phone_number_encrypted"].startswith("v1:")
    assert json.loads(stored["emergency_contact"]) == {"name": " ", "relationship": " ", "phone": None, "email": " "}
    assert stored["skills"] == "[]" and stored["hire_date"].isoformat() == json_record()["hire_date"]
    assert list(stored) == [f"{f.name}_encrypted" if f.sensitive else f.name for f in EMPLOYEE.fields]
