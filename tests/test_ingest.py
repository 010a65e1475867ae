"""The whole job: success, mismatch, crash, re-run."""

from __future__ import annotations

import json

import pytest
from fixtures import KEY, csv_text, json_lines, json_record, variation, write

from feedloom.operators.ledger import Ledger
from feedloom.operators.lookup import decrypted_view, find
from feedloom.operators.merge import TargetTable
from feedloom.plans.employee import EMPLOYEE
from feedloom.plans.ingest import (
    RecordCountMismatch, Warehouse, errors, files, ingest, new_execution_id, status, target_schema,
)


def control(tmp_path, n):
    return write(tmp_path / f"count{n}.properties", f"record_count={n}\n")


def faulty_rows():
    rows = [variation(i) for i in range(1, 21)]
    rows[2]["phone_number"] = "+47-55500-01111"
    rows[6]["first_name"] = "Al"
    rows[11]["salary"] = "lots"
    rows[15]["email"] = ""
    return rows


@pytest.mark.parametrize("kind", ["CSV", "json"])
def test_clean_feed_succeeds(spark, tmp_path, kind):
    if kind == "CSV":
        source = write(tmp_path / "people.csv", csv_text([variation(i) for i in range(1, 21)]))
    else:
        source = write(tmp_path / "people.json", json.dumps([json_record(i) for i in range(1, 21)], indent=2))
    house = Warehouse(str(tmp_path / "house"))
    result = ingest(spark, EMPLOYEE, source, kind, control(tmp_path, 20), house, KEY)
    assert result["records_loaded"] == 20 and result["records_parsed"] == 20
    row = status(spark, house, result["execution_id"]).first()
    assert (row["status"], row["expected_record_count"], row["actual_loaded_record_count"], row["error_count"]) == (
        "SUCCESS", 20, 20, 0,
    )
    table = TargetTable(spark, house.table, target_schema(EMPLOYEE), EMPLOYEE.key).read()
    stored = find(table, "employee_id", "EMP0007").first()
    assert stored["phone_number_encrypted"].startswith("v1:") and "phone_number" not in stored.asDict()
    assert json.loads(stored["emergency_contact"])["phone"].startswith("v1:")
    plain = decrypted_view(find(table, "employee_id", "EMP0007"), EMPLOYEE, KEY).first()
    assert (plain["phone_number"], plain["salary"]) == ("5550001111", 72000)
    assert plain["emergency_contact"]["phone"] == "5550002222"
    assert plain["skills"] == ["Routing", "SQL"] and plain["address"]["street"] == "4, Harbour Lane"


def test_faulty_feed_loads_the_good_rows_and_fails(spark, tmp_path):
    source = write(tmp_path / "people.csv", csv_text(faulty_rows()))
    house, run = Warehouse(str(tmp_path / "house")), new_execution_id()
    with pytest.raises(RecordCountMismatch, match="expected 20 record.s. but 16 record.s. were loaded"):
        ingest(spark, EMPLOYEE, source, "CSV", control(tmp_path, 20), house, KEY, run)
    row = status(spark, house, run).first()
    assert (row["status"], row["actual_loaded_record_count"], row["error_count"]) == ("FAILED", 16, 4)
    assert row["failure_reason"].startswith("Record count mismatch")
    found = {r["record_number"]: r for r in errors(spark, house).collect()}
    assert {n: (r["error_type"], r["error_message"]) for n, r in found.items()} == {
        3: ("VALIDATION_ERROR", "phone_number must be exactly 10 characters (found 15)"),
        7: ("VALIDATION_ERROR", "first_name must be between 3 and 15 characters (found 2)"),
        12: ("PARSE_ERROR", "salary must be a whole number"),
        16: ("VALIDATION_ERROR", "email is required"),
    }
    assert found[12]["raw_record"] is None
    shown = json.loads(found[3]["raw_record"])
    assert shown["phone_number"] == shown["salary"] == shown["emergency_contact"]["phone"] == "[REDACTED]"
    assert shown["address"]["city"] == "Bergen"
    report = spark.read.text(house.report(run)).orderBy("value").collect()
    assert len(report) == 4 and all(f"execution_id={run}" in r[0] for r in report)
    assert TargetTable(spark, house.table, target_schema(EMPLOYEE), EMPLOYEE.key).read().count() == 16


def test_duplicates_count_as_loaded_and_the_last_one_stays(spark, tmp_path):
    rows = [variation(1), variation(2), variation(1, department="Harbour")]
    source = write(tmp_path / "people.csv", csv_text(rows))
    house = Warehouse(str(tmp_path / "house"))
    for _ in range(2):
        assert ingest(spark, EMPLOYEE, source, "CSV", control(tmp_path, 3), house, KEY)["records_loaded"] == 3
        table = TargetTable(spark, house.table, target_schema(EMPLOYEE), EMPLOYEE.key).read()
        assert {r["employee_id"]: r["department"] for r in table.collect()} == {"EMP0001": "Harbour", "EMP0002": "Logistics"}


def test_unreadable_control_file_stores_failed_only(spark, tmp_path):
    house, run = Warehouse(str(tmp_path / "house")), new_execution_id()
    bad = write(tmp_path / "c.properties", "record_count=ten\n")
    with pytest.raises(ValueError, match="whole number"):
        ingest(spark, EMPLOYEE, str(tmp_path / "none.csv"), "CSV", bad, house, KEY, run)
    events = Ledger(spark, house.runs).events().collect()
    assert [(e["status"], e["expected_record_count"], e["actual_loaded_record_count"]) for e in events] == [
        ("FAILED", None, None)
    ]


def test_broken_file_fails_the_run(spark, tmp_path):
    source = write(tmp_path / "people.json", json_lines([json_record(1)]) + '{"employee_id": \n')
    house, run = Warehouse(str(tmp_path / "house")), new_execution_id()
    with pytest.raises(Exception, match="not valid JSON"):
        ingest(spark, EMPLOYEE, source, "JSON", control(tmp_path, 1), house, KEY, run)
    row = status(spark, house, run).first()
    assert row["status"] == "FAILED" and "not valid JSON" in row["failure_reason"]


def test_missing_source_marks_the_run_failed(spark, tmp_path):
    house, run = Warehouse(str(tmp_path / "house")), new_execution_id()
    with pytest.raises(Exception):
        ingest(spark, EMPLOYEE, str(tmp_path / "none.csv"), "CSV", control(tmp_path, 1), house, KEY, run)
    assert status(spark, house, run).first()["status"] == "FAILED"


def test_header_only_feed_of_zero_records_succeeds(spark, tmp_path):
    source = write(tmp_path / "people.csv", csv_text([]))
    house = Warehouse(str(tmp_path / "house"))
    result = ingest(spark, EMPLOYEE, source, "CSV", control(tmp_path, 0), house, KEY)
    assert result["records_loaded"] == 0
    assert status(spark, house).first()["status"] == "SUCCESS"


def test_bad_key_or_run_id_is_refused_before_anything_is_written(spark, tmp_path):
    house = Warehouse(str(tmp_path / "house"))
    with pytest.raises(ValueError, match="32 bytes"):
        ingest(spark, EMPLOYEE, "x", "CSV", "y", house, "short")
    with pytest.raises(ValueError, match="UUID"):
        ingest(spark, EMPLOYEE, "x", "CSV", "y", house, KEY, "run-1")
    assert not (tmp_path / "house").exists()


def test_counts_of_every_file(spark, tmp_path):
    """A manifest finds what the sum hides: one file too few, another too many, one missing, one nobody named."""
    for name, rows in (("a", range(1, 6)), ("b", range(6, 9)), ("c", range(9, 11))):
        write(tmp_path / f"{name}.csv", csv_text([variation(i) for i in rows]))
    house, run = Warehouse(str(tmp_path / "house")), new_execution_id()
    named = [(f"file://{tmp_path}/a.csv", 4), (str(tmp_path / "b.csv"), 4), (str(tmp_path / "lost.csv"), 0)]
    manifest = spark.createDataFrame(named, "source_file string, expected int")
    with pytest.raises(RecordCountMismatch, match="a.csv: Record count mismatch"):
        ingest(spark, EMPLOYEE, str(tmp_path / "*.csv"), "CSV", control(tmp_path, 10), house, KEY, run, manifest=manifest)
    found = {r["source_file"].rsplit("/", 1)[1]: (r["expected"], r["actual"], r["matched"], r["problem"]) for r in files(spark, house).collect()}
    assert found["lost.csv"] == (0, 0, True, None) and found["c.csv"] == (None, 2, False, "not named in the manifest")
    assert found["a.csv"][:3] == (4, 5, False) and found["b.csv"][:3] == (4, 3, False)
    right = spark.createDataFrame([(str(tmp_path / f"{n}.csv"), k) for n, k in (("a", 5), ("b", 3), ("c", 2))], "source_file string, expected int")
    again = ingest(spark, EMPLOYEE, str(tmp_path / "*.csv"), "CSV", control(tmp_path, 10), house, KEY, manifest=right, numbered=True)
    assert again["records_loaded"] == 10 and files(spark, house).where("matched").count() == 4
    stored = TargetTable(spark, house.table, target_schema(EMPLOYEE), EMPLOYEE.key).find("EMP0002")
    assert stored.first()["phone_number_encrypted"].startswith("v2:")
    assert decrypted_view(stored, EMPLOYEE, KEY).first()["phone_number"] == "5550001111"
