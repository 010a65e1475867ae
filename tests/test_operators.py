"""Routing, merging, counting, ledger, control files, file checks, rewriting."""

from __future__ import annotations

import pytest
from fixtures import json_lines, write
from pyspark.sql import functions as F

from feedloom.functions.records import error_line
from feedloom.operators.ledger import Ledger, run_gate, run_status
from feedloom.operators.merge import TargetTable, latest_per_key, upsert
from feedloom.operators.reconcile import check_count, check_count_per, require_records
from feedloom.operators import rewrite
from feedloom.operators.rewrite import file_count, split_feed
from feedloom.operators.route import write_error_report, write_error_table
from feedloom.plans.ingest import new_execution_id, run_name
from feedloom.sources.control import expected_count, read_control_files
from feedloom.sources.files import check_files, inside, list_files, needs_split, normalized, plain
from feedloom.sources.reader import file_type


def test_report_line_stays_on_one_line(spark, tmp_path):
    row = [(4, "VALIDATION_ERROR", "email is required|bad\nli\rne", None, "a|b.csv", "run")]
    df = spark.createDataFrame(
        row, "record_number long, error_type string, error_message string, employee_id string, source_file string, execution_id string"
    )
    line = (
        "record_number=4|error_type=VALIDATION_ERROR|error_message=email is required bad li ne|employee_id="
        "|source_file=a b.csv|execution_id=run"
    )
    assert df.selectExpr(error_line("employee_id")).first()[0] == line
    write_error_report(df.union(df).repartition(2), "employee_id", str(tmp_path / "r"), single_file=True)
    assert len(list((tmp_path / "r").glob("part-*"))) == 1
    assert [r[0] for r in spark.read.text(str(tmp_path / "r")).collect()] == [line, line]


def test_upsert_replaces_adds_and_repeats_safely(spark, tmp_path):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    incoming = spark.createDataFrame([(2, "x", 1), (2, "y", 3), (2, "w", 2), (3, "z", 1)], "k int, v string, n int")
    once = upsert(base, incoming, "k", ["n"])
    assert sorted(map(tuple, once.collect())) == [(1, "a"), (2, "y"), (3, "z")]
    assert sorted(map(tuple, upsert(once, incoming, "k", ["n"]).collect())) == [(1, "a"), (2, "y"), (3, "z")]
    table = TargetTable(spark, str(tmp_path / "t"), "k int, v string", "k")
    assert table.read().count() == 0 and table.find(2).count() == 0
    table.publish(base)
    for _ in range(2):
        table.merge(incoming, ["n"])
        assert sorted(map(tuple, table.read().collect())) == [(1, "a"), (2, "y"), (3, "z")]
    table.publish(base)
    assert sorted(map(tuple, table.read().collect())) == [(1, "a"), (2, "b")]


def test_failed_merge_leaves_the_table(spark, tmp_path):
    table = TargetTable(spark, str(tmp_path / "t"), "k int, v string", "k", parts=4)
    table.publish(spark.range(40).selectExpr("int(id) AS k", "'a' AS v"))
    bad = spark.range(40).selectExpr("int(id) AS k", "if(id = 39, raise_error('lost'), 'b') AS v", "1 AS n")
    with pytest.raises(Exception, match="lost"):
        table.merge(bad, ["n"])
    assert table.read().where("v = 'a'").count() == table.read().count() == 40


def test_parts_without_incoming_keys_are_not_rewritten(spark, tmp_path):
    table = TargetTable(spark, str(tmp_path / "t"), "k int, v string", "k", parts=8)
    table.publish(spark.range(100).selectExpr("int(id) AS k", "'a' AS v"))
    before = {p for p in (tmp_path / "t").glob("part_of_8=*/*.parquet")}
    again = TargetTable(spark, str(tmp_path / "t"), "k int, v string", "k", parts=32)  # the stored number counts
    again.merge(spark.createDataFrame([(5, "b", 1), (100, "c", 1)], "k int, v string, n int"), ["n"])
    folders = {p.parent for p in before}
    rewritten = {p.parent for p in before if not p.exists()}
    assert len(folders) == 8 and 1 <= len(rewritten) <= 2
    assert table.read().count() == 101 and table.read().where("k = 5").first()["v"] == "b"


def test_lookup_reads_one_partition(spark, tmp_path):
    table = TargetTable(spark, str(tmp_path / "t"), "k bigint, v string", "k", parts=8)
    table.publish(spark.range(1000).selectExpr("id AS k", "string(id) AS v"))
    found = table.find(77)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in found.collect()] == [(77, "77")] and table.find(1000).count() == 0
    assert "part_of_8" in plan[plan.index("PartitionFilters") :].split("]")[0] and "EqualTo(k,77)" in plan
    assert len({r[0] for r in found.select("_metadata.file_path").collect()}) == 1
    keys = spark.createDataFrame([(5,), (5,), (900,), (-1,)], "k long")
    assert sorted(r["v"] for r in table.find_all(keys).collect()) == ["5", "900"]


def test_rows_without_a_key_are_refused(spark):
    rows = spark.createDataFrame([(1, 1), (None, 2)], "k int, n int")
    with pytest.raises(Exception, match="a key is missing"):
        latest_per_key(rows, "k", ["n"]).collect()


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(9000).selectExpr("if(id % 3 = 0, -1, id) AS k", "id AS n")
    latest = latest_per_key(df, "k", ["n"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("WindowGroupLimit") < plan.rindex("Exchange")
    assert plan.count("WindowGroupLimit") == 2
    assert latest.count() == 6001 and latest.where("k = -1").first()["n"] == 8997


def test_counts(spark):
    nothing = spark.createDataFrame([], "f string")
    assert check_count(nothing, 0).first().asDict() == {
        "expected": 0, "actual": 0, "matched": True, "status": "SUCCESS", "failure_message": None,
    }
    row = check_count(spark.createDataFrame([("a",), ("a",)], "f string"), 3).first()
    assert row["failure_message"] == "Record count mismatch: control file expected 3 record(s) but 2 record(s) were loaded"
    manifest = spark.createDataFrame([("a", 2), ("b", 0), ("c", 1)], "f string, expected long")
    per_file = check_count_per(spark.createDataFrame([("a",), ("a",)], "f string"), manifest, "f")
    assert {r["f"]: (r["actual"], r["matched"]) for r in per_file.collect()} == {"a": (2, True), "b": (0, True), "c": (0, False)}
    with pytest.raises(ValueError, match="Input file contains no records"):
        require_records(nothing)


def test_ledger_states_and_gate(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "runs"))
    assert ledger.current().count() == 0
    at = spark.sql("SELECT current_timestamp()").first()[0]
    done, stuck, refused = (new_execution_id() for _ in range(3))
    ledger.save(done, "f", "STARTED", at, 2)
    ledger.save(done, "f", "SUCCESS", at, 2, 2)
    ledger.save(stuck, "f", "RUNNING", at, 5)
    ledger.save(refused, "f", "FAILED", at, reason="Control file is missing")
    for run in (done, stuck, refused):
        ledger.fail_if_unfinished(run, "worker lost")
    ledger.save(done, "f", "FAILED", at, 2, reason="late")  # an end stands
    for status, source in (("DONE", "f"), ("STARTED", "f" * 1001)):
        with pytest.raises(ValueError):
            ledger.save(stuck, source, status, at)
    state = {r["execution_id"]: (r["status"], r["failure_reason"], r["completed_at"] is None) for r in ledger.current().collect()}
    assert state == {
        done: ("SUCCESS", None, False), stuck: ("FAILED", "worker lost", False),
        refused: ("FAILED", "Control file is missing", False),
    }
    errors = spark.createDataFrame([(done, 1), (done, 2), (stuck, 1)], "execution_id string, record_number long")
    status = run_status(ledger.events(), errors)
    asked = spark.createDataFrame([(done,), (stuck,), ("unknown",)], "execution_id string")
    gate = {r["execution_id"]: r.asDict() for r in run_gate(status, asked).collect()}
    assert (gate[done]["verdict"], gate[done]["reason"], gate[done]["loaded"]) == ("WARN", "2 record(s) were rejected", 2)
    assert gate[stuck]["reason"] == "Ingestion ended with status FAILED: worker lost"
    assert gate["unknown"]["verdict"] == "FAIL" and gate["unknown"]["reason"].startswith("No ingestion_execution row")
    assert run_name(done) == f"ingestion_{done}"


def test_ledger_compaction(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "runs"))
    at = spark.sql("SELECT current_timestamp()").first()[0]
    for i in range(5):
        ledger.save(f"run-{i}", "f", ("STARTED", "RUNNING"), at, i)
        if i % 2:
            ledger.save(f"run-{i}", "f", "SUCCESS", at, i, i)
    before = sorted(map(tuple, ledger.current().collect()))
    ledger.compact(above=100)
    assert len(list((tmp_path / "runs").glob("part-*"))) == 7
    ledger.compact()
    assert len(list((tmp_path / "runs").glob("part-*"))) == 1 and ledger.events().count() == 5
    assert sorted(map(tuple, ledger.current().collect())) == before
    ledger.save("run-0", "f", "SUCCESS", at, 0, 0)  # an event behind the compacted ones
    assert {r["execution_id"]: r["status"] for r in ledger.current().collect()}["run-0"] == "SUCCESS"


def test_errors_of_a_repeated_run_are_replaced(spark, tmp_path):
    failures = spark.createDataFrame(
        [("a", "f", 1, "PARSE_ERROR", "m", None), ("a", "f", 2, "PARSE_ERROR", "m", None), ("b", "f", 1, "LOAD_ERROR", "m", "{}")],
        "execution_id string, source_file string, record_number long, error_type string, error_message string, raw_record string",
    )
    path = str(tmp_path / "errors")
    write_error_table(failures, path)
    first = {(r["execution_id"], r["record_number"]): r["id"] for r in spark.read.parquet(path).collect()}
    write_error_table(failures.where("execution_id = 'a'"), path, "a")
    again = spark.read.parquet(path).collect()
    assert {(r["execution_id"], r["record_number"]): r["id"] for r in again} == first and len(again) == 3 == len(set(first.values()))
    write_error_table(failures.limit(0), path, "a")
    assert [r["execution_id"] for r in spark.read.parquet(path).collect()] == ["b"]


def test_control_files(spark, tmp_path):
    contents = {
        "a": ("record_count=200", 200, None),
        "b": ("# count\r\n record_count =  15  \r\n", 15, None),
        "c": ("other=1\n#record_count=3\n", None, "Control file is missing required property: record_count"),
        "d": ("record_count=ten", None, "record_count must be a whole number but was: ten"),
        "e": ("record_count=-1", None, "record_count must not be negative: -1"),
        "f": ("record_count=1\nrecord_count: 2", 2, None),
        "g": ("record_counts=5\nrecord_count 6", 6, None),
        "h": ("record_count=", None, "Control file is missing required property: record_count"),
        "i": ("record_count=0", 0, None),
    }
    paths = {write(tmp_path / f"{k}.properties", v[0]): k for k, v in contents.items()}
    rows = read_control_files(spark, str(tmp_path / "*.properties")).collect()
    assert {paths[r["control_file"]]: (r["expected"], r["problem"]) for r in rows} == {
        k: v[1:] for k, v in contents.items()
    }
    assert expected_count(spark, str(tmp_path / "a.properties")) == 200
    for path, message in ((str(tmp_path / "none"), "does not exist"), (" ", "must not be blank"), (None, "must not be blank")):
        with pytest.raises(ValueError, match=message):
            expected_count(spark, path)
    with pytest.raises(ValueError, match="missing required"):
        expected_count(spark, write(tmp_path / "empty", ""))
    for path in (str(tmp_path), str(tmp_path / "*.properties")):  # one regular file only
        with pytest.raises(ValueError, match="cannot be read"):
            expected_count(spark, path)


def test_file_types():
    assert file_type(" csv ") == "CSV" and file_type("Json") == "JSON"
    for name, message in ((None, "fileType is required"), (" ", "is required"), ("XML", "Unsupported fileType 'XML'. Supported values")):
        with pytest.raises(ValueError, match=message):
            file_type(name)


def test_file_checks(spark, tmp_path):
    write(tmp_path / "a.csv", "id\n1\n")
    write(tmp_path / "b.CSV", "")
    write(tmp_path / "c.json", "{}")
    listing = list_files(spark, str(tmp_path / "*"))
    assert {r["path"].rsplit("/", 1)[1]: r["size"] for r in listing.collect()} == {"a.csv": 5, "b.CSV": 0, "c.json": 2}
    root = str(tmp_path)
    asked = spark.createDataFrame(
        [(f"{root}/a.csv", "csv"), (f"{root}/b.CSV", "CSV"), (f"{root}/c.json", "CSV"), (f"{root}/d.csv", "CSV"),
         (f"{root}/a.csv", "XML"), ("/etc/x.csv", "CSV")],
        "path string, file_type string",
    )
    rows = check_files(asked, listing, root).collect()
    problems = {(r["path"].rsplit("/", 1)[1], r["file_type"]): r["problem"] for r in rows}
    assert problems == {
        ("a.csv", "csv"): None,
        ("b.CSV", "CSV"): f"Data file is empty: {root}/b.CSV",
        ("c.json", "CSV"): "Data file must end with .csv for fileType CSV: c.json",
        ("d.csv", "CSV"): f"Data file does not exist: {root}/d.csv",
        ("a.csv", "XML"): "Unsupported fileType XML; expected CSV or JSON",
        ("x.csv", "CSV"): f"path must be inside {root}",
    }
    assert plain("file:///a/b") == "/a/b" and plain("s3a://b/c") == "s3a://b/c"


def test_paths_inside_a_root(spark):
    cases = {
        "x.csv": ("/r/x.csv", True), "a/../x.csv": ("/r/x.csv", True), "../x.csv": ("/x.csv", False),
        "/r/./a//b": ("/r/a/b", True), "/r/../r2/x": ("/r2/x", False), "/r2/x": ("/r2/x", False),
        "../../../etc": ("/etc", False), "": ("/r", True), " a ": ("/r/a", True),
    }
    df = spark.createDataFrame([(p,) for p in cases], "p string")
    got = df.select("p", normalized(F.col("p"), "/r").alias("n"), inside(F.col("p"), "/r").alias("i")).collect()
    assert {r["p"]: (r["n"], r["i"]) for r in got} == cases
    sizes = spark.createDataFrame([(1,), (2,)], "size long").select(needs_split(F.col("size"), 1))
    assert [r[0] for r in sizes.collect()] == [False, True]


def test_split_keeps_padded_cells_in_order(spark, tmp_path, monkeypatch):
    """Two tasks write five files: each file is full, and all are in the feed's order."""
    monkeypatch.setattr(rewrite, "PARTITIONS", 2)
    source = write(tmp_path / "a.csv", "a,b\n" + "".join(f'" {n} ",x\n' for n in range(9)))
    split_feed(spark, source, "CSV", str(tmp_path / "out"), 2)
    files = [p.read_text().splitlines() for p in sorted((tmp_path / "out").glob("part-*.csv"), key=lambda p: (p.name[:10], p.name[-12:]))]
    assert [len(lines) - 1 for lines in files] == [2, 2, 2, 2, 1]
    assert [line.replace('"', "") for lines in files for line in lines[1:]] == [f" {n} ,x" for n in range(9)]


def test_split_csv_and_json(spark, tmp_path):
    for name, numbers in (("a", range(7)), ("b", range(7, 10))):
        write(tmp_path / f"{name}.csv", "employee_id,first_name\n" + "".join(f'E{n},"n, {n}"\n' for n in numbers))
    out, source = tmp_path / "csv", str(tmp_path / "*.csv")
    assert split_feed(spark, source, "CSV", str(out), 4) == 3
    lines = [p.read_text().splitlines() for p in sorted(out.glob("part-*.csv"))]
    assert all(p[0] == "employee_id,first_name" for p in lines)
    assert [line for p in lines for line in p[1:]] == [f'E{n},"n, {n}"' for n in range(10)] and [len(p) - 1 for p in lines] == [4, 4, 2]
    assert split_feed(spark, source, "CSV", str(out), 100) == 1  # the earlier parts are replaced
    assert len(list(out.glob("part-*.csv"))) == 1
    array = write(tmp_path / "a.json", "[" + ",\n".join(f'{{"employee_id": "E{n}",\n "x": null}}' for n in range(5)) + "]")
    assert split_feed(spark, array, "json", str(tmp_path / "json"), 10) == 1
    assert spark.read.text(str(tmp_path / "json")).where("value LIKE '{%\"x\":%null}'").count() == 5
    for name, text in (("e.csv", "employee_id\n"), ("f.csv", ""), ("e.json", "[]")):
        with pytest.raises(ValueError, match="contains no records"):
            split_feed(spark, write(tmp_path / name, text), name[2:], str(tmp_path / "none"), 10)
    with pytest.raises(Exception, match="row has 1 column"):
        split_feed(spark, write(tmp_path / "g.csv", "a,b\n1,2\n3\n"), "CSV", str(tmp_path / "none"), 10)


def test_file_count():
    assert [file_count(n, 50) for n in (0, 1, 50, 101)] == [1, 1, 1, 3]
    with pytest.raises(ValueError):
        file_count(1, 0)


def test_every_record_is_either_loaded_or_failed(spark, tmp_path):
    from fixtures import KEY, json_record
    from feedloom.plans.employee import EMPLOYEE
    from feedloom.plans.ingest import outcomes
    from feedloom.sources.reader import read_feed

    changes = [{}, {"salary": "x"}, {"email": None}, {"last_name": "a\x00"}, {"first_name": "Al", "salary": -1}]
    records = [json_record(n, **changes[n % 5]) for n in range(1, 101)]
    source = write(tmp_path / "a.json", json_lines(records))
    done = outcomes(read_feed(spark, source, EMPLOYEE, "JSON"), EMPLOYEE, new_execution_id(), KEY)
    kinds = {r["error_type"]: (r["n"], r["sealed"]) for r in done.groupBy("error_type").agg(
        F.count("*").alias("n"), F.count("phone_number_encrypted").alias("sealed")).collect()}
    assert kinds == {None: (20, 20), "PARSE_ERROR": (20, 0), "VALIDATION_ERROR": (40, 0), "LOAD_ERROR": (20, 0)}
