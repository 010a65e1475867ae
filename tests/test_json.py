"""JSON reading in any layout."""

from __future__ import annotations

import json
import random

import pytest
from fixtures import json_lines, json_record, write
from pyspark.sql import functions as F

from feedloom.plans.employee import EMPLOYEE
from feedloom.queries.raw_feed import numbered_batches
from feedloom.sources import json_array
from feedloom.sources.json_feed import read_json, read_json_elements
from feedloom.sources.reader import read_feed


def numbered(df):
    return [(r["record_number"], r["__raw"] and json.loads(r["__raw"])) for r in df.orderBy("record_number").collect()]


@pytest.mark.parametrize("layout", ["lines", "array", "pretty", "one line", "glued", "spread"])
def test_layouts(small_blocks, tmp_path, layout):
    rng = random.Random(3)
    tricky = ['"', "}", "{", "} {", "],[", "\\", "é", '"},{"', "a\nb", ", ", "]"]
    records = [
        {"id": n, "text": "".join(rng.choice(tricky) for _ in range(rng.randint(0, 6))), "nested": {"list": [1, {"x": []}]}}
        for n in range(1, 120)
    ]
    text = {
        "lines": "\n".join(json.dumps(r) for r in records) + "\n\n",
        "array": "[\n" + ",\n".join(json.dumps(r, ensure_ascii=False) for r in records) + "\n]\n",
        "pretty": json.dumps(records, indent=2),
        "one line": json.dumps(records),
        "glued": "".join(json.dumps(r) + (" " if r["id"] % 3 else "\n") for r in records),
        "spread": "\n".join(json.dumps(r, indent=1) for r in records),
    }[layout]
    source = write(tmp_path / "a.json", text)
    assert numbered(read_json_elements(small_blocks, source)) == list(enumerate(records, 1))


def test_files_of_different_layouts_together(spark, tmp_path):
    write(tmp_path / "a.json", '{"id": 1}\n{"id": 2}\n')
    write(tmp_path / "b.json", '[{"id": 3},\n {"id": 4}, {"id": 5}]')
    write(tmp_path / "c.json", "")
    write(tmp_path / "d.json", "[]")
    rows = read_json(spark, str(tmp_path / "*.json"), ["id"]).orderBy("id").collect()
    assert [(r["source_file"][-6:], r["record_number"], r["id"]) for r in rows] == [
        ("a.json", 1, "1"), ("a.json", 2, "2"), ("b.json", 1, "3"), ("b.json", 2, "4"), ("b.json", 3, "5"),
    ]


CASES = [
    ({"salary": "lots"}, "invalid value for field 'salary'"),
    ({"salary": 1.5}, "invalid value for field 'salary'"),
    ({"salary": "12"}, None),
    ({"salary": ""}, None),
    ({"is_active": "maybe"}, "invalid value for field 'is_active'"),
    ({"is_active": "True"}, None),
    ({"first_name": {"a": 1}}, "invalid value for field 'first_name'"),
    ({"first_name": "{a: 1}"}, None),
    ({"first_name": 7}, None),
    ({"skills": "Routing"}, "invalid value for field 'skills'"),
    ({"skills": '["Routing"]'}, "invalid value for field 'skills'"),
    ({"skills": ["a", None]}, "invalid value for field 'skills'"),
    ({"skills": ["a", {"b": 1}]}, "invalid value for field 'skills.[1]'"),
    ({"skills": ["[a]", 3]}, None),
    ({"skills": None}, None),
    ({"address": "Bergen"}, "invalid value for field 'address'"),
    ({"address": '{"city": "Bergen"}'}, "invalid value for field 'address'"),
    ({"address": {"city": ["Bergen"]}}, "invalid value for field 'address.city'"),
    ({"address": {"city": "[Bergen]", "planet": 3}}, None),
    ({"address": None}, None),
    ({"planet": {"unknown": True}}, None),
]


@pytest.mark.parametrize("array", [False, True])
def test_wrong_types_reject_only_their_record(spark, tmp_path, array):
    records = [json_record(n, **changes) for n, (changes, _) in enumerate(CASES, 1)]
    text = json.dumps(records, indent=1) if array else json_lines(records)
    rows = read_feed(spark, write(tmp_path / "a.json", text), EMPLOYEE, "JSON").orderBy("record_number").collect()
    for number, (row, (changes, error)) in enumerate(zip(rows, CASES, strict=True), 1):
        assert row["parse_error"] == error, changes
        assert row["employee_id"] == (None if error else f"EMP{number:04d}"), changes


def test_elements_that_are_no_objects(spark, tmp_path):
    text = '[{"id": 1}, 7, "x", null, [1, 2], {"id": 2}]'
    rows = read_json(spark, write(tmp_path / "a.json", text), ["id"]).orderBy("record_number").collect()
    bad = "record has an invalid structure"
    assert [r["parse_error"] for r in rows] == [None, bad, bad, bad, bad, None]
    assert (rows[0]["id"], rows[5]["id"]) == ("1", "2")


@pytest.mark.parametrize("text", ['{"id": 1}\n{"id": \n', '"just text"', "42", '[{"id": 1}, {"id"', '{"id": 1} x'])
def test_broken_files_fail(spark, tmp_path, text):
    with pytest.raises(Exception, match="not valid JSON"):
        read_json(spark, write(tmp_path / "a.json", text), ["id"]).collect()


def test_broken_lines_as_dead_letters(spark, tmp_path):
    source = write(tmp_path / "a.json", '{"id": 1}\n{"id": }\n{"id": 3}\n')
    rows = read_json(spark, source, ["id"], on_broken="dead_letter").orderBy("record_number").collect()
    assert [(r["id"], r["parse_error"]) for r in rows] == [("1", None), (None, "record has an invalid structure"), ("3", None)]


def test_byte_order_mark_and_blank_lines(spark, tmp_path):
    source = write(tmp_path / "a.json", '﻿\n  \n{"id": 1}\n\t\n{"id": 2}')
    assert [r["id"] for r in read_json(spark, source, ["id"]).orderBy("record_number").collect()] == ["1", "2"]


BROKEN = {
    "text behind an object": '{"id":"1"} junk {"id":"9"}\n',
    "two arrays": "[1,2]\n[3,4]\n",
    "objects behind an array": '[{"id":"1"}]\n{"id":"2"}\n',
    "text behind an array": "[1,\n2]\noops\n",
    "on the array's last line": '[{"id":"1"},\n{"id":"2"}] {"id":"3"}\n',
    "on one line": '[{"id":"1"},{"id":"2"}] {"id":"3"}\n',
    "no comma": '[{"id":"1"}\n{"id":"2"}]\n',
    "two commas": '[{"id":"1"},\n,{"id":"2"}]\n',
    "comma at the start": '[\n,{"id":"1"}]\n',
    "comma at the end": '[{"id":"1"},\n]\n',
    "single quotes": "{'id':'1'}\n",
    "not closed": '{"id":"1"}\n{"id":\n',
    "closed twice": '{"id":"1"}\n}\n',
    "no number": '{"id":NaN}\n',
}


@pytest.mark.parametrize("case", BROKEN)
def test_broken_files(spark, tmp_path, case):
    source = write(tmp_path / "a.json", BROKEN[case])
    with pytest.raises(Exception, match="not valid JSON"):
        read_json(spark, source, ["id"]).collect()
    rows = read_json(spark, source, ["id"], on_broken="dead_letter").collect()
    assert any(r["__raw"] is None and r["parse_error"] == "record has an invalid structure" for r in rows)


def test_one_line_arrays_are_read_by_many_tasks(small_blocks, tmp_path):
    """Blocks begin inside strings, between brackets and in elements longer than a block."""
    records = [{"id": n, "t": '"}],[{' * (n % 5) + "\\" * (n % 3), "n": {"l": [{"x": {}}] * (n % 4)}} for n in range(150)]
    records[70]["t"] = "} long " * 400
    write(tmp_path / "a.json", json.dumps(records))
    write(tmp_path / "b.json", json.dumps(records[:3] + [[{"a": 1}, 2], "x}", 7, None] + records[3:9]) + " \n ")
    write(tmp_path / "c d.json", "[ ]")
    write(tmp_path / "e.json", '{"id": 1}\n{"id": 2}\n')
    df = read_json_elements(small_blocks, str(tmp_path / "*.json"))
    found = {}
    for row in df.collect():
        found.setdefault(row["source_file"][-6:], []).append((row["record_number"], "x}" if row["__raw"] == "x}" else json.loads(row["__raw"])))
    assert sorted(found) == ["a.json", "b.json", "e.json"]  # and every element of the empty array
    assert sorted(found["a.json"], key=lambda x: x[0]) == list(enumerate(records, 1))
    assert sorted(found["b.json"], key=lambda x: x[0]) == list(enumerate(records[:3] + [[{"a": 1}, 2], "x}", 7, None] + records[3:9], 1))
    assert sorted(found["e.json"]) == [(1, {"id": 1}), (2, {"id": 2})]


def test_tasks_of_a_large_array_have_bounded_shares(small_blocks, tmp_path, monkeypatch):
    """However many pieces there are, none of the tasks that order them has more than its share of blocks."""
    staged, stage = {}, json_array.stage
    monkeypatch.setattr(json_array, "stage", lambda df, name: staged.setdefault(name, stage(df, name)))
    monkeypatch.setattr(json_array, "TASK_BYTES", 100_000, raising=False)
    small_blocks.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    n = 20_000
    source = write(tmp_path / "a.json", "[" + ",".join('{"n":%d}' % i for i in range(n)) + "]")
    rows = read_json_elements(small_blocks, source).withColumn("task", F.spark_partition_id())
    found = rows.collect()
    assert sorted((r["record_number"], r["__raw"]) for r in found) == [(i + 1, '{"n":%d}' % i) for i in range(n)]
    chunks = staged["array-chunks"].groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    numbered_ = max(sum(r["task"] == task for r in found) for task in {r["task"] for r in found})
    assert chunks < n / 3 and numbered_ < n / 3


def test_batches_are_written_by_as_many_tasks(spark, tmp_path):
    lines = spark.range(0, 4000, 1, 4).selectExpr("id DIV 100 AS batch", "id AS place", "cast(id AS string) AS line")
    numbered_batches(lines, str(tmp_path / "batches"), "n")
    files = list((tmp_path / "batches").rglob("part-*"))
    assert len(files) == 40 and len({p.name for p in files}) > 10  # a name holds its task's number
    texts = {p.parent.name: p.read_text() for p in files}
    assert texts["batch=7"] == "".join(f"{line}\n" for line in ["n", *range(700, 800)])


@pytest.mark.parametrize("text", ['[{"a":1},', '[{"a":1}', '[{"a":1}]}', '[{"a":"}]', "[", '[{"a":1}{"a":2}]', '[{"a":1},]', '[,{"a":1}]', '[{"a":1}],', '[{"a":1}]]'])
def test_broken_one_line_arrays(spark, tmp_path, text):
    source = write(tmp_path / "a.json", text)
    with pytest.raises(Exception, match="not valid JSON"):
        read_json(spark, source, ["a"]).collect()


def test_good_arrays_with_commas_anywhere(small_blocks, tmp_path):
    layouts = ['[{"id":%d}\n,\n{"id":%d}\n,{"id":%d},\n\n{"id":%d}\n]', "[\n]", "[%d,\n%d\n,%d]", '[{"a":[\n%d\n,%d]}\n]\n\n']
    for i, layout in enumerate(layouts):
        text = layout % tuple(range(layout.count("%d")))
        source = write(tmp_path / f"{i}.json", text)
        assert [value for _, value in numbered(read_json_elements(small_blocks, source))] == json.loads(text)
