"""The plans that matter at scale."""

from __future__ import annotations

import pytest
from fixtures import KEY, csv_text, variation, write

from feedloom.operators.lookup import find
from feedloom.operators.merge import TargetTable
from feedloom.operators.route import failed, good, validate
from feedloom.plans.employee import EMPLOYEE
from feedloom.plans.ingest import new_execution_id, outcomes
from feedloom.sources.csv_feed import read_csv
from feedloom.sources.reader import read_feed


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def feed_file(tmp_path):
    return write(tmp_path / "a.csv", csv_text([variation(n) for n in range(1, 50)]))


def test_outcomes_need_no_shuffle(spark, feed_file):
    done = outcomes(read_feed(spark, feed_file, EMPLOYEE, "CSV"), EMPLOYEE, new_execution_id(), KEY)
    plan = physical(done)
    assert "BroadcastHashJoin" in plan  # the block table, checked to be small
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan and "Python" not in plan


def test_counting_pass_is_a_hash_aggregation(spark, feed_file):
    from pyspark.sql import functions as F

    from feedloom.sources import lines as L

    rows = L.read_lines(spark, feed_file)
    plan = physical(rows.groupBy(L.FILE, L.BLOCK).agg(F.count("*"), F.min(L.LINE_ID)))
    assert "SortAggregate" not in plan and "Window" not in plan


def test_rules_are_evaluated_once(spark, tmp_path):
    spark.createDataFrame([], ", ".join(f"`{f.name}` {f.ddl}" for f in EMPLOYEE.fields)).write.parquet(str(tmp_path / "t"))
    checked = validate(spark.read.parquet(str(tmp_path / "t")), EMPLOYEE)
    for branch in (checked, good(checked), failed(checked)):
        assert optimized(branch).count("email has an invalid format") == 1


def test_lookup_reaches_the_scan(spark, tmp_path):
    table = TargetTable(spark, str(tmp_path / "t"), "k string, v string, w string", "k")
    table.publish(spark.createDataFrame([("a", "b", "c")], "k string, v string, w string"))
    plan = physical(find(table.read(), "k", "a").select("v"))
    assert "EqualTo(k,a)" in plan and "ReadSchema: struct<k:string,v:string>" in plan


def test_parse_error_alone_is_still_exact(spark, tmp_path):
    """Selecting few columns must not change which rows count as ragged."""
    source = write(tmp_path / "r.csv", "a,b,c\n1,2,3\n1,2\n1,2,3,4\n")
    df = read_csv(spark, source, ["a", "b", "c"])
    assert [r[0] is None for r in df.orderBy("record_number").select("parse_error").collect()] == [True, False, False]
    assert df.where("parse_error IS NOT NULL").count() == 2
    assert df.where("parse_error IS NULL").selectExpr("max(b)").first()[0] == "2"


def test_large_block_tables_are_not_broadcast(spark, feed_file, monkeypatch):
    from feedloom.sources import lines as L

    monkeypatch.setattr(L, "BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = read_csv(spark, feed_file, ["employee_id"])
        assert "BroadcastHashJoin" not in physical(df)
        assert df.selectExpr("count(*)", "max(record_number)", "count(DISTINCT employee_id)").first() == (49, 49, 49)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
