"""Targets by repeated resharing, and what a mix takes."""

from __future__ import annotations

from collections import defaultdict

import pytest

from feedloom.llm import mixing

SCHEMA = "doc_id bigint, text string, source string, size int, hash string, below int"


def plain_targets(sizes):
    order = sorted(sizes, key=lambda source: (source is None, (source or "").encode()))
    weight = {source: (5, 2, 1)[i % 3] for i, source in enumerate(order)}
    left, capped = float(sum(sizes.values())), {}
    while True:
        free = [source for source in order if source not in capped]
        share = left / sum(weight[source] for source in free) if free else 0
        above = [source for source in free if share * weight[source] > 3 * sizes[source]]
        if not above:
            return {**capped, **{source: share * weight[source] for source in free}}
        for source in above:
            capped[source] = 3.0 * sizes[source]
            left -= capped[source]


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 900, "c": 50, "d": 3, None: 4000}, {"a": 0, "é": 7, "Z": 7, None: 0}, {"one": 5}])
def test_targets(spark, sizes):
    rows = [(source, size) for source, size in sizes.items()]
    found = mixing.targets(spark.createDataFrame(rows, "source string, size bigint")).collect()
    assert {r["source"]: r["target"] for r in found} == pytest.approx(plain_targets(sizes))


def docs_of(spark, n):
    rows = [(i, "word " * (1 + i * i % 90), [None, "src0", "src0", "src1", "b"][i % 5], 0, "", 0) for i in range(n)]
    return spark.createDataFrame([*rows, (n, None, "src0", 0, "", 0), (3, "a b", "b", 0, "", 0), (None, "c", "b", 0, "", 0)], SCHEMA)


def test_taken_words_meet_the_targets(spark):
    docs = docs_of(spark, 1500)
    rows = mixing.mix(docs).collect()
    assert len(rows) == 1503 and all(r["taken"] <= 3 * r["size"] and r["taken"] % max(r["size"], 1) == 0 for r in rows)
    taken, target = defaultdict(int), {}
    for r in rows:
        taken[r["source_size"]] += r["taken"]
        target[r["source_size"]] = r["target"]
    assert taken.keys() == target.keys() and sum(target.values()) == pytest.approx(sum(target))
    for source, words in taken.items():
        assert words == pytest.approx(target[source], rel=0.005)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(rows, key=str) == sorted(again, key=str)


def test_rows_are_repeated(spark):
    docs = docs_of(spark, 200)
    wanted = defaultdict(int)
    for r in mixing.mix(docs).where("doc_id <> 3").collect():
        wanted[r["doc_id"]] += r["taken"] // max(r["size"], 1) if r["size"] else 0
    got = defaultdict(int)
    rows = mixing.mixed(docs)
    assert rows.columns == docs.columns
    for r in rows.where("doc_id <> 3 AND text IS NOT NULL").collect():
        got[r["doc_id"]] += 1
    assert got == {k: v for k, v in wanted.items() if v}


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0
    blank = spark.createDataFrame([(1, None, None, 0, "", 0), (2, " ", None, 0, "", 0)], SCHEMA)
    assert [(r["size"], r["target"], r["taken"]) for r in mixing.mix(blank).collect()] == [(0, 0.0, 0)] * 2


def test_rows_without_ids_are_dealt_out_one_by_one(spark):
    """A source whose rows share an id, or have none, still comes near its target."""
    rows = [(None, f"{'word ' * (20 + i % 30)}{i}", "none", 0, "", 0) for i in range(150)]
    rows += [(7, f"{'word ' * (20 + i % 30)}{i}", "same", 0, "", 0) for i in range(150)]
    rows += [(1000 + i, "word " * (10 + i % 50), "big", 0, "", 0) for i in range(400)]
    found = mixing.mix(spark.createDataFrame(rows, SCHEMA)).groupBy("target").sum("taken").collect()
    assert len(found) == 3
    for row in found:
        assert row["sum(taken)"] == pytest.approx(row["target"], rel=0.03)
