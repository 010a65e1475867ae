"""The audit of filter orders against counting by hand, and its defined cases."""

from __future__ import annotations

import itertools
from collections import Counter, defaultdict

import pytest

from feedloom.llm.filter_audit import audit

DOCS = "doc_id bigint, text string, source string, kept string"
LABELS = "doc_id bigint, quality int, toxic int, part string"
LONG = "word " * 150 + "Other words here are 60 of many " * 10


def words_of(text):
    return text.encode().split()


def by_hand(docs, labels):
    good, bad = defaultdict(int), defaultdict(int)
    for doc, quality, toxic, _ in labels:
        if doc is not None:
            good[doc] |= quality == 1
            bad[doc] |= toxic == 1
    first = {}
    for doc, text, *_ in docs:
        if doc is not None:
            first[text or ""] = min(doc, first.get(text or "", doc))
    fails = []
    for doc, text, part, _ in docs:
        text = text or ""
        words = words_of(text)
        mask = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
        mask += "C" * (100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text)) + "D" * any(c in "#$%&*|" for c in text)
        mask += "E" * (doc is not None and doc > first[text])
        fails.append((part or "", mask, good[doc] if doc is not None else 0, bad[doc] if doc is not None else 0))
    rows = {}
    for part in {f[0] for f in fails}:
        own, total = [f[1:] for f in fails if f[0] == part], Counter()
        for order in itertools.permutations("ABCDE"):
            alive = own
            for step, letter in enumerate(order, 1):
                removed = [f for f in alive if letter in f[0]]
                failing = sum(letter in f[0] for f in own)
                alive = [f for f in alive if letter not in f[0]]
                total[letter] += len(removed)
                rows[part, "".join(order), step] = [
                    len(alive), len(removed), failing - len(removed), sum(f[0] == letter for f in own),
                    sum(f[1] for f in removed), sum(f[2] for f in removed),
                ]
        for (p, order, step), row in rows.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {key: tuple(row) for key, row in rows.items()}


CASES = [
    (1, "plain words", "a", "x"),
    (2, "plain words", "a", "x"),
    (2, "plain words", "a", "x"),
    (1, "plain words", "b", "x"),
    (3, "plain words", None, "x"),
    (4, None, "", "x"),
    (5, "", "b", None),
    (None, "plain words", "a", "x"),
    (None, None, None, None),
    (6, LONG, "a", "x"),
    (7, LONG.upper(), "a", "x"),
    (8, "|" + LONG, "b", "x"),
    (9, " \t" + "a b\x0bc " * 100 + "é A 　", "b", "x"),
    (7, "same id, other text $", "a", "x"),
    (10, "e\x1ce\x85e" * 300, "a", "x"),
]
KNOWN = [(1, 1, 0, "q"), (2, 0, 1, "q"), (2, 1, 0, "q"), (7, 1, 1, "q"), (None, 1, 1, "q"), (5, None, 1, "q"), (99, 1, 1, None)]


def rows_of(df):
    return {tuple(row)[:3]: tuple(row)[3:] for row in df.collect()}


def test_counts_by_hand(spark):
    found = rows_of(audit(spark.createDataFrame(CASES, DOCS), spark.createDataFrame(KNOWN, LABELS)))
    assert found == by_hand(CASES, KNOWN) and len(found) == 3 * 600


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame(CASES, DOCS), spark.createDataFrame(KNOWN, LABELS)
    assert rows_of(audit(docs, labels.limit(0))) == by_hand(CASES, [])
    assert audit(docs.limit(0), labels).count() == 0


def test_many_copies_and_a_long_text(spark):
    docs = [(i, "copied text #", f"p{i % 3}", None) for i in range(300)] + [(1000, "Long word " * 200_000, "p0", None)]
    found = rows_of(audit(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame([(0, 1, 1, "")], LABELS)))
    assert found == by_hand(docs, [(0, 1, 1, "")])


def test_own_filters_and_no_duplicates(spark):
    docs = spark.createDataFrame(CASES, DOCS)
    found = audit(docs, spark.createDataFrame(KNOWN, LABELS), lambda text: {"X": text == "", "Y": text.contains("words")}, None)
    rows = rows_of(found)
    assert {key[1] for key in rows} == {"XY", "YX"} and rows["", "XY", 1] == (1, 2, 0, 2, 0, 0, 4)


def test_more_parts_than_a_recursion_may_have_rows(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "1000")
    try:
        docs = spark.range(40).selectExpr("id AS doc_id", "'x' AS text", "concat('p', id) AS source")
        assert audit(docs, spark.createDataFrame(KNOWN, LABELS)).count() == 40 * 600
        assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "1000"
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", before)


@pytest.mark.parametrize("column", ["mask", "digest", "n", "part", "cells"])
def test_clashing_columns(spark, column):
    docs = spark.createDataFrame(CASES, DOCS).withColumnRenamed("kept", column)
    assert rows_of(audit(docs, spark.createDataFrame(KNOWN, LABELS))) == by_hand(CASES, KNOWN)
