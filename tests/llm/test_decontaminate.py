"""Edit distances and pieces against the plain table."""

from __future__ import annotations

import random

from feedloom.llm import decontaminate as d


def distance(pattern, text):
    before = [0] * (len(text) + 1)
    for i, c in enumerate(pattern):
        now = [i + 1]
        for j, x in enumerate(text):
            now.append(min(before[j] + (c != x), before[j + 1] + 1, now[j] + 1))
        before = now
    return min(before)


def test_myers():
    random.seed(3)
    for _ in range(2000):
        pattern, text = ("".join(random.choices("ab c", k=random.randint(low, 14))) for low in (1, 0))
        most = random.randint(0, 6)
        assert d.myers(pattern, text, most) == min(distance(pattern, text), most + 1)


def test_no_occurrence_is_lost():
    random.seed(7)
    items = [(i, "".join(random.choices("abcd ", k=random.randint(4, 120)))) for i in range(30)]
    search = d.Searcher(items, d.ERROR_RATE)
    for _ in range(150):
        changed = list(items[random.randrange(30)][1])
        for _ in range(random.randint(0, 9)):
            j = random.randrange(len(changed))
            changed[j : j + 1] = random.choice([[], ["z"], [changed[j], "b"]])
        text = "".join(random.choices("abcd ", k=90)) + "".join(changed) + "".join(random.choices("abcd ", k=90))
        expected = {}
        for number, item in items:
            bare = d.normal(item).strip()
            k = d.budget(bare)
            least = distance(bare if len(bare) >= d.SHORTEST else f" {bare} ", d.normal(text)) if bare else k + 1
            if least <= k:
                expected[number] = least
        assert {number: least for number, least, _ in search.find(text)} == expected


ITEM = "The quick brown fox jumps over the lazy dog while seven wizards watch"
DOCS = "doc_id bigint, text string, distance int, item_id int"


def test_rows(spark, monkeypatch):
    rows = [
        (1, f"before. {ITEM.upper()}!! after", 0, 0), (2, ITEM.replace("quick", "quack").replace(" ", "###  "), 0, 0),
        (3, ITEM[:40], 0, 0), (4, None, 0, 0), (5, "", 0, 0), (6, "a tiny item", 0, 0), (6, f"xx {ITEM}", 0, 0),
        (None, ITEM, 0, 0), (7, "x " * 50_000 + ITEM, 0, 0), (8, "a tinyitem", 0, 0), (9, "an item that has none", 0, 0),
        (20, "the small itam of ours", 0, 0),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    items = spark.createDataFrame(
        [(10, ITEM, 1), (11, "Tiny item", 1), (12, "", 1), (13, None, 1), (14, "!!", 1), (None, ITEM, 1), (10, ITEM, 1),
         (None, "item that has none", 1), (15, "small item of", 1)],
        "item_id bigint, text string, doc_id int",
    )
    expected = {(1, 10, 0), (2, 10, 1), (6, 10, 0), (6, 11, 0), (7, 10, 0), (20, 15, 1)}
    for block in (d.BLOCK_CHARACTERS, 20):
        monkeypatch.setattr(d, "BLOCK_CHARACTERS", block)
        found = d.contaminated(docs, items)
        assert {(r["doc_id"], r["item_id"], r["distance"]) for r in found.collect()} == expected
        kept = d.clean(docs, items)
        assert kept.columns == docs.columns
        assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 8]
    assert d.contaminated(docs.limit(0), items).count() == 0
    assert d.contaminated(docs, items.limit(0)).count() == 0 and d.clean(docs, items.limit(0)).count() == len(rows)
