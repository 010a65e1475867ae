"""Fingerprints and components against all pairs."""

from __future__ import annotations

import random
import re

import pytest
import xxhash
from brute import by_id, reach

from feedloom.llm import cells, simhash
from feedloom.llm.components import components

SCHEMA = "doc_id bigint, text string, fp string, fingerprint int, cell int"


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(shingle.encode(), 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def near(texts):
    """Texts, many of them variants of one another."""
    random.seed(2)
    words = [f"w{i}" for i in range(400)]
    for _ in range(20):
        base = random.choices(words, k=random.choice([3, 60, 300]))
        yield " ".join(base)
        for _ in range(texts // 20):
            copy = list(base)
            for _ in range(random.randint(0, 2)):
                copy[random.randrange(len(copy))] = random.choice(words)
            yield " ".join(copy)


def test_all_pairs(spark):
    texts = [*near(160), None, "", " \t\n", "ÀB Cd", "àb cd", "Àb cD", "x" * 50_000]
    rows = [(i * 3, text, "f", 1, 2) for i, text in enumerate(texts)]
    found = by_id(simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)), "doc_id", "fingerprint", "component_id")
    prints = {i: plain(text) for i, text, *_ in rows}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    smallest = reach(prints, links)
    assert found == {i: (f"{prints[i]:016x}", smallest[i]) for i in prints}
    assert len(set(smallest.values())) < len(texts)


def test_parts_of_large_cells_lose_no_link(spark):
    random.seed(4)
    centre = random.getrandbits(64)
    values = {centre}
    while len(values) < 120:
        value = centre
        for bit in random.sample(range(64), random.randint(1, 5)):
            value ^= 1 << bit
        values.add(value)
    values = sorted(values)
    signed = [value - (1 << 64) if value >> 63 else value for value in values]
    points = spark.createDataFrame(list(enumerate(signed)), "node bigint, fp bigint")
    reached = by_id(components(spark, simhash.links(spark, points, cell=10)), "node", "component")
    links = [(a, b) for a in range(120) for b in range(a) if (values[a] ^ values[b]).bit_count() <= 4]
    expected = reach(range(120), links)
    assert {node: reached.get(node, (node,))[0] for node in range(120)} == expected


def test_repeated_and_missing_ids(spark):
    rows = [(5, "a b c d e", "", 0, 0), (5, "a b c d e", "", 0, 0), (None, "a b c d e", "", 0, 0), (3, "a b c d e", "", 0, 0)]
    found = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r["doc_id"]), r["component_id"]) for r in found) == [("3", 3), ("5", 3), ("5", 3), ("None", None)]
    kept = simhash.one_of_each(spark.createDataFrame([*rows, (9, "q", "z", 1, 1), (9, "q", "z", 1, 1)], SCHEMA))
    assert sorted((str(r["doc_id"]), r["fp"]) for r in kept.collect()) == [("3", ""), ("9", "z")]
    without = simhash.one_of_each(spark.createDataFrame([(None, "a b c d e", "", 0, 0)] * 3 + [(None, "q r s t u v", "", 0, 0)], SCHEMA))
    assert without.count() == 2


def test_unlike_texts_under_one_id(spark):
    random.seed(7)
    texts = [" ".join(random.choices([f"w{i}" for i in range(400)], k=200)) for _ in range(5)]
    a, b, *others = texts
    near = b.upper()  # another text of the same fingerprint
    rows = [(5, a, "A", 0, 0), (5, b, "B", 0, 0), (3, near, "B'", 0, 0), *((7, text, text[:9], 0, 0) for text in others)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = simhash.near_duplicates(docs).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in found) == [(3, 3), (5, 3), (5, 5), (7, 7), (7, 7), (7, 7)]
    kept = [(r["doc_id"], r["fp"]) for r in simhash.one_of_each(docs).collect()]
    assert sorted(kept) == sorted([(5, "A"), (3, "B'"), *((7, text[:9]) for text in others)])


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_of_each(empty).count() == 0


def test_every_near_pair_shares_a_grid():
    random.seed(1)
    masks = [mask % (1 << 64) for mask in simhash.block_masks(simhash.BLOCKS, 4)]
    assert len(masks) == 35
    ones = lambda x: tuple((x >> i & 3).bit_count() for i in range(0, 64, 2))
    for _ in range(300):
        a = random.getrandbits(64)
        b = a
        for bit in random.sample(range(64), 4):
            b ^= 1 << bit
        inside = lambda x, mask: [n for i, n in enumerate(ones(x)) if mask >> 2 * i & 3]
        assert any(inside(a, mask) == inside(b, mask) for mask in masks)


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_components(spark, shape):
    random.seed(3)
    links = {
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(50, i) for i in range(100) if i != 50],
        "random": [(random.randrange(150), random.randrange(150)) for _ in range(110)],
    }[shape]
    random.shuffle(links)
    found = components(spark, spark.createDataFrame([*links, links[0], (7, None), (None, None)], "a bigint, b bigint"))
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert by_id(found, "node", "component") == {k: (v,) for k, v in reach(nodes, [x for x in links if x[0] != x[1]]).items()}


def test_groups_end_where_the_key_changes(spark, monkeypatch):
    monkeypatch.setattr(cells, "GATHERED", 3)
    rows = spark.createDataFrame([(i // 4, i) for i in range(40)], "cell bigint, node bigint")
    tables = [t.to_batches() for t in [cells.dealt(rows).coalesce(1).toArrow()]][0]
    groups = [g for batch in tables for g in cells.whole_groups(iter([batch.slice(i, 1) for i in range(batch.num_rows)]))]
    assert sum(g.table.num_rows for g in groups) == 40 and all(g.table.num_rows % 4 == 0 for g in groups)
