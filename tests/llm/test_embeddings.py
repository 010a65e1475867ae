"""Links and components against all pairs."""

from __future__ import annotations

import numpy as np
import pytest
from brute import by_id, reach

from feedloom.llm import cells, embeddings

SCHEMA = "vec_id bigint, embedding array<float>, label int, node int, cell string"


def vectors(n, dimension=24):
    random = np.random.default_rng(5)
    centres = random.standard_normal((n // 6, dimension))
    rows = [centres[i % len(centres)] + random.standard_normal(dimension) * random.choice([0.02, 0.1, 0.3]) for i in range(n)]
    rows += [centres[0] * 5] * 3
    return np.array(rows, np.float32)


@pytest.mark.parametrize("size", [cells.CELL, 12])
def test_all_pairs(spark, size, monkeypatch):
    monkeypatch.setattr(embeddings, "PER_CELL", 16)
    given = vectors(300)
    rows = [(2 * i, [float(x) for x in v], 0, 0, "") for i, v in enumerate(given)]
    real = embeddings.dealt
    monkeypatch.setattr(embeddings, "dealt", lambda *args: real(*args, size=size))
    found = by_id(embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA), recall=1 - 1e-9), "vec_id", "n_links", "component_id", "kept")
    unit = given.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    links = [(2 * a, 2 * b) for a, b in zip(*np.nonzero(near), strict=True) if a < b]
    smallest = reach([2 * i for i in range(len(given))], links)
    assert found == {2 * i: (int(near[i].sum()) - 1, smallest[2 * i], smallest[2 * i] == 2 * i) for i in range(len(given))}
    assert len(links) > 200


def test_windows_lose_no_pair():
    units = vectors(400, 12).astype(np.float64)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    a, b = np.nonzero(units @ units.T >= 0.95)
    assert len(embeddings.Windows(units, 0.95).passing(a, b)) == len(a)


def test_recall_of_the_plan():
    random = np.random.default_rng(1)
    projections, tables = embeddings.cell_plan(1_000_000)
    u = random.standard_normal((2000, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    side = random.standard_normal(u.shape)
    side -= (side * u).sum(axis=1, keepdims=True) * u
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    v = 0.95 * u + np.sqrt(1 - 0.95**2) * side
    across = embeddings.directions(64, projections * tables)
    same = ((u @ across > 0) == (v @ across > 0)).reshape(-1, tables, projections).all(axis=2).any(axis=1)
    assert same.mean() > 0.995


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, None]),
        (8, [1.0]), (9, [1e30, 0.0]), (None, [1.0, 0.0]), (2, [2.0, 0.0]), (10, []), (11, [-1.0, 0.0]), (12, [0.0, 0.0]),
    ]
    frame = spark.createDataFrame([(i, v, 0, 0, "") for i, v in rows], SCHEMA)
    found = sorted(map(str, map(tuple, embeddings.near_duplicates(frame).collect())))
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 10, 11, 12)]
    linked = [(1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (9, 3, 1, False), (None, 0, None, False)]
    assert found == sorted(map(str, alone + linked))
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0
