"""Comparing the rows of a cell with each other, whatever the size of the cell."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a cell that are compared in one go; larger cells are dealt out in pairs of parts of about this size.
CELL = 4096
#: Rows that a task gathers, whole groups only, before it compares them.
GATHERED = 100_000


def dealt(cells: DataFrame, *columns: str, size: int = CELL) -> DataFrame:
    """Rows (``cell``, ``node``, ``columns``) as groups (``cell``, ``one``, ``two``) of bounded size, sorted by group.

    A cell of at most ``size`` rows is one group. A larger one is cut by a hash
    of its nodes into parts, and each pair of parts is a group of its own, so no
    task holds a whole large cell and no pair of rows is left out: rows of
    unlike parts (``own``) meet in the group of the two, rows of one part in
    that part's own group.
    """
    large = cells.groupBy("cell").count().where(F.col("count") > size)
    large = large.select("cell", F.ceil(F.col("count") / size).cast("int").alias("parts"))
    parts = F.coalesce("parts", F.lit(1))
    own = F.pmod(F.xxhash64("node"), parts).cast("int")
    return (
        cells.join(large, "cell", "left")
        .select("cell", "node", *columns, own.alias("own"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
        .select("cell", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "own", "node", *columns)
        .repartition("cell", "one", "two")
        .sortWithinPartitions("cell", "one", "two")
    )


class Groups:
    """Whole groups of dealt rows, one after another: their columns, and ``group``, which numbers them in order."""

    def __init__(self, table: pa.Table):
        self.table = table
        self.one, self.two, self.own = (table.column(name).to_numpy() for name in ("one", "two", "own"))
        self.node = table.column("node").to_numpy()
        self.group = np.concatenate([[0], np.cumsum(_breaks(table))])[: table.num_rows]

    def pairs(self, order: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs of a group that it is to compare, as arrays of places in ``order``, which keeps groups together."""
        group, one, two, own = self.group[order], self.one[order], self.two[order], self.own[order]
        left, step = np.arange(len(order)), 0
        while len(left):
            step += 1
            left = left[left + step < len(order)]
            left = left[group[left] == group[left + step]]
            meet = left[(one[left] == two[left]) | (own[left] != own[left + step])]
            yield meet, meet + step


def _breaks(table: pa.Table) -> np.ndarray:
    keys = np.stack([table.column(name).to_numpy().astype(np.int64) for name in ("cell", "one", "two")])
    return (keys[:, 1:] != keys[:, :-1]).any(axis=0)


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[Groups]:
    """The dealt rows of a task, some whole groups at a time."""
    kept, rows = [], 0
    for batch in batches:
        kept.append(batch)
        rows += batch.num_rows
        if rows >= GATHERED:
            table = pa.Table.from_batches(kept)
            new = np.flatnonzero(_breaks(table))
            cut = int(new[-1]) + 1 if len(new) else 0
            if cut:
                yield Groups(table.slice(0, cut))
            kept, rows = table.slice(cut).combine_chunks().to_batches(), table.num_rows - cut
    if rows:
        yield Groups(pa.Table.from_batches(kept))


class Forest:
    """A spanning forest of the links that it is shown."""

    def __init__(self, n: int):
        self._parent = np.arange(n)
        self.low: list[int] = []
        self.high: list[int] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        apart = self._roots(a) != self._roots(b)
        for x, y in zip(a[apart].tolist(), b[apart].tolist(), strict=True):
            p, q = self._root(x), self._root(y)
            if p != q:
                self._parent[max(p, q)] = min(p, q)
                self.low.append(x)
                self.high.append(y)

    def ends(self, node: np.ndarray) -> np.ndarray:
        """Its links as two rows of nodes, the smaller one first."""
        ends = node[np.array([self.low, self.high], np.int64).reshape(2, -1)]
        return np.sort(ends, axis=0)

    def _roots(self, of: np.ndarray) -> np.ndarray:
        found = self._parent[of]
        while (further := self._parent[found] != found).any():
            found[further] = self._parent[found[further]]
        self._parent[of] = found
        return found

    def _root(self, x: int) -> int:
        while self._parent[x] != x:
            x = int(self._parent[x])
        return x
