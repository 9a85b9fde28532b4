"""A metric index: boxes over coordinates from which distances can be bounded without being computed.

A distance is a sum of terms. A term that is the difference of two numbers is
bounded by their coordinate itself; one that is a metric on vectors by
coordinates that are distances to pivots, of which the largest difference
counts (triangle inequality). An item is an interval in each coordinate.
Items are filed under the leaves of a k-d tree, which a bounded sample of them
decides, and a leaf has the exact box of all of its items, so what is bounded
away from a leaf's box is bounded away from each of its items.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Items of the sample that decides the tree, items of it in a leaf, most levels of the tree, and levels below the nodes whose boxes are looked at first.
SAMPLE, LEAF, DEPTH, BELOW = 100_000, 16, 12, 6
#: Share by which bounds are lowered against rounding.
SLACK = 1e-9


def lo(name: str) -> str:
    return f"{name}__lo"


def hi(name: str) -> str:
    return f"{name}__hi"


def gap(name: str, a: str = "a", b: str = "b") -> Column:
    """Distance of two intervals in a coordinate; 0 where one is null."""
    return F.greatest(F.col(f"{a}.{lo(name)}") - F.col(f"{b}.{hi(name)}"), F.col(f"{b}.{lo(name)}") - F.col(f"{a}.{hi(name)}"), F.lit(0.0))


def bound(terms: list[list[str]], a: str = "a", b: str = "b") -> Column:
    """What the distance of two items is at least. terms: the coordinates of each term."""
    total = F.lit(0.0)
    for names in terms:
        total = total + (F.greatest(*[gap(n, a, b) for n in names]) if len(names) > 1 else gap(names[0], a, b))
    return total * (1 - SLACK)


@dataclass
class Index:
    """The tree's splits and the leaves' boxes; of the size of the tree, whatever the number of items."""

    terms: list[list[str]]
    axis: np.ndarray
    at: np.ndarray
    leaves: np.ndarray
    counts: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @property
    def names(self) -> list[str]:
        return [n for names in self.terms for n in names]

    def leaf(self) -> Column:
        """The leaf of a row with this index's coordinates."""
        axis, at = self.axis, self.at

        @F.pandas_udf("int")
        def found(middle: pd.DataFrame) -> pd.Series:
            return pd.Series(descend(middle.to_numpy(float), axis, at))

        return found(_middle(self.names))

    def near_leaves(self, first: int = 0, limit: Column | None = None) -> Column:
        """Without a limit the nearest leaves, until they hold ``first`` items; with one those within it.

        Leaves are looked at under the nodes, ``BELOW`` levels up, that can have such.
        """
        bounded = limit is not None  # the function must not hold the column
        order = np.argsort(self.leaves, kind="stable")
        low, high, leaves, counts, starts = self.low[order], self.high[order], self.leaves[order], self.counts[order], np.cumsum([0, *[len(t) for t in self.terms]])[:-1]
        _, begin = np.unique(leaves >> BELOW, return_index=True)
        sizes = np.diff(np.append(begin, len(leaves)))
        wide_low, wide_high = (f.reduceat(x, begin, axis=0) if len(leaves) else x for f, x in ((np.minimum, low), (np.maximum, high)))
        held = np.add.reduceat(counts, begin) if len(leaves) else counts

        def apart(row: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            gaps = np.nan_to_num(np.maximum(np.maximum(row[: low.shape[1]] - high, low - row[low.shape[1] : 2 * low.shape[1]]), 0), nan=0.0)
            return np.maximum.reduceat(gaps, starts, axis=1).sum(axis=1) * (1 - SLACK)

        def nearest(away: np.ndarray, counts: np.ndarray) -> np.ndarray:
            order = np.argsort(away, kind="stable")
            return order[np.cumsum(counts[order]) - counts[order] < first]

        @F.pandas_udf("array<int>")
        def found(box: pd.DataFrame) -> pd.Series:
            values, out = box.to_numpy(float), []
            for row in values:
                nodes = apart(row, wide_low, wide_high)
                under = lambda chosen: np.flatnonzero(np.repeat(chosen, sizes))
                if bounded:
                    some = under(nodes <= row[-1])
                    some = some[apart(row, low[some], high[some]) <= row[-1]]
                elif len(nodes):
                    # what the nearest nodes hold says how far the leaves can be that count
                    near = np.isin(np.arange(len(nodes)), nearest(nodes, held))
                    some = under(near)
                    away = apart(row, low[some], high[some])
                    some = under(near | (nodes < away[nearest(away, counts[some])].max(initial=0)))
                    some = some[nearest(apart(row, low[some], high[some]), counts[some])]
                else:
                    some = leaves
                out.append(leaves[some].astype(np.int32))
            return pd.Series(out, dtype=object)

        ends = [F.col(end(n)).cast("double").alias(end(n)) for end in (lo, hi) for n in self.names]
        return found(F.struct(*ends, *([] if limit is None else [limit.cast("double").alias("limit")])))


def _middle(names: list[str]) -> Column:
    return F.struct(*[F.coalesce((F.col(lo(n)) + F.col(hi(n))) / 2, F.lit(0.0)).alias(n) for n in names])


def descend(points: np.ndarray, axis: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Leaf numbers of points: node i has the children 2 i + 1 and 2 i + 2."""
    node = np.zeros(len(points), np.int64)
    for _ in range(int(np.log2(len(axis) + 1))):
        right = points[np.arange(len(points)), axis[node]] > at[node]
        node = 2 * node + 1 + right
    return node - len(axis)


def plant(points: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Splits of a complete tree at medians of the widest coordinate."""
    axis, at = np.zeros(2**depth - 1, np.int64), np.zeros(2**depth - 1)
    held = {0: points}
    for i in range(len(axis)):
        mine = held.pop(i)
        if len(mine):
            axis[i] = np.argmax(mine.max(0) - mine.min(0))
            at[i] = np.median(mine[:, axis[i]])
        right = mine[:, axis[i]] > at[i]
        held[2 * i + 1], held[2 * i + 2] = mine[~right], mine[right]
    return axis, at


def build(items: DataFrame, terms: list[list[str]], sample: int = SAMPLE) -> tuple[Index, DataFrame]:
    """(index, items with their leaf). items: <name>__lo and <name>__hi of each coordinate."""
    names = [n for t in terms for n in t]
    some = items.select(_middle(names).alias("m"))
    points = some.orderBy(F.xxhash64("m")).limit(sample).select("m.*").toPandas().to_numpy(float).reshape(-1, len(names))
    axis, at = plant(points, max(0, min(DEPTH, int(np.log2(max(1, len(points) / LEAF))))))
    index = Index(terms, axis, at, *[np.zeros(0)] * 4)
    filed = items.withColumn("leaf", index.leaf())
    box = lambda c, f, far: F.coalesce(F.when(F.count_if(F.col(c).isNull()) == 0, f(c)), F.lit(far)).cast("double").alias(c)
    inf = float("inf")
    rows = filed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), *[box(lo(n), F.min, -inf) for n in names], *[box(hi(n), F.max, inf) for n in names]).toPandas()  # one row a leaf
    index.leaves, index.counts = rows["leaf"].to_numpy(), rows["n"].to_numpy()
    index.low, index.high = rows[[lo(n) for n in names]].to_numpy(float), rows[[hi(n) for n in names]].to_numpy(float)
    return index, filed
