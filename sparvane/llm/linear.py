"""Sparse logistic regression on hashed features, in numpy: proximal gradient with momentum."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x, dtype=np.float64)))


#: Entries of a step of the sums below; their temporary arrays are no larger.
STEP = 1 << 20


def _sums(at: np.ndarray, weights: Callable[[slice], np.ndarray], n: int) -> np.ndarray:
    """Sums of the entries' weights by ``at``, in order of the entries."""
    out = np.zeros(n)
    for first in range(0, len(at), STEP):
        part = slice(first, first + STEP)
        out += np.bincount(at[part], weights(part), minlength=n)
    return out


class Rows:
    """Sparse rows over features that enough rows have; entries in order of their rows."""

    def __init__(self, features: list[np.ndarray], values: list[np.ndarray] | None, least_rows: int) -> None:
        flat = np.concatenate(features) if features else np.zeros(0, np.int64)
        names, column = np.unique(flat, return_inverse=True)
        keep = np.bincount(column, minlength=len(names)) >= least_rows
        mask = keep[column]
        row = np.repeat(np.arange(len(features), dtype=np.int32), [len(f) for f in features])
        value = np.concatenate(values)[mask] if values else None
        self._set(len(features), names[keep], row[mask], (np.cumsum(keep) - 1)[column[mask]].astype(np.int32), value)

    def _set(self, n: int, names: np.ndarray, row: np.ndarray, column: np.ndarray, value: np.ndarray | None) -> None:
        #: value: None where all are 1
        self.n, self.names, self.row, self.column, self.value = n, names, row, column, value

    @classmethod
    def indexed(cls, counts: np.ndarray, columns: np.ndarray, names: np.ndarray) -> Rows:
        """Rows of ones: the places in names of each row's features, one row after the other."""
        self = cls.__new__(cls)
        self._set(len(counts), names, np.repeat(np.arange(len(counts), dtype=np.int32), counts), columns, None)
        return self

    def only(self, keep: np.ndarray) -> Rows:
        """The same rows with the features where keep is true; made step by step, so that nothing else is as large."""
        out = Rows.__new__(Rows)
        new = (np.cumsum(keep) - 1).astype(np.int32)
        parts = [slice(first, first + STEP) for first in range(0, len(self.column), STEP)]
        n = sum(int(np.count_nonzero(keep[self.column[p]])) for p in parts)
        row, column = np.empty(n, self.row.dtype), np.empty(n, np.int32)
        value = None if self.value is None else np.empty(n, self.value.dtype)
        at = 0
        for p in parts:
            mask = keep[self.column[p]]
            to = slice(at, at + int(np.count_nonzero(mask)))
            row[to], column[to] = self.row[p][mask], new[self.column[p][mask]]
            if value is not None:
                value[to] = self.value[p][mask]
            at = to.stop
        out._set(self.n, self.names[keep], row, column, value)
        return out

    def weigh(self, part: slice, x: np.ndarray) -> np.ndarray:
        return x if self.value is None else self.value[part] * x

    def dot(self, w: np.ndarray) -> np.ndarray:
        return _sums(self.row, lambda p: self.weigh(p, w[self.column[p]]), self.n)

    def transposed_dot(self, r: np.ndarray, absolute: bool = False) -> np.ndarray:
        out = lambda p: self.weigh(p, r[self.row[p]])
        return _sums(self.column, (lambda p: np.abs(out(p))) if absolute else out, len(self.names))

    def absolutes(self) -> np.ndarray:
        return _sums(self.row, lambda p: np.abs(self.weigh(p, np.ones(len(self.row[p])))), self.n)

    def squares(self) -> np.ndarray:
        return _sums(self.row, lambda p: np.ones(len(self.row[p])) if self.value is None else self.value[p] ** 2, self.n)


def _with_bias(rows: Rows, dense: np.ndarray) -> np.ndarray:
    return np.column_stack([dense, np.ones(rows.n)]) if dense.size else np.ones((rows.n, 1))


def fit(rows: Rows, y: np.ndarray, sample: np.ndarray, dense: np.ndarray, l1: float, l2: float, steps: int = 150, scaled: bool = False, start: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(weights of rows.names, weights of the dense columns and the bias) for soft labels y over the rows where sample is true.

    scaled: each weight has its own rate, by its part in the rows' sums of
    absolute values, which bounds the curvature; rare features then move as
    fast as frequent ones.
    """
    x = _with_bias(rows, dense)
    m = max(1, int(sample.sum()))
    w, v = start or (np.zeros(len(rows.names)), np.zeros(x.shape[1]))
    wy, vy, t = w.copy(), v.copy(), 1.0
    rate: np.ndarray | float
    if scaled:
        size = np.where(sample, rows.absolutes() + np.abs(x).sum(axis=1), 0.0)
        rate, dense_rate = (4.0 * m / np.maximum(c, 1e-9) for c in (rows.transposed_dot(size, absolute=True), np.abs(x).T @ size))
    else:
        norms = rows.squares() + (x**2).sum(axis=1)
        rate = dense_rate = 4.0 / max(1e-9, float(np.percentile(norms, 90))) if rows.n else 1.0
    for _ in range(steps):
        r = np.where(sample, sigmoid(rows.dot(wy) + x @ vy) - y, 0.0) / m
        new_w = wy - rate * (rows.transposed_dot(r) + l2 * wy)
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - rate * l1, 0)
        new_v = vy - dense_rate * (x.T @ r)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        wy, vy = new_w + (t - 1) / t2 * (new_w - w), new_v + (t - 1) / t2 * (new_v - v)
        still = max(np.abs(new_w - w).max(initial=0.0), np.abs(new_v - v).max(initial=0.0))
        w, v, t = new_w, new_v, t2
        if still < 1e-5:
            break
    return w, v


#: A feature joins the set where its gradient exceeds the penalty by this factor.
SLACK = 1.05


def fit_few(rows: Rows, y: np.ndarray, sample: np.ndarray, dense: np.ndarray, l1: float, steps: int = 150, more: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """What fit looks for, where the penalty leaves few weights: it works on a set of features and looks at all of them between.

    A feature outside the set has weight 0, which is best as long as its
    gradient does not exceed the penalty; those where it does join, those
    that promise the most for their curvature first (the first of equal ones),
    ``more`` at a time, until there are none. One whose weight is then 0 leaves
    again, once. So no feature is left out that the penalty lets in.
    """
    x, m = _with_bias(rows, dense), max(1, int(sample.sum()))
    w, inside, joined = np.zeros(len(rows.names)), np.zeros(len(rows.names), bool), np.zeros(len(rows.names), int)
    curvature = np.maximum(rows.transposed_dot(sample.astype(float), absolute=True), 1e-9)
    few = rows.only(inside)
    own, v = fit(few, y, sample, dense, l1, 0.0, steps, scaled=True)
    while True:
        r = np.where(sample, sigmoid(few.dot(own) + x @ v) - y, 0.0) / m
        steep = np.abs(rows.transposed_dot(r))
        gain = np.where(inside | (steep <= l1 * SLACK), 0.0, (steep - l1) ** 2 / curvature)
        new = np.argsort(-gain, kind="stable")[:more]
        new = new[gain[new] > 0]
        if not len(new):
            return w, v
        inside[new] = True
        joined[new] += 1
        few = rows.only(inside)
        own, v = fit(few, y, sample, dense, l1, 0.0, steps, scaled=True, start=(w[inside], v))
        w[inside] = own
        inside = (w != 0) | (inside & (joined > 1))
        few = rows.only(inside)
        own = w[inside]


def screened(rows: Rows, y: np.ndarray, sample: np.ndarray, least: float) -> Rows:
    """rows with the features that depend on y, by a chi-squared of presence of ``least`` or more over the rows where sample is true."""
    with_feature = _sums(rows.column, lambda p: sample[rows.row[p]].astype(float), len(rows.names))
    hits = _sums(rows.column, lambda p: np.where(sample, y, 0.0)[rows.row[p]], len(rows.names))
    n, p = float(sample.sum()), float(y[sample].mean()) if sample.any() else 0.0
    spread = p * (1 - p) * with_feature * (1 - with_feature / max(n, 1.0))
    return rows.only(np.where(spread > 1e-12, (hits - with_feature * p) ** 2 / np.maximum(spread, 1e-12), 0.0) >= least)
