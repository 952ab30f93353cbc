"""Second moments of many columns in one pass, and what can be solved from them.

Least squares, ridge, lasso, principal components and backward elimination over
time-ordered folds need nothing of the data but the cross-product matrix of each
block.  One distributed pass makes these matrices (features squared in size, a
few kilobytes); every fit of a parameter grid is then a small solve.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebars.operators.features import scale_moments
from tidebars.session import stage


def _cross_products(columns: list[str], by: str, shift: np.ndarray, scale: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for batch in batches:
            for key, part in batch.groupby(by, sort=False):
                z = np.ones((len(part), len(columns) + 1))
                z[:, 1:] = (part[columns].to_numpy(dtype=float) - shift) / scale
                sums[key] = sums.get(key, 0.0) + z.T @ z
        for key, total in sums.items():
            yield pd.DataFrame({by: key, "cell": np.arange(total.size), "part": total.ravel()})

    return run


@dataclass(frozen=True)
class Moments:
    """Cross products of ``[1, columns]`` per block, in units of ``shift`` and ``scale``."""

    columns: list[str]
    blocks: dict
    shift: np.ndarray
    scale: np.ndarray

    @property
    def target_zero(self) -> float:
        """The value 0 of the last column in these units."""
        return float(-self.shift[-1] / self.scale[-1])


def moments(df: DataFrame, columns: list[str], by: str) -> Moments:
    """One cross-product matrix per value of ``by``; rows with a NULL are left out.

    Columns are first brought to mean 0 and deviation 1 (over all rows), so that
    sums of squares of prices do not swallow their differences.
    """
    complete = df.select(by, *[F.col(c).cast("double") for c in columns]).na.drop()
    known = scale_moments(complete, columns)
    shift = np.array([known[c][0] or 0.0 for c in columns])
    scale = np.array([known[c][1] or 1.0 for c in columns])
    kind = dict(complete.dtypes)[by]
    parts = complete.mapInPandas(
        _cross_products(columns, by, shift, scale), f"{by} {kind}, cell int, part double"
    )
    size = len(columns) + 1
    blocks: dict = {}
    for key, cell, total in parts.groupBy(by, "cell").agg(F.sum("part")).collect():
        blocks.setdefault(key, np.zeros(size * size))[cell] = total
    return Moments(columns, {k: v.reshape(size, size) for k, v in blocks.items()}, shift, scale)


@dataclass(frozen=True)
class Fit:
    """Coefficients over ``[1, features]`` in the units of the moments."""

    weights: np.ndarray
    n_used: int


def _standardised(gram: np.ndarray, features: list[int]):
    """Correlation-scale system of the given features (last column: target)."""
    n = gram[0, 0]
    mean = gram[0] / n
    cov = gram / n - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(cov), 0.0))
    sd[sd < 1e-12] = 1.0
    a = cov[np.ix_(features, features)] / np.outer(sd[features], sd[features])
    b = cov[features, -1] / sd[features]
    return a, b, sd, mean, n


def _fit_from(beta: np.ndarray, gram, features, sd, mean, level: float | None) -> Fit:
    """Undo the scaling.  The features are centred before the fit, so the fitted
    level is the mean of the target; without an intercept it is the given one."""
    weights = np.zeros(gram.shape[0] - 1)
    weights[features] = beta / sd[features]
    offset = mean[-1] if level is None else level
    weights[0] = offset - float(weights[features] @ mean[features])
    return Fit(weights, len(features))


def solve_linear(gram: np.ndarray, features: list[int], level: float | None = None) -> Fit:
    a, b, sd, mean, _ = _standardised(gram, features)
    return _fit_from(np.linalg.lstsq(a, b, rcond=1e-12)[0], gram, features, sd, mean, level)


def solve_ridge(gram: np.ndarray, features: list[int], alpha: float) -> Fit:
    """Minimises |y - Xw|^2 + alpha |w|^2 over scaled features."""
    a, b, sd, mean, n = _standardised(gram, features)
    beta = np.linalg.solve(a + np.eye(len(features)) * alpha / n, b)
    return _fit_from(beta, gram, features, sd, mean, None)


def solve_lasso(gram: np.ndarray, features: list[int], alpha: float, sweeps: int = 1000, tol: float = 1e-7) -> Fit:
    """Minimises |y - Xw|^2 / 2n + alpha |w|_1 by coordinate descent."""
    return solve_lassos(gram, features, [alpha], sweeps, tol)[0]


def solve_lassos(gram: np.ndarray, features: list[int], alphas: list[float], sweeps: int = 1000, tol: float = 1e-7) -> list[Fit]:
    """:func:`solve_lasso` for many penalties, all stepped together."""
    a, b, sd, mean, _ = _standardised(gram, features)
    alpha = np.asarray(alphas, float)
    beta, left = np.zeros((len(features), len(alpha))), np.repeat(b[:, None], len(alpha), axis=1)
    for _ in range(sweeps):
        largest = 0.0
        for j in range(len(features)):
            if a[j, j] <= 0:
                continue
            pull = left[j] + a[j, j] * beta[j]
            move = np.sign(pull) * np.maximum(np.abs(pull) - alpha, 0.0) / a[j, j] - beta[j]
            if move.any():
                left -= a[:, j, None] * move
                beta[j] += move
                largest = max(largest, float(np.abs(move).max()))
        if largest < tol:
            break
    return [_fit_from(column, gram, features, sd, mean, None) for column in beta.T]


class OncePerBlock:
    """``work`` of a cross-product matrix and features, done once for each matrix: grids ask for the same one again and again."""

    def __init__(self, work):
        self.work, self.known = work, {}

    def __call__(self, gram: np.ndarray, features: list[int]):
        key = (gram.tobytes(), tuple(features))
        if key not in self.known:
            self.known[key] = self.work(gram, features)
        return self.known[key]


def _principal(gram: np.ndarray, features: list[int]):
    """The scaled system of :func:`_standardised` with its principal components, largest first."""
    a, b, sd, mean, n = _standardised(gram, features)
    values, vectors = np.linalg.eigh(a)
    order = np.argsort(values)[::-1]
    return values[order], vectors[:, order], b, sd, mean, n


def solve_pca(gram: np.ndarray, features: list[int], components: int, solver: str = "linear", alpha: float = 0.0, level: float | None = None,
              principal=_principal) -> Fit:
    """Regression on the leading principal components of the scaled features."""
    values, vectors, b, sd, mean, n = principal(gram, features)
    values, vectors = np.maximum(values[:components], 1e-15), vectors[:, :components]
    pull = vectors.T @ b  # components are orthogonal: one equation each
    if solver == "ridge":
        gamma = pull / (values + alpha / n)
    elif solver == "lasso":
        gamma = np.sign(pull) * np.maximum(np.abs(pull) - alpha, 0.0) / values
    else:
        gamma = pull / values
    fit = _fit_from(vectors @ gamma, gram, features, sd, mean, level)
    return Fit(fit.weights, components)


GROUP = 64  # triangles combined in one task


def triangle(df: DataFrame, columns: list[str], shift: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """The triangular factor of ``[1, columns]`` over complete rows, in units of ``shift`` and ``scale``.

    Every task reduces its rows to one small triangle; triangles are stacked and reduced in groups of GROUP, level by level, until one is
    left.  Unlike cross products this doesn't square the condition of the columns.
    """
    k = len(columns) + 1

    def reduced(z: np.ndarray) -> np.ndarray:
        out = np.zeros((k, k))
        r = np.linalg.qr(z, mode="r")
        out[:len(r)] = r
        return out

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, k))
        for batch in batches:
            z = np.column_stack([np.ones(batch.num_rows), *[c.to_numpy(zero_copy_only=False) for c in batch.columns]])
            z[:, 1:] = (z[:, 1:] - shift) / scale
            r = reduced(np.concatenate([r, z]))
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([r.ravel().tolist()])], names=["part", "r"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        r = reduced(np.concatenate([np.asarray(x, float).reshape(-1, k) for x in pdf["r"]]))
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0]) // GROUP], "r": [r.ravel().tolist()]})

    complete = df.select(*[F.col(c).cast("double") for c in columns]).na.drop()
    parts = stage(complete.mapInArrow(rows, "part bigint, r array<double>"))
    while (left := parts.count()) > 1:
        high = parts.agg(F.max("part")).first()[0]
        parts = parts.groupBy(F.expr(f"part div {GROUP}").alias("_to")).applyInPandas(merge, "part bigint, r array<double>")
        parts = stage(parts) if high >= GROUP or left > GROUP else parts
        if high < GROUP:
            break
    row = parts.first()
    return np.zeros((k, k)) if row is None else np.asarray(row["r"], float).reshape(k, k)


def independent(r: np.ndarray, features: list[int], exact: float = 1e-12) -> list[int]:
    """Of columns ``features`` of a triangle, in order, those that are neither constant nor given by the constant and the kept ones before."""
    kept: list[int] = [0]
    for j in features:
        own = np.linalg.norm(r[1:, j])  # without what the constant explains
        if own <= exact * max(1.0, np.linalg.norm(r[:, j])):
            continue
        rest = np.linalg.qr(r[:, [*kept, j]], mode="r")[len(kept), len(kept)]
        if abs(rest) > exact * np.linalg.norm(r[:, j]):
            kept.append(j)
    return kept[1:]


def eliminate(gram: np.ndarray, features: list[int], keep: int) -> tuple[list[int], dict[int, int]]:
    """Drop the feature with the smallest scaled coefficient until ``keep`` are
    left.  Returns them and the ranks (1 for kept, 2 for the last one dropped)."""
    left, dropped = list(features), []
    while len(left) > keep:
        a, b, *_ = _standardised(gram, left)
        beta = np.linalg.lstsq(a, b, rcond=1e-12)[0]
        dropped.append(left.pop(int(np.argmin(np.abs(beta)))))
    ranks = {f: 1 for f in left}
    ranks.update({f: 2 + i for i, f in enumerate(reversed(dropped))})
    return left, ranks


def residual_squares(gram: np.ndarray, fit: Fit) -> float:
    """Sum of squared residuals of a fit over the rows behind ``gram``."""
    w = np.append(fit.weights, -1.0)
    return float(max(w @ gram @ w, 0.0))


def bic_score(gram: np.ndarray, fit: Fit, n_columns: int, unit: float = 1.0) -> float:
    """Negated n ln(RSS/n) + k ln n with k = columns + 1 (greater is better).

    ``unit`` is the size of the target's unit in the moments: the score is that of the data.
    """
    n = gram[0, 0]
    rss = max(residual_squares(gram, fit) * unit * unit, 1e-300)
    return -(n * np.log(rss / n) + (n_columns + 1) * np.log(n))
