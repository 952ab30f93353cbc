"""Order search and forecast of differenced autoregressions with moving average, symbol by symbol.

Two-stage regression: residuals of a long autoregression stand in for the unseen shocks, then the series is regressed on its own
and their lags.  All differences share two passes over the chunked layout, each of which leaves one cross-product matrix per symbol and
difference; every order is a sub-system of it.  The matrices stay a table: a symbol's orders are solved in the task that
has its rows, a few hundred numbers whatever the length of its series.

A forecast is a linear map applied again and again, so a chunk of forecast rows starts from a power of that map and no symbol is
ever walked through from its first row to its last.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebars.operators.expr import F as X
from tidebars.operators.layout import CHUNK, POS, Series
from tidebars.session import stage

LONG = 12  # order of the long autoregression
TAIL = 256  # rows before the forecast over which the shocks are worked out again
SYMBOLS = 1000  # whose sums a task holds at once
ORDER = "symbol string, p int, d int, q int, n bigint, bic double, start double, ar array<double>, ma array<double>"


def _sizes(series: Series, value: str, train: float) -> DataFrame:
    """Per symbol: rows, rows of the training part, and its mean value, which the series is shifted by."""
    body = series.body().groupBy(series.symbol)
    sizes = stage(body.agg((F.max(POS) + 1).alias("_rows")).withColumn("_cut", F.floor(F.col("_rows") * F.lit(train)).cast("bigint")))
    early = _by_chunk(series, series.body().select(series.symbol, CHUNK, POS, F.col(value).cast("double").alias("_v")), sizes)
    centre = early.filter(F.col(POS) < F.col("_cut")).groupBy(series.symbol).agg(F.avg("_v").alias("_centre"))
    return stage(sizes.join(centre, series.symbol, "left").withColumn("_centre", F.coalesce("_centre", F.lit(0.0))))


def _by_chunk(series: Series, rows: DataFrame, table: DataFrame) -> DataFrame:
    """``rows`` joined with a table of a row per symbol, by symbol and chunk: long symbols stay spread over their chunks."""
    chunks = F.sequence(F.lit(0).cast("bigint"), F.expr(f"_rows div {series.chunk_rows}"))
    return rows.join(table.withColumn(CHUNK, F.explode(chunks)), [series.symbol, CHUNK])


def _differences(series: Series, sizes: DataFrame, value: str, d_values: Iterable[int], lags: int) -> Series:
    """The shifted series ``_w0``, its differences, and ``lags`` lags of those asked for."""
    series = replace(series, df=_by_chunk(series, series.df, sizes))
    series = series.add(_w0=X.col(value).cast("double") - X.col("_centre"))
    for d in range(max(d_values)):
        series = series.add(**{f"_w{d + 1}": X.col(f"_w{d}") - series.lag(f"_w{d}")})
    return series.add(**{f"_w{d}_{k}": series.lag(f"_w{d}", k) for d in d_values for k in range(1, lags + 1)})


def _products(sets: dict[int, list[str]], symbol: str):
    """Cross products of ``[1, columns]`` over complete rows, by symbol and set; the last column is the target."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for batch in batches:
            for name, part in batch.groupby(symbol, sort=False):
                for d, columns in sets.items():
                    z = part[columns].to_numpy(dtype=float)
                    z = z[~np.isnan(z).any(axis=1)]
                    z = np.concatenate([np.ones((len(z), 1)), z], axis=1)
                    sums[name, d] = sums.get((name, d), 0.0) + z.T @ z
            if len(sums) > SYMBOLS * len(sets):
                yield from _rows(sums)
                sums = {}
        yield from _rows(sums)

    return run


def _rows(sums: dict) -> Iterator[pd.DataFrame]:
    for (name, d), total in sums.items():
        yield pd.DataFrame({"symbol": name, "d": d, "cell": np.arange(total.size), "part": total.ravel()})


def _summed(df: DataFrame, sets: dict[int, list[str]], symbol: str) -> DataFrame:
    """``symbol, d, cell, part``: the matrices of :func:`_products`, added up."""
    needed = list(dict.fromkeys(c for columns in sets.values() for c in columns))
    parts = df.select(symbol, *needed).mapInPandas(_products(sets, symbol), "symbol string, d int, cell int, part double")
    return parts.groupBy("symbol", "d", "cell").agg(F.sum("part").alias("part"))


def _matrix(part: pd.DataFrame) -> np.ndarray:
    values = part.sort_values("cell")["part"].to_numpy()
    size = math.isqrt(len(values))
    return values.reshape(size, size)


def _least_squares(gram: np.ndarray, used: list[int]) -> tuple[np.ndarray, float]:
    """Weights of the constant and of columns ``used`` (from 1), and the sum of squared residuals."""
    n, at = gram[0, 0], used
    mean = gram[0] / n
    cov = gram - n * np.outer(mean, mean)
    weights = np.zeros(len(at) + 1)
    if at:
        scale = np.sqrt(np.maximum(np.diag(cov)[at], 0.0))
        live = scale > 1e-12 * max(1.0, np.sqrt(n))
        scale = np.where(live, scale, 1.0)
        a = cov[np.ix_(at, at)] / np.outer(scale, scale)
        a[~live], a[:, ~live] = 0.0, 0.0
        weights[1:] = np.linalg.lstsq(a, np.where(live, cov[at, -1] / scale, 0.0), rcond=1e-12)[0] / scale
    weights[0] = mean[-1] - weights[1:] @ mean[at]
    rest = cov[-1, -1] - 2 * weights[1:] @ cov[at, -1] + weights[1:] @ cov[np.ix_(at, at)] @ weights[1:]
    return weights, float(max(rest, 1e-300))


def _long_fits(pdf: pd.DataFrame) -> pd.DataFrame:
    """One symbol: weights of the long autoregression for each difference."""
    out = []
    for d, part in pdf.groupby("d"):
        gram = _matrix(part)
        weights = _least_squares(gram, list(range(1, len(gram) - 1)))[0] if gram[0, 0] > 0 else np.full(len(gram) - 1, np.nan)
        out.append((pdf["symbol"].iloc[0], d, weights.tolist()))
    return pd.DataFrame(out, columns=["symbol", "d", "weights"])


def _best_order(p_values: list[int], q_values: list[int]):
    """One symbol: the order of least BIC with its weights; of equal ones the first in (p, d, q)."""
    p_max, q_max = max(p_values), max(q_values)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        best = None
        for d, part in pdf.groupby("d"):
            gram = _matrix(part)
            n = int(round(gram[0, 0]))
            for p in p_values:
                for q in q_values:
                    if n <= p + q + 1:
                        continue
                    used = [*range(1, p + 1), *range(p_max + 1, p_max + q + 1)]
                    weights, rest = _least_squares(gram, used)
                    score = n * math.log(rest / n) + (p + q + 1) * math.log(n)
                    found = (score, p, d, q, n, weights)
                    if best is None or found[:4] < best[:4]:
                        best = found
        if best is None:
            return pd.DataFrame(columns=["symbol", "p", "d", "q", "n", "bic", "start", "ar", "ma"])
        score, p, d, q, n, w = best
        row = (pdf["symbol"].iloc[0], p, d, q, n, score, w[0], w[1:p + 1].tolist(), w[p + 1:].tolist())
        return pd.DataFrame([row], columns=["symbol", "p", "d", "q", "n", "bic", "start", "ar", "ma"])

    return run


class _Search:
    """The series with its lags and shocks, and the sizes, kept for the forecast."""

    def __init__(self, series: Series, value: str, p_values, d_values, q_values, train: float, long_order: int):
        self.p, self.d, self.q = sorted(p_values), sorted(d_values), sorted(q_values)
        self.value, symbol = value, series.symbol
        p_max, q_max = max(self.p), max(self.q)
        long_order = long_order if q_max else 0
        self.sizes = _sizes(series, value, train)
        lagged = _differences(series, self.sizes, value, self.d, max(p_max, long_order))
        if q_max:
            sets = {d: [*[f"_w{d}_{k}" for k in range(1, long_order + 1)], f"_w{d}"] for d in self.d}
            fits = _summed(self.early(lagged), sets, symbol).groupBy("symbol").applyInPandas(_long_fits, "symbol string, d int, weights array<double>")
            wide = fits.groupBy("symbol").agg(*[F.first(F.when(F.col("d") == d, F.col("weights")), True).alias(f"_long{d}") for d in self.d])
            wide = stage(wide.join(self.sizes.select(F.col(symbol).alias("symbol"), "_rows"), "symbol").withColumnRenamed("symbol", symbol))
            lagged = replace(lagged, df=_by_chunk(lagged, lagged.df.drop("_rows"), wide))
            for d in self.d:
                guess = X.col(f"_long{d}")[0]
                for k in range(1, long_order + 1):
                    guess = guess + X.col(f"_long{d}")[k] * X.col(f"_w{d}_{k}")
                lagged = lagged.add(**{f"_e{d}": X.col(f"_w{d}") - guess})
            lagged = lagged.add(**{f"_e{d}_{k}": lagged.lag(f"_e{d}", k) for d in self.d for k in range(1, q_max + 1)})
        self.series = lagged
        names = {d: [*[f"_w{d}_{k}" for k in range(1, p_max + 1)], *[f"_e{d}_{k}" for k in range(1, q_max + 1)], f"_w{d}"] for d in self.d}
        self.orders = stage(_summed(self.early(lagged), names, symbol).groupBy("symbol").applyInPandas(_best_order(self.p, self.q), ORDER))

    @staticmethod
    def early(series: Series) -> DataFrame:
        return series.body().filter(F.col(POS) < F.col("_cut"))


def ar_grid(series: Series, value: str = "close", p_values=range(6), d_values=range(3), q_values=range(6), train: float = 1.0,
            long_order: int = LONG) -> DataFrame:
    """``symbol, p, d, q, n, bic, start, ar, ma``: the order of least BIC and its weights, per symbol.

    Fitted on the first ``train`` part of each symbol's rows; ``n`` is the number of rows that have all lags.  The weights are those of the differenced
    series, for ``d = 0`` less the mean of the training part.  Symbols with too few rows for any order give no row.
    """
    return _Search(series, value, p_values, d_values, q_values, train, long_order).orders


def _map_of(d: int, start: float, ar: np.ndarray, ma: np.ndarray) -> np.ndarray:
    """The matrix that moves ``[1, last differences, last shocks, levels]`` one row on, the next shock being 0."""
    p, q = max(1, len(ar)), len(ma)
    size = 1 + p + q + d
    out = np.zeros((size, size))
    following = np.zeros(size)  # the next difference
    following[0] = start
    following[1:1 + len(ar)] = ar
    following[1 + p:1 + p + q] = ma
    out[0, 0] = 1.0
    out[1] = following
    for i in range(1, p):
        out[1 + i, i] = 1.0
    for j in range(1, q):
        out[1 + p + j, p + j] = 1.0
    above = following
    for k in range(d - 1, -1, -1):  # level k grows by what level k + 1 becomes
        above = above + np.eye(size)[1 + p + q + k]
        out[1 + p + q + k] = above
    return out


def _state(pdf: pd.DataFrame) -> pd.DataFrame:
    """One symbol: the map and the state at the end of its training part, from its last rows and its order."""
    pdf = pdf.sort_values("pos")
    one = pdf.iloc[0]
    d, ar, ma = int(one["d"]), np.asarray(one["ar"], float), np.asarray(one["ma"], float)
    w, shock = pdf[f"_w{d}"].to_numpy(float), pdf[f"_e{d}"].to_numpy(float).copy()
    known = ~np.isnan(w)
    w, shock = w[known], np.where(np.isnan(shock), 0.0, shock)[known]
    back = max(len(ar), len(ma))
    for t in range(back, len(w)):  # the model's own shocks, from the stand-ins on
        shock[t] = w[t] - one["start"] - sum(a * w[t - 1 - i] for i, a in enumerate(ar)) - sum(m * shock[t - 1 - j] for j, m in enumerate(ma))
    slots = max(1, len(ar))
    past, shocks = np.zeros(slots), np.zeros(len(ma))
    past[:min(slots, len(w))] = w[::-1][:slots]
    shocks[:min(len(ma), len(w))] = shock[::-1][:len(ma)]
    levels = [float(pdf[f"_w{k}"].iloc[-1]) for k in range(d)]
    state = np.concatenate([[1.0], past, shocks, levels])
    turn = _map_of(d, float(one["start"]), ar, ma)
    # the forecast is the shifted level: the first level, or the difference itself where there is none
    return pd.DataFrame([(one["symbol"], turn.ravel().tolist(), state.tolist(), 1 + slots + len(ma) if d else 1)],
                        columns=["symbol", "turn", "state", "place"])


def _walk(pdf: pd.DataFrame) -> pd.DataFrame:
    """Forecasts of one chunk: the first from a power of the map, the others one after the other."""
    pdf = pdf.sort_values("pos")
    one = pdf.iloc[0]
    state = np.asarray(one["state"], float)
    turn = np.asarray(one["turn"], float).reshape(len(state), len(state))
    out = np.empty(len(pdf))
    with np.errstate(over="ignore", invalid="ignore"):
        state = np.linalg.matrix_power(turn, int(one["ahead"]) - 1) @ state
        for i in range(len(pdf)):
            state = turn @ state
            out[i] = state[int(one["place"])]
    return pd.DataFrame({"symbol": pdf["symbol"], "date_time": pdf["date_time"], "forecast": out + one["_centre"]})


def ar_forecast(series: Series, value: str = "close", p_values=range(6), d_values=range(3), q_values=range(6), train: float = 0.7,
                until: float = 0.85, long_order: int = LONG) -> DataFrame:
    """``symbol, date_time, value, forecast, p, d, q``: the rows from ``train`` to ``until`` of each symbol, forecast from the end of the training part.

    The order and weights are those of :func:`ar_grid` on the training part; no value after it is used.
    """
    found = _Search(series, value, p_values, d_values, q_values, train, long_order)
    symbol, lagged = series.symbol, found.series
    shocks = {f"_e{d}": F.lit(None).cast("double") for d in found.d if f"_e{d}" not in lagged.df.columns}
    body = lagged.body().withColumns(shocks).withColumnsRenamed({symbol: "symbol", POS: "pos"})
    levels = [f"_w{k}" for k in range(max(found.d) + 1)]
    tail = body.filter((F.col("pos") < F.col("_cut")) & (F.col("pos") >= F.col("_cut") - TAIL)).select("symbol", "pos", *levels, *[f"_e{d}" for d in found.d])
    states = tail.join(found.orders, "symbol").groupBy("symbol").applyInPandas(  # at most TAIL rows a symbol
        _state, "symbol string, turn array<double>, state array<double>, place int")
    sizes = found.sizes.withColumnRenamed(symbol, "symbol")
    states = stage(states.join(sizes, "symbol"))
    rows = series.body().select(
        F.col(symbol).alias("symbol"), F.col(series.ts).alias("date_time"), F.col(POS).alias("pos"), CHUNK, F.col(value).cast("double").alias("value"))
    rows = _by_chunk(replace(series, symbol="symbol"), rows, states).filter(
        (F.col("pos") >= F.col("_cut")) & (F.col("pos") < F.floor(F.col("_rows") * F.lit(until))))
    kind = dict(series.df.dtypes)[series.ts]
    ahead = rows.withColumn("ahead", F.col("pos") - F.col("_cut") + 1)
    forecast = ahead.groupBy("symbol", CHUNK).applyInPandas(_walk, f"symbol string, date_time {kind}, forecast double")
    actual = rows.select("symbol", "date_time", "value")
    return actual.join(forecast, ["symbol", "date_time"]).join(found.orders.select("symbol", "p", "d", "q"), "symbol")


def forecast_error(forecast: DataFrame) -> DataFrame:
    """``symbol, p, d, q, n, rmse`` of :func:`ar_forecast`."""
    miss = F.col("value") - F.col("forecast")
    return forecast.groupBy("symbol", "p", "d", "q").agg(F.count("value").alias("n"), F.sqrt(F.avg(miss * miss)).alias("rmse"))
