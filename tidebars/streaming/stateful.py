"""The stored indicators on a stream: one bounded state per symbol.

Files may bring bars out of order.  A bar waits in the state until a bar of its symbol has been seen that is ``hold`` newer, or
until the watermark, which is ``hold`` behind the newest bar of any symbol, has passed it; then it is applied, always in order
of time.  So a symbol that falls silent gives its last bars too.  A row without a symbol is no bar and only moves the watermark: such
a row, ``hold`` ahead, ends the input and empties the state (:func:`closing_row`).

A bar that comes after a newer one was applied can't be put back in its place: it leaves with ``late`` set and no
indicators, for a side table.  The engine drops rows behind the watermark before a stateful operator; bars go in without a
time of their own for that reason, and rows that have nothing but the time move the watermark in their stead.

The state has the recurrences' last values and the last ``RING`` bars for the windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidebars.operators.indicators import TECHNICAL_COLUMNS
from tidebars.operators.indicators.psar import psar_step
from tidebars.sources.tables import append_new

COLUMNS = ["hist_close", *TECHNICAL_COLUMNS, "volatility_atr", "psar"]
RING = 78  # the 52 bars of the longest window and its shift by 26
_BAR = ("at", "high", "low", "close", "tick_vol")
_OUT = "symbol string, date_time timestamp_ntz, close double, late boolean, " + ", ".join(f"{c} double" for c in COLUMNS)
# bars applied, first close, two EMAs, KAMA, OBV, VPT, ATR (sum until full), stop state; then the ring and the waiting bars
_CARRY = ("first_close", "fast", "slow", "kama", "obv", "vpt", "atr")
_STATE = (
    "n bigint, " + ", ".join(f"{c} double" for c in _CARRY) + ", stop array<double>, "
    + ", ".join(f"ring_{c} array<{'bigint' if c == 'at' else 'double'}>" for c in _BAR) + ", "
    + ", ".join(f"held_{c} array<{'bigint' if c == 'at' else 'double'}>" for c in _BAR)
)


_NO_BARS = pd.DataFrame({"date_time": np.zeros(0, "datetime64[us]"), "tick_vol": np.zeros(0, np.int64), **{c: np.zeros(0) for c in ("high", "low", "close")}})


def _rolling(x: np.ndarray, n: int, how: Callable) -> np.ndarray:
    """``how`` over the last ``n`` values, NaN until there are ``n``."""
    out = np.full(len(x), np.nan)
    if len(x) >= n:
        out[n - 1:] = how(np.lib.stride_tricks.sliding_window_view(x, n), axis=1)
    return out


def _shift(x: np.ndarray, n: int) -> np.ndarray:
    return np.concatenate([np.full(min(n, len(x)), np.nan), x[:max(0, len(x) - n)]])


def _windows(high: np.ndarray, low: np.ndarray, close: np.ndarray, volume: np.ndarray) -> dict[str, np.ndarray]:
    """The window indicators of all bars given; right from the bar on that has its windows."""
    typical = (high + low + close) / 3.0
    out = {"trend_sma_fast": _rolling(close, 12, np.mean), "trend_sma_slow": _rolling(close, 26, np.mean)}

    def middle(n: int) -> np.ndarray:
        return (_rolling(high, n, np.max) + _rolling(low, n, np.min)) / 2.0

    conv, base, b = middle(9), middle(26), middle(52)
    a = (conv + base) / 2.0
    out |= {
        "trend_ichimoku_conv": conv, "trend_ichimoku_base": base, "trend_ichimoku_a": a, "trend_ichimoku_b": b,
        "trend_visual_ichimoku_a": _shift(a, 26), "trend_visual_ichimoku_b": _shift(b, 26),
    }
    mean, spread = _rolling(close, 20, np.mean), _rolling(close, 20, np.std)
    out |= {"volatility_bbm": mean, "volatility_bbh": mean + 2.0 * spread, "volatility_bbl": mean - 2.0 * spread}
    top, bottom = _rolling(high, 20, np.max), _rolling(low, 20, np.min)
    out |= {"volatility_dch": top, "volatility_dcl": bottom, "volatility_dcm": (top + bottom) / 2.0}
    out |= {
        "volatility_kcc": _rolling(typical, 10, np.mean),
        "volatility_kch": _rolling((high * 4.0 - low * 2.0 + close) / 3.0, 10, np.mean),
        "volatility_kcl": _rolling((low * 4.0 - high * 2.0 + close) / 3.0, 10, np.mean),
    }
    flow, traded = _rolling(typical * volume, 14, np.sum), _rolling(volume, 14, np.sum)
    out["volume_vwap"] = np.divide(flow, traded, out=np.full(len(flow), np.nan), where=(traded != 0))
    step = np.abs(close - _shift(close, 1))
    path = np.concatenate([[np.nan], _rolling(step[1:], 10, np.sum)])
    moved = np.abs(close - _shift(close, 10))
    ratio = np.divide(moved, path, out=np.zeros(len(close)), where=path > 0)
    out["_pace"] = np.where(np.isnan(moved), np.nan, (ratio * (2.0 / 3.0 - 2.0 / 31.0) + 2.0 / 31.0) ** 2)
    return out


def _applied(carry: dict, bars: dict[str, np.ndarray], start: int) -> dict[str, list]:
    """Indicator rows of ``bars[start:]``, the bars before being the ring; ``carry`` moves on."""
    windows = _windows(*(bars[c] for c in _BAR[1:]))
    out = {c: windows[c][start:].tolist() for c in TECHNICAL_COLUMNS if c in windows}
    rows = {c: [] for c in COLUMNS if c not in out}
    prev = float(bars["close"][start - 1]) if start else None
    for i in range(start, len(bars["at"])):
        high, low, close, volume = (float(bars[c][i]) for c in _BAR[1:])
        carry["n"] += 1
        n = carry["n"]
        if n == 1:
            carry.update(first_close=close, fast=close, slow=close)
        else:
            carry["fast"] += (close - carry["fast"]) * 2.0 / 13.0
            carry["slow"] += (close - carry["slow"]) * 2.0 / 27.0
        carry["obv"] += -volume if prev is not None and close < prev else volume
        if prev:
            carry["vpt"] += (close - prev) / prev * volume
        move = high - low if prev is None else max(high - low, abs(high - prev), abs(low - prev))
        carry["atr"] += move / 10.0 if n <= 10 else (move - carry["atr"]) / 10.0
        pace = float(windows["_pace"][i])
        if n > 10:
            carry["kama"] = close if carry["kama"] is None else carry["kama"] + (close - carry["kama"]) * pace
        carry["stop"], _ = psar_step(carry["stop"], high, low, 0.02, 0.2)
        first = carry["first_close"]
        for name, value in (
            ("hist_close", 0.0 if prev is None else prev), ("trend_ema_fast", carry["fast"] if n >= 12 else None),
            ("trend_ema_slow", carry["slow"] if n >= 26 else None), ("volume_obv", carry["obv"]), ("volume_vpt", carry["vpt"]),
            ("others_cr", (close - first) / first * 100.0 if first else None), ("momentum_kama", carry["kama"]),
            ("volatility_atr", carry["atr"] if n >= 10 else None), ("psar", carry["stop"][1]),
        ):
            rows[name].append(value)
        prev = close
    return out | rows


def _step(hold: int):
    def each(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            n, *rest = state.get
            carry = {"n": n, **dict(zip(_CARRY, rest))}
            stop, ring, held = rest[len(_CARRY)], rest[len(_CARRY) + 1:][:len(_BAR)], rest[len(_CARRY) + 1 + len(_BAR):]
            carry["stop"] = tuple(stop) if stop is not None else None
        else:
            carry = {"n": 0, "stop": None, **dict.fromkeys(_CARRY), "obv": 0.0, "vpt": 0.0, "atr": 0.0}
            ring = held = [[]] * len(_BAR)
        given = [b for b in batches if len(b)]  # none if the watermark alone called
        new = pd.concat(given, ignore_index=True) if given else _NO_BARS.copy()
        new["at"] = new["date_time"].astype("datetime64[us]").astype("int64")
        passed = state.getCurrentWatermarkMs() * 1000
        waiting = {c: np.concatenate([np.asarray(h, new[c].dtype if c == "at" else float), new[c].to_numpy()]) for c, h in zip(_BAR, held)}
        order = np.argsort(waiting["at"], kind="stable")
        order = order[np.concatenate([[True], np.diff(waiting["at"][order]) != 0])] if len(order) else order  # of equal times the first
        waiting = {c: v[order] for c, v in waiting.items()}
        last = ring[0][-1] if len(ring[0]) else None
        late = waiting["at"] <= last if last is not None else np.zeros(len(order), bool)
        known = np.isin(waiting["at"], ring[0])  # a repeated bar is not late
        free = ~late & (waiting["at"] <= max(passed, waiting["at"].max() - hold if len(order) else passed))
        parts = []
        if (late & ~known).any():
            own = late & ~known
            parts.append({"at": waiting["at"][own], "close": waiting["close"][own], "late": True, **dict.fromkeys(COLUMNS)})
        if free.any():
            bars = {c: np.concatenate([np.asarray(r, v.dtype), v[free]]) for (c, v), r in zip(waiting.items(), ring)}
            values = _applied(carry, bars, len(ring[0]))
            parts.append({"at": waiting["at"][free], "close": waiting["close"][free], "late": False, **values})
            ring = [bars[c][-RING:].tolist() for c in _BAR]
        stays = ~late & ~free
        state.update((
            carry["n"], *(carry[c] for c in _CARRY), list(carry["stop"]) if carry["stop"] is not None else None,
            *(list(r) for r in ring), *(waiting[c][stays].tolist() for c in _BAR)))
        if stays.any():
            state.setTimeoutTimestamp(max(int(waiting["at"][stays][0]) // 1000, passed // 1000 + 1))
        for part in parts:
            out = pd.DataFrame({"symbol": key[0], "date_time": pd.to_datetime(part.pop("at"), unit="us"), **part})
            out[COLUMNS] = out[COLUMNS].astype("Float64").where(lambda x: x.notna(), None)
            yield out[["symbol", "date_time", "close", "late", *COLUMNS]]

    return each


def indicator_stream(bars: DataFrame, hold: str = "2 hours") -> DataFrame:
    """Indicator rows for a stream of closed bars, continuing across batches, and the late bars.

    A trigger's bars of a symbol are sorted in one task; the rate limit of the source bounds them.  The state grows with the
    bars of the last ``hold`` only.
    """
    micros = int(pd.Timedelta(hold).value // 1000)
    at = F.col("date_time").cast("timestamp")
    is_bar = F.col("symbol").isNotNull() & at.isNotNull()
    # only bars have a second row, without a time; a filter on the columns of a bar would be moved below the watermark
    clock = F.when(is_bar, F.array(at, F.lit(None).cast("timestamp"))).when(at.isNotNull(), F.array(at))
    rows = bars.withColumn("_clock", F.explode(clock)).withWatermark("_clock", hold)
    return rows.filter(F.col("_clock").isNull()).groupBy("symbol").applyInPandasWithState(
        _step(micros), _OUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def closing_row(bars: DataFrame, at, hold: str = "2 hours") -> DataFrame:
    """One row of the columns of ``bars`` that moves the watermark past ``at``, the time of the newest bar: the state gives all its bars."""
    end = pd.Timestamp(at) + pd.Timedelta(hold) + pd.Timedelta("1 second")
    empty = {c: F.lit(None).cast(kind) for c, kind in bars.dtypes if c != "date_time"}
    row = bars.sparkSession.range(1).select(F.lit(str(end)).cast("timestamp_ntz").alias("date_time"), *[v.alias(c) for c, v in empty.items()])
    return row.select(*bars.columns)


def indicator_sink(path: str, late_path: str) -> Callable[[DataFrame, int], None]:
    """Indicator rows to ``path``, late bars to ``late_path``; a repeated batch adds nothing to either."""

    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            append_new(batch.filter(~F.col("late")).drop("late"), path)
            append_new(batch.filter("late").select("symbol", "date_time", "close"), late_path)
        finally:
            batch.unpersist()

    return each
