"""Parabolic stop: a state machine run chunk by chunk.

The stop depends on its own past in a way that does not compose, so each chunk
is first run from a guessed state at the start of its copied rows; the guess is
forgotten after a few reversals.  Then the state each chunk started its own rows
with is compared with the state the chunk before it ended with.  Chunks where
they differ are run again from the state handed over, until all agree.  The
result is exactly that of one pass over the whole symbol, and no task ever holds
more than one chunk.

A round reads a row of states per chunk and writes only the chunks it has run: the others are never rewritten.  There are as many rounds as
chunks in a row through which runs from two states stay apart, which needs a market that doesn't move for chunks on end.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebars.operators.layout import CHUNK, HALO_FLAG, POS, Series
from tidebars.session import stage

COLUMNS = ["trend_psar_up", "trend_psar_down", "trend_psar_up_indicator", "trend_psar_down_indicator"]


def psar_step(state, high, low, step, cap):
    """One bar.  Returns the new state and whether the trend turned on this bar.

    The state: rising (1 or 0), stop, extreme point, acceleration, and the lows
    and highs of the last two bars, which the stop may not cross.
    """
    if state is None:
        return (1.0, low, high, step, low, low, high, high), False
    rising, stop, extreme, accel, low1, low2, high1, high2 = state
    stop = stop + accel * (extreme - stop)
    turned = False
    if rising:
        stop = min(stop, low1, low2)
        if low < stop:
            turned, rising, stop, extreme, accel = True, 0.0, extreme, low, step
        elif high > extreme:
            extreme, accel = high, min(accel + step, cap)
    else:
        stop = max(stop, high1, high2)
        if high > stop:
            turned, rising, stop, extreme, accel = True, 1.0, extreme, high, step
        elif low < extreme:
            extreme, accel = low, min(accel + step, cap)
    return (rising, stop, extreme, accel, low, low1, high, high1), turned


def _run_chunk(pdf: pd.DataFrame, step: float, cap: float, given: tuple | None) -> pd.DataFrame:
    """Run one chunk.  ``given`` is the state before its first own row, if known."""
    pdf = pdf.sort_values(POS, kind="stable")
    if given is not None:
        pdf = pdf[~pdf[HALO_FLAG]]
    own = np.flatnonzero(~pdf[HALO_FLAG].to_numpy())
    state, start = given, given
    rows = []
    for i, (high, low) in enumerate(zip(pdf["high"].to_numpy(), pdf["low"].to_numpy())):
        if len(own) and i == own[0]:
            start = state
        before = state is None
        state, turned = psar_step(state, high, low, step, cap)
        rising = state[0] == 1.0
        rows.append(
            (
                state[1] if rising and not before else None,
                state[1] if not rising else None,
                1.0 if turned and rising else 0.0,
                1.0 if turned and not rising else 0.0,
            )
        )
    out = pdf.copy()
    for name, values in zip(COLUMNS, zip(*rows) if rows else ([], [], [], [])):
        out[name] = pd.array(values, dtype="Float64")
    out = out[~out[HALO_FLAG]]
    last = np.arange(len(out)) == len(out) - 1  # the states stand beside the last row alone
    out["_start"] = pd.Series([list(start) if end and start is not None else None for end in last], index=out.index, dtype=object)
    out["_end"] = pd.Series([list(state) if end else None for end in last], index=out.index, dtype=object)
    return out


def psar(series: Series, step: float = 0.02, cap: float = 0.2) -> Series:
    """Add the four parabolic-stop columns.  Drops the copied rows: run it last."""
    symbol = series.symbol
    kept = [c for c in series.df.columns if not c.startswith("_")]
    slim = series.df.select(symbol, series.ts, "high", "low", POS, CHUNK, HALO_FLAG)
    schema = T.StructType(
        slim.schema.fields
        + [T.StructField(c, T.DoubleType()) for c in COLUMNS]
        + [T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("_start", "_end")]
    )

    def guess(pdf):
        return _run_chunk(pdf, step, cap, None)

    base = slim.groupBy(symbol, CHUNK).applyInPandas(guess, schema)
    if series.longest > series.chunk_rows:
        base = _agreed(stage(base), slim, symbol, step, cap, schema)
    columns = base.select(symbol, series.ts, *COLUMNS)
    joined = series.body().select(*kept, POS, CHUNK, HALO_FLAG).join(columns, [symbol, series.ts])
    return replace(series, df=joined)


def _states(done: DataFrame, symbol: str, number: int) -> DataFrame:
    """A row per chunk: the states its run started and ended with, and the round it was run in."""
    return done.filter(F.col("_end").isNotNull()).select(symbol, CHUNK, "_start", "_end", F.lit(number).alias("_round"))


def _agreed(base: DataFrame, slim: DataFrame, symbol: str, step: float, cap: float, schema: T.StructType) -> DataFrame:
    """Rows of runs that each start where the one before has ended."""
    keys = [symbol, CHUNK]
    rounds, states = [base], stage(_states(base, symbol, 0))
    while True:
        wrong = stage(_handed_over(states, symbol))
        if wrong.isEmpty():
            break
        again = stage(slim.join(wrong, keys).groupBy(*keys).applyInPandas(_rerun(step, cap), schema))
        states = stage(states.join(wrong, keys, "left_anti").unionByName(_states(again, symbol, len(rounds))))
        rounds.append(again)
    out = rounds[0].join(states.filter("_round = 0"), keys, "left_semi") if len(rounds) > 1 else rounds[0]
    for number, rows in enumerate(rounds[1:], 1):
        out = out.unionByName(rows.join(states.filter(F.col("_round") == number), keys, "left_semi"))
    return out


def _rerun(step: float, cap: float):
    def run(pdf):
        given = tuple(pdf["_given"].iloc[0])
        return _run_chunk(pdf.drop(columns="_given"), step, cap, given)

    return run


def _handed_over(states: DataFrame, symbol: str) -> DataFrame:
    """Chunks whose starting state is not the end state of the chunk before."""
    ends = states.select(symbol, (F.col(CHUNK) + 1).alias(CHUNK), F.col("_end").alias("_given"))
    both = states.join(ends, [symbol, CHUNK])
    return both.filter(~F.col("_start").eqNullSafe(F.col("_given"))).select(symbol, CHUNK, "_given")
