"""Incremental load: new bars past the high-water mark, indicators that continue
exactly where the last run stopped, append-only tables.

A run needs the last ``CONTEXT`` bars per symbol and the saved states of the
scans (one row per symbol).  States are kept for a bar inside the context, one
``RESUME_STEP`` later for every scan depth, so that windows over scanned columns
find their rows.  Loading a history in any number of runs gives the same values
as loading it at once.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidebars.operators.indicators import TECHNICAL_RECIPES, add_indicators
from tidebars.operators.layout import HALO, POS, RESUME_STEP, Series, lay_out
from tidebars.operators.relational import union_context
from tidebars.operators.windows import lag_fill
from tidebars.session import only_row, stage

CONTEXT = HALO
_BARS = ["symbol", "date_time", "open", "high", "low", "close", "tick_vol"]


def new_bars(bars: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Bars newer than the newest stored bar of their symbol.

    The marks, one row per symbol, are taken from the stored bars; :func:`tidebars.plans.load.hourly_load`
    keeps them in its carry instead.
    """
    if stored is None:
        return bars
    marks = stored.groupBy("symbol").agg(F.max("date_time").alias("_mark"))
    fresh = bars.join(marks, "symbol", "left").filter(
        F.col("_mark").isNull() | (F.col("date_time") > F.col("_mark"))
    )
    return fresh.drop("_mark")


def with_context(new: DataFrame, stored: DataFrame, carry: DataFrame) -> DataFrame:
    """New bars and the stored bars from each symbol's context start on."""
    oldest = only_row(carry.agg(F.min(F.coalesce(F.col("since"), F.lit("0001-01-01").cast("timestamp_ntz")))))[0]
    recent = stored.select(*_BARS)
    if oldest is not None:
        recent = recent.filter(F.col("date_time") >= F.lit(oldest).cast("timestamp_ntz"))
    starts = carry.select("symbol", F.col("since").alias("_since"))
    recent = recent.join(starts, "symbol").filter(
        F.col("_since").isNull() | (F.col("date_time") >= F.col("_since"))
    )
    return union_context(recent.drop("_since"), new.select(*_BARS))


def load_step(
    new: DataFrame, stored: DataFrame | None, carry: DataFrame | None, recipes: list[str] | None = None, **layout
) -> tuple[DataFrame, Series]:
    """Rows to append and the series they came from (see :func:`next_carry`)."""
    recipes = recipes or TECHNICAL_RECIPES
    if stored is None or carry is None:
        series = lay_out(new.select(*_BARS), **layout)
    else:
        known = carry.filter(F.col("position").isNotNull())
        series = lay_out(with_context(new, stored, carry), resume=known, **layout)
    series = lag_fill(series, "close", "hist_close", 0.0)
    series = add_indicators(series, recipes)
    # the rows to append and the next states both come from this table
    series = replace(series, df=stage(series.df))
    rows = series.result()
    if stored is not None:
        marks = stored.groupBy("symbol").agg(F.max("date_time").alias("_mark"))
        rows = rows.join(marks, "symbol", "left").filter(
            F.col("_mark").isNull() | (F.col("date_time") > F.col("_mark"))
        ).drop("_mark")
    return rows, series


def next_carry(series: Series) -> DataFrame:
    """One row per symbol: where the next context starts, and the scan states.

    Symbols with no more than ``CONTEXT`` bars start over from their first bar.
    """
    rows = series.body()
    last = rows.groupBy(series.symbol).agg((F.max(POS) - (CONTEXT - 1)).alias("_start"))
    points = [RESUME_STEP * depth for depth in {0, *(depth for _, depth in series.scans)}]
    # a handful of rows per symbol, and every symbol, also those that have none of them
    placed = last.join(rows, series.symbol).filter(
        (F.col(POS) - F.col("_start")).isin(points) | (F.col("_start") <= 0) & (F.col(POS) == 0)
    )
    states = [
        F.struct(
            F.lit(name).alias("key"),
            F.max(F.when(F.col(POS) == F.col("_start") + RESUME_STEP * depth, F.col(name))).alias("value"),
        )
        for name, depth in series.scans
    ]
    saved = placed.groupBy(series.symbol, "_start").agg(
        F.max(F.when(F.col(POS) == F.col("_start"), F.col(series.ts))).alias("_since"),
        F.map_from_entries(F.array(*states)).alias("_map") if states
        else F.first(F.create_map().cast("map<string,double>")).alias("_map"),
    )
    full = F.col("_start") > 0
    return saved.select(
        series.symbol,
        F.when(full, F.col("_start")).alias("position"),
        F.when(full, F.col("_since")).alias("since"),
        F.when(full, F.col("_map")).alias("state"),
    )


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Row count and time range of what is written, measured while writing."""
    seen = Observation(name)
    return df.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.min("date_time").alias("first"), F.max("date_time").alias("last")
    ), seen
