"""Historical batch: bars to the stored tables and to the selected features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebars.functions.scalar import cyclical
from tidebars.functions.schemas import CYCLICAL_COLUMNS
from tidebars.operators.indicators import (
    FAMILIES, TECHNICAL_COLUMNS, TECHNICAL_RECIPES, add_all_indicators, add_indicators,
)
from tidebars.operators.layout import Series, lay_out
from tidebars.operators.profile import corr_select
from tidebars.operators.relational import union_names
from tidebars.operators.windows import lag_all_but, lag_fill
from tidebars.session import cut, stage
from tidebars.sources.files import dense_columns


def financial_table(bars: DataFrame, **layout) -> DataFrame:
    """Bars with the close before (0 on the first bar)."""
    series = lag_fill(lay_out(bars, **layout), "close", "hist_close", 0.0)
    return series.result("open", "high", "low", "close", "tick_vol", "hist_close")


def technical_series(series: Series, lag: bool = False) -> Series:
    """The stored indicator columns; ``lag`` shifts them one bar, so that each row
    shows what was known before its bar closed."""
    series = add_indicators(series, TECHNICAL_RECIPES)
    if lag:
        series = series.add(**{c: series.lag(c) for c in TECHNICAL_COLUMNS})
    return series


def technical_table(bars: DataFrame, lag: bool = False, **layout) -> DataFrame:
    return technical_series(lay_out(bars, **layout), lag).result(*TECHNICAL_COLUMNS)


def feature_table(bars: DataFrame, lag: bool = True, parity: bool = False, **layout) -> DataFrame:
    """Target, prices, lagged indicators and date features in one layout.

    The three tables share their keys and their partitioning, so no join is made.
    """
    series = lag_fill(lay_out(bars, **layout), "close", "hist_close", 0.0)
    series = technical_series(series, lag)
    series = series.add(**cyclical("date_time", parity))
    return series.result("close", "open", "hist_close", "tick_vol", *TECHNICAL_COLUMNS, *CYCLICAL_COLUMNS)


def selected_features(
    bars: DataFrame, target: str = "close", at_least: float = 0.5, more_than: int = 0, **layout
) -> tuple[DataFrame, DataFrame]:
    """All indicators, lagged one bar, and those among them that move with the
    target: per family the correlated ones, of these the well-filled ones.

    Returns the table (NULL as 0) and the names with their correlation.
    """
    series = add_all_indicators(lay_out(bars, **layout))
    lagged = cut(lag_all_but(_again(series), target).result())
    picked = stage(corr_select(lagged, [c for columns in FAMILIES.values() for c in columns], target, at_least))  # one pass for all families
    picks = [picked.filter(F.col("feature").isin(columns)) for columns in FAMILIES.values()]
    names = [r[0] for r in union_names(picks, target).collect()]
    dense = dense_columns(lagged, names, more_than) if names else []
    table = lagged.select("symbol", "date_time", *dense).na.fill(0.0)
    return table, picked.filter(F.col("feature").isin(dense))


def _again(series: Series) -> Series:
    """The layout of a finished series, with fresh copied rows."""
    return lay_out(series.result(), series.symbol, series.ts, chunk_rows=series.chunk_rows)
