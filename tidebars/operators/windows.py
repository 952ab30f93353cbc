"""Row-to-row operators on the chunked layout."""

from __future__ import annotations

from tidebars.operators.expr import Expr, F
from tidebars.operators.layout import POS, Series
from tidebars.operators.scan import affine_scan, first_value, running_sum


def lag_fill(series: Series, column: str, name: str, fill: float | None = None, k: int = 1) -> Series:
    """The value ``k`` bars ago; ``fill`` where there is no such bar."""
    lagged = series.lag(column, k)
    if fill is not None:
        lagged = F.when(F.col(POS) < k, F.lit(fill)).otherwise(lagged)
    return series.add(**{name: lagged})


def lag_all_but(series: Series, *keep: str) -> Series:
    """Lag every column by one bar, except the keys and ``keep``."""
    fixed = {series.symbol, series.ts, *keep}
    columns = [c for c in series.df.columns if c not in fixed and not c.startswith("_")]
    return series.add(**{c: series.lag(c) for c in columns})


def rolling(series: Series, column: str, n: int, **aggregates) -> Series:
    """Rolling aggregates over ``n`` bars, NULL unless all ``n`` values are there."""
    return series.add(**{name: series.rolling(agg, column, n) for name, agg in aggregates.items()})


def change(column: str, series: Series, k: int = 1) -> Expr:
    """Relative change from ``k`` bars ago; NULL where that was 0."""
    before = series.lag(column, k)
    return F.try_divide(F.col(column) - before, before)


def log_return(column: str, series: Series) -> Expr:
    before = series.lag(column)
    return F.when((F.col(column) > 0) & (before > 0), F.ln(F.try_divide(F.col(column), before)))


def cumulative(series: Series, column: str) -> Series:
    """Running sum, running product of (1 + change) and change since the first bar."""
    growth = F.when(F.col(POS) == 0, F.lit(0.0)).otherwise(
        F.coalesce(F.ln(F.abs(F.nullif(F.col("_growth"), F.lit(0.0)))), F.lit(0.0))
    )
    before = series.lag(column)
    series = series.add(_growth=F.when(before != 0, F.try_divide(F.col(column), before)))
    series = affine_scan(
        series,
        [
            running_sum("cum_sum", F.col(column).cast("double")),
            running_sum("_log_growth", growth),
            running_sum("_zeros", F.when(F.col("_growth") == 0, 1.0).otherwise(0.0)),
            running_sum("_turns", F.when(F.col("_growth") < 0, 1.0).otherwise(0.0)),
            first_value("_first", F.col(column)),
        ],
    )
    return series.add(
        cum_product=F.when(F.col("_zeros") > 0, 0.0).otherwise(F.exp("_log_growth") * F.when(F.col("_turns") % 2 == 1, -1.0).otherwise(1.0)),
        cum_return=F.try_divide(F.col(column) - F.col("_first"), F.col("_first")),
    )
