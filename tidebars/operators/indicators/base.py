"""Shared pieces of the indicator recipes.

A recipe is a list of steps.  A ``dict`` step adds ordinary and window columns,
a ``list`` step is one affine scan.  :func:`apply_recipes` runs the recipes side
by side, so that all recurrences of the same depth share one scan and all
windows share one sort.

Columns used: ``open high low close tick_vol``.  Intermediate columns start
with ``_`` and are dropped from the result.  Bars are taken to be free of NULLs
(the load steps see to it).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import replace

from tidebars.operators.expr import Expr, F
from tidebars.operators.layout import POS, Series
from tidebars.operators.scan import Recurrence, affine_scan
from tidebars.session import cut

Step = dict[str, Expr] | list[Recurrence]
Recipe = Callable[[Series], list[Step]]


def high() -> Expr:
    return F.col("high")


def low() -> Expr:
    return F.col("low")


def close() -> Expr:
    return F.col("close")


def volume() -> Expr:
    return F.col("tick_vol").cast("double")


def typical() -> Expr:
    return (high() + low() + close()) / F.lit(3.0)


def ready(x: Expr | str, rows: int) -> Expr:
    """``x`` from the bar on by which ``rows`` bars have been seen, else NULL."""
    return F.when(F.col(POS) >= rows - 1, F.col(x) if isinstance(x, str) else x)


def ratio(x: Expr, y: Expr) -> Expr:
    return F.try_divide(x, y)


def flag(condition: Expr) -> Expr:
    """1.0 where the condition holds, else 0.0 (also where it is unknown)."""
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def sma(s: Series, x: Expr | str, n: int) -> Expr:
    return s.rolling(F.avg, x, n)


def rsum(s: Series, x: Expr | str, n: int) -> Expr:
    return s.rolling(F.sum, x, n)


def highest(s: Series, x: Expr | str, n: int) -> Expr:
    return s.rolling(F.max, x, n)


def lowest(s: Series, x: Expr | str, n: int) -> Expr:
    return s.rolling(F.min, x, n)


def true_range(s: Series) -> Expr:
    prev = s.lag("close")
    return F.greatest(high() - low(), F.abs(high() - prev), F.abs(low() - prev))


def apply_recipes(series: Series, recipes: Iterable[Recipe], cut_scans: bool = False) -> Series:
    """Run recipes together.  ``cut_scans`` checkpoints after each scan, for
    plans with so many columns that repeating a level costs more than a write."""
    waiting = [list(recipe(series)) for recipe in recipes]
    depth = 0
    while any(waiting):
        while any(steps and isinstance(steps[0], dict) for steps in waiting):
            columns: dict[str, Expr] = {}
            for steps in waiting:
                if steps and isinstance(steps[0], dict):
                    columns.update(steps.pop(0))
            series = series.add(**columns)
        scans: dict[str, Recurrence] = {}
        for steps in waiting:
            if steps:
                scans.update({item.name: item for item in steps.pop(0)})
        if scans:
            depth += 1
            series = affine_scan(series, list(scans.values()), depth)
            if cut_scans:
                series = replace(series, df=cut(series.df))
    return series
