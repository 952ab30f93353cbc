"""Scaling and time-ordered splits."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebars.session import only_row
from tidebars.sources.tables import surrogate_key

ROW = "row"


def scale_moments(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation of each column, from one aggregate."""
    row = only_row(df.agg(*[F.struct(F.avg(c), F.stddev_pop(c)).alias(c) for c in columns]))
    return {c: (row[c][0], row[c][1]) for c in columns}


def standard_scale(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Centre and scale columns by the moments of ``fit_on`` (pass the training
    slice); a constant column is only centred."""
    moments = scale_moments(fit_on if fit_on is not None else df, columns)
    return df.withColumns(
        {c: (F.col(c) - F.lit(m)) / F.lit(s if s else 1.0) for c, (m, s) in moments.items()}
    )


def with_row(df: DataFrame, ts: str = "date_time", symbol: str = "symbol") -> DataFrame:
    """0-based position over all rows, by time and then symbol."""
    return surrogate_key(df, ROW, 0, ts, symbol)


def split_sizes(n: int, test: float = 0.05, val: float = 0.055) -> tuple[int, int]:
    """Rows before the validation and before the test slice; the held-out slices
    are rounded up."""
    before_test = n - math.ceil(n * test)
    return before_test - math.ceil(before_test * val), before_test


def time_split(df: DataFrame, n: int, test: float = 0.05, val: float = 0.055) -> DataFrame:
    """Add ``slice``: train, val or test by position (``df`` has ``row``)."""
    val_from, test_from = split_sizes(n, test, val)
    return df.withColumn(
        "slice", F.when(F.col(ROW) < val_from, "train").when(F.col(ROW) < test_from, "val").otherwise("test")
    )


def cut_at(n: int, share: float) -> int:
    """Position of the first row after the leading ``share`` of ``n`` rows."""
    return int(n * share)


def train_subset(df: DataFrame, n_train: int, share: float = 0.1) -> DataFrame:
    """The first ``share`` of the training rows."""
    return df.filter(F.col(ROW) < cut_at(n_train, share))


def fold_starts(n: int, splits: int) -> list[int]:
    """First position of each test block; fold ``i`` trains on all rows before it."""
    size = n // (splits + 1)
    return [n - (splits - i) * size for i in range(splits)]


def with_fold(df: DataFrame, n: int, splits: int) -> DataFrame:
    """Add ``block``: 0 before the first test block, ``i`` inside test block ``i``.

    Fold ``i`` trains on blocks below ``i`` and is scored on block ``i``.
    """
    starts = fold_starts(n, splits)
    block = F.lit(0)
    for i, start in enumerate(starts, 1):
        block = F.when(F.col(ROW) >= start, F.lit(i)).otherwise(block)
    return df.withColumn("block", block)
