"""Column helpers: dates, cycles, grids, safe replacement."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Period of each cyclical date feature.
PERIODS = {"month": 12, "hour": 24, "day": 31, "day_of_week": 7}


def parse_datetime(date: str, time: str, pattern: str = "yyyy.MM.dd HH:mm:ss") -> Column:
    """Date text and time text as one timestamp; NULL where they do not parse."""
    return F.try_to_timestamp(F.concat_ws(" ", date, time), F.lit(pattern)).cast("timestamp_ntz")


def to_timestamp(text: str) -> Column:
    return F.try_to_timestamp(F.col(text)).cast("timestamp_ntz")


def epoch_to_timestamp(seconds: str) -> Column:
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def plus_hours(ts: str, hours: int = 1) -> Column:
    return F.col(ts) + F.expr(f"INTERVAL {int(hours)} HOUR")


def date_parts(ts: str = "date_time") -> dict[str, Column]:
    """Year, month, day, hour and weekday (Monday is 0)."""
    return {
        "year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts),
        "hour": F.hour(ts), "day_of_week": F.weekday(ts),
    }


def cyclical(ts: str = "date_time", parity: bool = False) -> dict[str, Column]:
    """Sine and cosine of each date part over its period.

    ``parity`` gives the sine for both, as older stored features have it.
    """
    out = {}
    parts = date_parts(ts)
    for name, period in PERIODS.items():
        angle = parts[name] * F.lit(2 * math.pi) / F.lit(float(period))
        out[f"{name}_sin"] = F.sin(angle)
        out[f"{name}_cos"] = F.sin(angle) if parity else F.cos(angle)
    return out


def to_numeric(df: DataFrame, keep: tuple[str, ...] = ("symbol", "date_time")) -> DataFrame:
    """Every other column as double, NULL where the text is not a number."""
    return df.select(*[c if c in keep else F.col(c).try_cast("double").alias(c) for c in df.columns])


def replace_zero(x: Column, by: float = 1e-6) -> Column:
    return F.when(x == 0, F.lit(by)).otherwise(x)


def linspace(start: Column, stop: Column, n: int) -> Column:
    """Array of ``n`` evenly spaced values from ``start`` to ``stop``, ends included."""
    step = (stop - start) / F.lit(float(n - 1))
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: start + step * i)


def logspace(start: float, stop: float, n: int) -> Column:
    """Array of ``n`` powers of ten with evenly spaced exponents."""
    return F.transform(linspace(F.lit(start), F.lit(stop), n), lambda e: F.pow(F.lit(10.0), e))
