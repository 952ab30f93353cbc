"""Bars from ticks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bars_from_ticks(
    ticks: DataFrame,
    symbol: str = "symbol",
    ts: str = "ts",
    price: str = "price",
    tie: str | None = None,
    width: str = "1 hour",
) -> DataFrame:
    """Open, high, low, close and tick count per symbol and time span.

    One partially aggregated shuffle; ``tie`` orders ticks of equal time.
    """
    order = F.struct(ts, tie) if tie else F.col(ts)
    return (
        ticks.groupBy(symbol, F.window(ts, width).alias("_w"))
        .agg(
            F.min_by(price, order).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, order).alias("close"),
            F.count(F.lit(1)).alias("tick_vol"),
        )
        .select(
            symbol,
            F.col("_w.start").cast("timestamp_ntz").alias("date_time"),
            "open", "high", "low", "close", "tick_vol",
        )
    )


def event_ticks(events: DataFrame) -> DataFrame:
    """The event stream read as ticks: one symbol per event type."""
    return events.select(
        F.col("event_type").alias("symbol"), "ts", F.col("value").alias("price"), "event_id"
    )
