"""Trade signals from a prediction and a live quote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Distance of the bracket levels and order size.
BRACKET = 0.001
LOT = 0.01


def trade_side(ask: str = "ask", bid: str = "bid", prediction: str = "prediction") -> Column:
    """BUY under the prediction, SELL above it; none at it or on a bad quote."""
    good = (F.col(ask) != 0) & (F.col(bid) != 0)
    return F.when(good & (F.col(ask) < F.col(prediction)), "BUY").when(
        good & (F.col(ask) > F.col(prediction)), "SELL"
    )


def trade_signal(df: DataFrame, ask: str = "ask", bid: str = "bid", prediction: str = "prediction") -> DataFrame:
    return df.withColumn("side", trade_side(ask, bid, prediction))


def bracket_levels(df: DataFrame, ask: str = "ask", bid: str = "bid", distance: float = BRACKET, lot: float = LOT) -> DataFrame:
    """Order price, take-profit and stop-loss; a sale fills at the bid but its
    levels are set from the ask."""
    buy = F.col("side") == "BUY"
    away = F.when(buy, F.lit(distance)).otherwise(F.lit(-distance))
    placed = df.filter(F.col("side").isNotNull())
    return placed.withColumns(
        {
            "price": F.when(buy, F.col(ask)).otherwise(F.col(bid)),
            "take_profit": F.col(ask) + away,
            "stop_loss": F.col(ask) - away,
            "volume": F.lit(lot),
        }
    )
