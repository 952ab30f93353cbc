"""Inputs shared by the registered queries, in Spark and in SQL.

Ticks are the events: a symbol per event type, the value as price.
"""

from __future__ import annotations

from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebars.operators.layout import HALO, POS, Series, lay_out
from tidebars.operators.windows import lag_fill
from tidebars.sources.ticks import bars_from_ticks, event_ticks


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_ticks(table(spark, sf_dir, "events"))


def bars(spark: SparkSession, sf_dir: str, width: str = "1 hour") -> DataFrame:
    return bars_from_ticks(ticks(spark, sf_dir), tie="event_id", width=width)


#: Width of the bars and rows of a chunk of :func:`series`; None takes the default.
_SHAPE: ContextVar[tuple[str, int | None]] = ContextVar("shape", default=("1 hour", None))


def series(spark: SparkSession, sf_dir: str, lookback: int = HALO) -> Series:
    width, rows = _SHAPE.get()
    return lay_out(bars(spark, sf_dir, width), chunk_rows=rows, lookback=lookback)


def across_chunks(run):
    """The query over bars of a second in the smallest chunks: many chunks per symbol."""
    return at_chunk(run, HALO)


def at_chunk(run, rows: int):
    """The query over bars of a second in chunks of ``rows``."""

    def long(spark: SparkSession, sf_dir: str) -> DataFrame:
        token = _SHAPE.set(("1 second", rows))
        try:
            return run(spark, sf_dir)
        finally:
            _SHAPE.reset(token)

    return long


def across_chunks_sql(sql: str) -> str:
    return sql.replace("time_bucket(INTERVAL '1 hour', ts)", "time_bucket(INTERVAL '1 second', ts)")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to ``digits`` decimals, for comparison across engines; spelled out so
    that halves go the same way everywhere."""
    unit = float(10**digits)
    return df.select(
        *[
            (F.floor(F.col(c) * unit + 0.5) / unit).alias(c) if kind == "double" else F.col(c)
            for c, kind in df.dtypes
        ]
    )


def r(expression: str, digits: int = 6) -> str:
    """The same in SQL."""
    unit = 10**digits
    return f"floor(CAST({expression} AS DOUBLE) * {unit}.0::DOUBLE + 0.5) / {unit}.0::DOUBLE"


BARS = """bars AS (
  SELECT event_type AS symbol, time_bucket(INTERVAL '1 hour', ts) AS date_time,
         arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, ts) AS close, count(*) AS tick_vol
  FROM events GROUP BY 1, 2)"""

# numbered bars with the values of the bar before
NUM = BARS + """, num AS (
  SELECT *, row_number() OVER w - 1 AS pos, lag(close) OVER w AS c1, lag(high) OVER w AS h1, lag(low) OVER w AS l1,
         lag(tick_vol) OVER w AS v1, (high + low + close) / 3.0 AS tp
  FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date_time))"""

# predictions stand-in: a fixed formula of the close before
FINANCIAL = NUM + """, financial AS (
  SELECT symbol, date_time, open, high, low, close, tick_vol, coalesce(c1, 0) AS hist_close, pos FROM num),
predictions AS (
  SELECT symbol, date_time, 0.9 * hist_close + 5 AS predictions FROM financial WHERE pos > 0)"""


def over(n: int) -> str:
    return f"OVER (PARTITION BY symbol ORDER BY date_time ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def roll(agg: str, x: str, n: int, first: int = 0) -> str:
    """Rolling aggregate, NULL until ``n`` bars from position ``first`` on."""
    return f"CASE WHEN pos >= {first + n - 1} THEN {agg}({x}) {over(n)} END"


def financial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with ``hist_close`` and their position."""
    s = lag_fill(series(spark, sf_dir), "close", "hist_close", 0.0)
    return s.add(pos=F.col(POS)).result("open", "high", "low", "close", "tick_vol", "hist_close", "pos")


def predictions(financial: DataFrame) -> DataFrame:
    """The predictions stand-in."""
    return financial.filter(F.col("pos") > 0).select(
        "symbol", "date_time", (F.col("hist_close") * 0.9 + 5.0).alias("predictions")
    )
