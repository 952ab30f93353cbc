"""Joins, unions, ordering and positions on bar tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebars.operators.layout import POS, number_rows
from tidebars.session import only_row

KEYS = ["symbol", "date_time"]


def join_fin_tech(financial: DataFrame, technical: DataFrame, since: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """Price rows with their indicators.

    ``since`` is strict and reaches the scans of both sides; ``columns`` prunes
    both.  Equi-join: the engine picks broadcast or sort-merge by measured size.
    """
    if since is not None:
        financial = financial.filter(F.col("date_time") > F.lit(since).cast("timestamp_ntz"))
    joined = financial.join(technical, KEYS)
    return joined.select(*KEYS, *columns) if columns else joined


def join_pred_actual(predictions: DataFrame, financial: DataFrame) -> DataFrame:
    """Each prediction beside the close that came true."""
    return predictions.select(*KEYS, "predictions").join(financial.select(*KEYS, "close"), KEYS)


def unscored_rows(features: DataFrame, predictions: DataFrame) -> DataFrame:
    """Feature rows without a prediction, wherever they lie in time."""
    return features.join(predictions.select(*KEYS), KEYS, "left_anti")


def rows_after_mark(features: DataFrame, predictions: DataFrame, start: str) -> DataFrame:
    """Feature rows newer than the newest prediction, or than ``start`` if there is none.

    The mark is one value and becomes a literal, so that it is pushed to the scan.
    """
    mark = high_water_mark(predictions)
    bound = F.lit(start).cast("timestamp_ntz") if mark is None else F.lit(mark).cast("timestamp_ntz")
    return features.filter(F.col("date_time") > bound)


def high_water_mark(stored: DataFrame, ts: str = "date_time"):
    return only_row(stored.agg(F.max(ts)))[0]


def live_row(features: DataFrame, ticks: DataFrame, columns: list[str]) -> DataFrame:
    """Newest feature row per symbol, with the newest bid as its open."""
    rest = [c for c in columns if c != "open"]
    last = features.groupBy("symbol").agg(
        F.max("date_time").alias("date_time"), F.max_by(F.struct(*rest), "date_time").alias("_row")
    )
    quote = ticks.groupBy("symbol").agg(F.max_by(F.struct("bid", "ask"), "ts").alias("_tick"))
    return last.join(quote, "symbol").select(
        "symbol", "date_time",
        *[F.col("_tick.bid").alias("open") if c == "open" else F.col(f"_row.{c}").alias(c) for c in columns],
        F.col("_tick.bid").alias("bid"), F.col("_tick.ask").alias("ask"),
    )


def union_context(stored: DataFrame, new: DataFrame) -> DataFrame:
    return stored.unionByName(new)


def pool(first: DataFrame, second: DataFrame, column: str, other: str) -> DataFrame:
    """Two samples in one column, told apart by ``side`` (0 and 1)."""
    a = first.select(F.lit(0).alias("side"), F.col(column).alias("value"))
    b = second.select(F.lit(1).alias("side"), F.col(other).alias("value"))
    return a.unionByName(b)


def union_names(frames: list[DataFrame], drop: str) -> DataFrame:
    """Distinct selected names of several families in order, without the target."""
    out = frames[0].select("feature")
    for frame in frames[1:]:
        out = out.unionByName(frame.select("feature"))
    return out.filter(F.col("feature") != drop).distinct().orderBy("feature")


def latest_n(df: DataFrame, n: int, *tie: str, ts: str = "date_time") -> DataFrame:
    """The newest ``n`` rows: a top-k per task, merged."""
    return df.orderBy(F.col(ts).desc(), *tie).limit(n)


def latest_n_per_symbol(df: DataFrame, n: int, symbol: str = "symbol", ts: str = "date_time") -> DataFrame:
    """The newest ``n`` rows per symbol.

    The rank filter is also applied before the shuffle, so a task gets at most
    ``n`` rows of a symbol from each input task.
    """
    rank = F.row_number().over(Window.partitionBy(symbol).orderBy(F.col(ts).desc()))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def with_position(df: DataFrame, name: str = "position", **layout) -> DataFrame:
    """0-based position within the symbol, in time order."""
    numbered, _ = number_rows(df, **layout)
    return numbered.withColumnRenamed(POS, name)


def slice_range(df: DataFrame, first: int, last: int, **layout) -> DataFrame:
    """Rows from position ``first`` to ``last``, both included."""
    return with_position(df, **layout).filter(F.col("position").between(first, last))


def head(df: DataFrame, k: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(k)


def tail(df: DataFrame, k: int, *order: str) -> DataFrame:
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(k)


def frequent_values(df: DataFrame, column: str, k: int = 10, least: bool = False) -> DataFrame:
    """The ``k`` most (or least) frequent values; ties by value."""
    counts = value_counts(df, column)
    return counts.orderBy(F.col("n").asc() if least else F.col("n").desc(), column).limit(k)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
