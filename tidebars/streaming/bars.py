"""Streams: closed bars from ticks, idempotent sinks, scoring per batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidebars.plans.scoring import score_batch
from tidebars.sources.tables import append_new


def tick_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """Ticks from files as they land."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def bar_stream(
    ticks: DataFrame, symbol: str = "symbol", ts: str = "ts", price: str = "price", tie: str = "event_id",
    width: str = "1 hour", delay: str = "2 hours",
) -> DataFrame:
    """Closed bars only: a bar is emitted once the watermark has passed its end.

    The watermark needs a zoned timestamp; the session runs in UTC.
    """
    order = F.struct(ts, tie)
    zoned = ticks.withColumn(ts, F.col(ts).cast("timestamp"))
    bars = (
        zoned.withWatermark(ts, delay)
        .groupBy(symbol, F.window(ts, width).alias("_w"))
        .agg(
            F.min_by(price, order).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
            F.max_by(price, order).alias("close"), F.count(F.lit(1)).alias("tick_vol"),
        )
    )
    return bars.select(
        symbol, F.col("_w.start").cast("timestamp_ntz").alias("date_time"),
        "open", "high", "low", "close", "tick_vol",
    )


def late_ticks(ticks: DataFrame, stored: DataFrame, width_hours: int = 1) -> DataFrame:
    """Ticks of bars, ``width_hours`` wide, that are already stored and will not be changed."""
    bar = F.window(F.col("ts").cast("timestamp"), f"{width_hours} hours")["start"].cast("timestamp_ntz")
    return ticks.withColumn("date_time", bar).join(stored.select("symbol", "date_time"), ["symbol", "date_time"], "left_semi")


def run_batches(
    stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append"
) -> StreamingQuery:
    """Process what is there now in batches, then stop."""
    return (
        stream.writeStream.outputMode(mode).foreachBatch(each)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def append_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Append rows whose key is not stored: a repeated batch adds nothing, whatever its number."""

    def each(batch: DataFrame, batch_id: int) -> None:
        append_new(batch, path)

    return each


def scoring_sink(model: PipelineModel, path: str) -> Callable[[DataFrame, int], None]:
    """Predict the rows of a batch that have no prediction and append them."""

    def each(batch: DataFrame, batch_id: int) -> None:
        score_batch(model, batch, path)

    return each


