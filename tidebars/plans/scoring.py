"""Scoring new rows and comparing stored predictions with what came true."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebars.functions.schemas import FIRST_PREDICTION_KEY, PREDICTIONS
from tidebars.operators.monitor import monitor_window, psi, psi_status, rmse
from tidebars.operators.relational import join_pred_actual, live_row, rows_after_mark, unscored_rows
from tidebars.operators.signals import bracket_levels, trade_signal
from tidebars.plans.models import predict
from tidebars.session import only_row, stage
from tidebars.sources.tables import _exists, append_rows, stored_rows, surrogate_key, with_month


def score_new(
    model: PipelineModel, features: DataFrame, predictions: DataFrame | None, start: str | None = None
) -> DataFrame:
    """Prediction rows, with keys, for features that have none.

    With ``start`` only rows after the newest prediction (or ``start``) count;
    otherwise gaps are filled too.
    """
    if predictions is None:
        waiting = features
    elif start is not None:
        waiting = rows_after_mark(features, predictions, start)
    else:
        waiting = unscored_rows(features, predictions)
    scored = predict(model, waiting).select("symbol", "date_time", F.col("prediction").alias("predictions"))
    return surrogate_key(scored, "pred_key", FIRST_PREDICTION_KEY, stored=predictions)


def score_batch(model: PipelineModel, batch: DataFrame, path: str) -> None:
    """Predict the rows of a batch that have no stored prediction and append them to ``path``, running it twice adds nothing.

    Of the stored predictions only the months of the batch's symbols are read.  The newest key is kept beside them and moved on before the rows are
    written: a run that breaks off leaves a gap in the keys, never a key that is given twice.
    """
    spark = batch.sparkSession
    batch = with_month(batch)
    stored = stored_rows(spark, path, PREDICTIONS)
    if stored is not None:
        near = stored.join(batch.select("symbol", "ym").distinct(), ["symbol", "ym"], "left_semi")
        batch = batch.join(near.select("symbol", "date_time"), ["symbol", "date_time"], "left_anti")
    scored = stage(predict(model, batch).select("symbol", "date_time", F.col("prediction").alias("predictions")))
    n = scored.count()
    if not n:
        return
    kept = f"{path.rstrip('/')}-keys"
    if _exists(spark, kept):
        last = only_row(spark.read.schema("last_key bigint").parquet(kept).agg(F.max("last_key")))[0]
    else:
        last = None if stored is None else only_row(stored.agg(F.max("pred_key")))[0]
    start = FIRST_PREDICTION_KEY if last is None else last + 1
    spark.range(1).select(F.lit(start + n - 1).cast("bigint").alias("last_key")).coalesce(1).write.mode("append").parquet(kept)
    append_rows(surrogate_key(scored, "pred_key", start), path)


def report(predictions: DataFrame, financial: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """RMSE, PSI and drift status over a time range."""
    both = join_pred_actual(predictions, financial)
    if first is not None:
        both = both.filter(F.col("date_time") >= F.lit(first).cast("timestamp_ntz"))
    if last is not None:
        both = both.filter(F.col("date_time") <= F.lit(last).cast("timestamp_ntz"))
    error = only_row(rmse(both, "close", "predictions"))[0]
    drift = psi_status(psi(both, both, "close", "predictions"))
    return drift.withColumn("rmse", F.lit(error).cast("double"))


def daily_report(predictions: DataFrame, financial: DataFrame, width: str = "1 day", slide: str | None = None) -> DataFrame:
    return monitor_window(join_pred_actual(predictions, financial), "close", "predictions", width, slide)


def live_signals(model: PipelineModel, features: DataFrame, ticks: DataFrame, columns: list[str]) -> DataFrame:
    """Newest features and quote per symbol to side and bracket levels."""
    scored = predict(model, live_row(features, ticks, columns))
    return bracket_levels(trade_signal(scored))
