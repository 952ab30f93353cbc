"""Fixed table schemas (column names and order are part of the data contract)."""

from __future__ import annotations

from pyspark.sql import types as T

from tidebars.operators.indicators import TECHNICAL_COLUMNS

_D, _L, _S, _NTZ = T.DoubleType(), T.LongType(), T.StringType(), T.TimestampNTZType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Nine text columns of an exported bar file; typed after reading.
BARS_TSV = _struct(
    date=_S, time=_S, open=_S, high=_S, low=_S, close=_S, tick_vol=_S, vol=_S, spread=_S
)
RATES = _struct(time=_L, open=_D, high=_D, low=_D, close=_D, tick_volume=_L, spread=_L, real_volume=_L)
CYCLICAL_COLUMNS = [
    "month_sin", "month_cos", "hour_sin", "hour_cos",
    "day_sin", "day_cos", "day_of_week_sin", "day_of_week_cos",
]
FINANCIAL_DATA = _struct(
    symbol=_S, fin_key=_L, open=_D, high=_D, low=_D, close=_D, tick_vol=_D, date_time=_NTZ, hist_close=_D
)
TECHNICAL_DATA = _struct(symbol=_S, tech_key=_L, **{c: _D for c in TECHNICAL_COLUMNS}, date_time=_NTZ)
TRANSFORMED_DATE = _struct(symbol=_S, date_key=_L, **{c: _D for c in CYCLICAL_COLUMNS}, date_time=_NTZ)
PREDICTIONS = _struct(symbol=_S, pred_key=_L, date_time=_NTZ, predictions=_D)
TICKS = _struct(symbol=_S, ts=_NTZ, bid=_D, ask=_D)
ARTICLES = _struct(title=_S, date=_S, summary=_S, link=_S)

# The eight inputs of the scoring model, in order, and the first prediction key.
MODEL_INPUT = [
    "open", "hist_close", "others_cr", "trend_ema_fast", "trend_ema_slow",
    "trend_ichimoku_base", "trend_sma_fast", "volatility_kcl",
]
FIRST_PREDICTION_KEY = 100986
