"""Date features, grids, scaling, splits."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tidebars.catalog.common import BARS, FINANCIAL, bars, financial, r, rounded, table
from tidebars.catalog.indicators_recursive import ORACLES as RECURSIVE
from tidebars.catalog.indicators_recursive import QUERIES as RECURSIVE_QUERIES
from tidebars.functions import scalar as S
from tidebars.operators import features as X
from tidebars.operators import profile as R
from tidebars.operators.indicators import ALL_COLUMNS
from tidebars.plans.history import selected_features
from tidebars.plans.models import mean_forecast
from tidebars.session import stage


def _date_parts(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", *[x.alias(n) for n, x in S.date_parts("ts").items()])


def _cyclical(parity: bool):
    def run(spark, sf_dir):
        b = bars(spark, sf_dir)
        return rounded(b.select("symbol", "date_time", *[x.alias(n) for n, x in S.cyclical("date_time", parity).items()]))

    return run


def _linspace(spark, sf_dir):
    ends = table(spark, sf_dir, "events").groupBy("event_type").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    grid = ends.select("event_type", F.posexplode(S.linspace(F.col("lo"), F.col("hi"), 101)).alias("i", "x"))
    return rounded(grid)


def _logspace(spark, sf_dir):
    """Each event type beside the penalty grid scaled by its mean value."""
    means = table(spark, sf_dir, "events").groupBy("event_type").agg(F.avg("value").alias("m"))
    grid = means.select("event_type", "m", F.posexplode(S.logspace(-4.0, 4.0, 50)).alias("i", "a"))
    return rounded(grid.select("event_type", "i", (F.col("a") * F.col("m")).alias("x")), 4)


def _replace_zero(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", S.replace_zero(F.col("value")).alias("value"))


def _round_label(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return parts.select("p_partkey", F.format_string("PSI Score: %.1f", F.round("p_retailprice", 0)).alias("label"))


def _rows(spark, sf_dir):
    """Bars in time order over all symbols, with ``row``, and their number."""
    b = stage(bars(spark, sf_dir))
    return X.with_row(b), b.count()


def _scaled(spark, sf_dir):
    return rounded(X.standard_scale(financial(spark, sf_dir), ["tick_vol", "close", "hist_close"]).select(
        "symbol", "date_time", "tick_vol", "close", "hist_close"))


def _scaled_on_train(spark, sf_dir):
    """Scaled by the moments of the training slice alone."""
    df, n = _rows(spark, sf_dir)
    df = X.time_split(df, n)
    out = X.standard_scale(df, ["close", "high"], df.filter(F.col("slice") == "train"))
    return rounded(out.select("symbol", "date_time", "slice", "close", "high"))


def _time_split(spark, sf_dir):
    df, n = _rows(spark, sf_dir)
    return X.time_split(df, n).select("symbol", "date_time", F.col("row").cast("bigint").alias("position"), "slice")


def _train_subset(spark, sf_dir):
    df, n = _rows(spark, sf_dir)
    return X.train_subset(df, X.split_sizes(n)[0]).select("symbol", "date_time", "close")


def _folds(spark, sf_dir):
    df, n = _rows(spark, sf_dir)
    return X.with_fold(df, n, 5).groupBy("block").agg(
        F.count(F.lit(1)).alias("n"), F.min("date_time").alias("first"), F.max("date_time").alias("last"))


def _mean_forecast(spark, sf_dir):
    fin = stage(financial(spark, sf_dir).withColumnRenamed("pos", "position"))
    sizes = fin.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    return rounded(mean_forecast(fin, sizes))


def _corr_select_all(spark, sf_dir):
    """The indicators that move with the close, all 86 compared with it in one pass."""
    wide = RECURSIVE_QUERIES["indicators_all"](spark, sf_dir)
    closes = bars(spark, sf_dir).select("symbol", "date_time", "close")
    return rounded(R.corr_select(wide.join(closes, ["symbol", "date_time"]), ALL_COLUMNS, "close", 0.5), 4)


def _corr_matrix_all(spark, sf_dir):
    """All pairs of 86 columns with nulls of their own: 7,396 in one pass."""
    return rounded(R.corr_matrix(RECURSIVE_QUERIES["indicators_all"](spark, sf_dir), ALL_COLUMNS), 4)


def _selected_features(spark, sf_dir):
    """The screen of all indicators a bar before: the chosen ones and how they move with the close. The limit is low, as ticks here follow none."""
    return rounded(selected_features(bars(spark, sf_dir), at_least=0.02)[1], 3)


QUERIES = {
    "corr_select_all": _corr_select_all,
    "corr_matrix_all": _corr_matrix_all,
    "selected_features": _selected_features,
    "date_parts": _date_parts,
    "cyclical": _cyclical(False),
    "cyclical_parity": _cyclical(True),
    "linspace": _linspace,
    "logspace": _logspace,
    "replace_zero": _replace_zero,
    "round_label": _round_label,
    "scaled": _scaled,
    "scaled_on_train": _scaled_on_train,
    "time_split": _time_split,
    "train_subset": _train_subset,
    "folds": _folds,
    "mean_forecast": _mean_forecast,
}

_PARTS = {
    "month": "month(date_time)", "hour": "hour(date_time)", "day": "day(date_time)", "day_of_week": "(isodow(date_time) - 1)",
}


def _cyclical_sql(parity: bool) -> str:
    columns = []
    for name, x in _PARTS.items():
        for suffix in ("sin", "cos"):
            f = "sin" if parity else suffix
            angle = f"{x} * {2 * math.pi!r} / {S.PERIODS[name]}.0"
            columns.append(f"{r(f'{f}({angle})')} AS {name}_{suffix}")
    return f"WITH {FINANCIAL} SELECT symbol, date_time, {', '.join(columns)} FROM financial"


_ROWS = f"""{FINANCIAL}, n AS (SELECT count(*) AS n FROM financial),
  sz AS (SELECT n, n - ceil(n * 0.05) AS test_from FROM n),
  cutoffs AS (SELECT n, test_from, test_from - ceil(test_from * 0.055) AS val_from FROM sz),
  rows AS (SELECT *, row_number() OVER (ORDER BY date_time, symbol) - 1 AS position FROM financial),
  split AS (SELECT rows.*, val_from, CASE WHEN position < val_from THEN 'train' WHEN position < test_from THEN 'val' ELSE 'test' END AS slice
            FROM rows, cutoffs)"""
ORACLES = {
    "date_parts": """SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
        CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week FROM events""",
    "cyclical": _cyclical_sql(False),
    "cyclical_parity": _cyclical_sql(True),
    "linspace": f"""WITH e AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM events GROUP BY 1)
        SELECT event_type, CAST(i AS INTEGER) AS i, {r('lo + (hi - lo) / 100 * i')} AS x FROM e, (SELECT unnest(range(101)) AS i) g""",
    "logspace": f"""WITH e AS (SELECT event_type, avg(value) AS m FROM events GROUP BY 1)
        SELECT event_type, CAST(i AS INTEGER) AS i, {r('power(10.0, -4 + 8.0 / 49 * i) * m', 4)} AS x FROM e, (SELECT unnest(range(50)) AS i) g""",
    "replace_zero": "SELECT event_id, CASE WHEN value = 0 THEN 1e-6 ELSE value END AS value FROM events",
    "round_label": "SELECT p_partkey, 'PSI Score: ' || format('{:.1f}', round(p_retailprice, 0)) AS label FROM part",
    "scaled": f"WITH {FINANCIAL} SELECT symbol, date_time, " + ", ".join(
        r(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()") + f" AS {c}" for c in ("tick_vol", "close", "hist_close")) + " FROM financial",
    "scaled_on_train": f"""WITH {_ROWS}, m AS (SELECT avg(close) AS mc, stddev_pop(close) AS sc, avg(high) AS mh, stddev_pop(high) AS sh
        FROM split WHERE slice = 'train')
        SELECT symbol, date_time, slice, {r('(close - mc) / sc')} AS close, {r('(high - mh) / sh')} AS high FROM split, m""",
    "time_split": f"WITH {_ROWS} SELECT symbol, date_time, position, slice FROM split",
    "train_subset": f"WITH {_ROWS} SELECT symbol, date_time, close FROM split WHERE position < floor(val_from * 0.1)",
    "folds": f"""WITH {_ROWS} SELECT CAST(greatest(0, 6 - ceil((n - position) / (n // 6)::DOUBLE)) AS INTEGER) AS block, count(*) AS n,
        min(date_time) AS first, max(date_time) AS last FROM rows, n GROUP BY 1""",
    "mean_forecast": f"""WITH {FINANCIAL}, z AS (SELECT *, pos >= floor(count(*) OVER (PARTITION BY symbol) * 0.85) AS test FROM financial),
        f AS (SELECT symbol, avg(close) AS forecast FROM z WHERE NOT test GROUP BY 1)
        SELECT z.symbol, {r('forecast')} AS forecast, count(*) AS n_test, {r('avg(power(close - forecast, 2))')} AS mse,
               {r('sqrt(avg(power(close - forecast, 2)))')} AS rmse FROM z JOIN f ON f.symbol = z.symbol WHERE test GROUP BY z.symbol, forecast""",
}

_ALL = ", ".join(ALL_COLUMNS)
# the columns that the other query shows as logarithms, in their own unit
_PLAIN = {c: f"sign({c}) * (exp(abs({c})) - 1)" for c in ("volume_em", "volume_sma_em", "volume_vpt")} | {"volume_nvi": "exp(volume_nvi)"}
_WIDE = f"WITH {BARS}, o AS MATERIALIZED ({RECURSIVE['indicators_all']}), wide AS (SELECT o.*, b.close FROM o JOIN bars b USING (symbol, date_time))"
ORACLES |= {
    "corr_select_all": f"""{_WIDE} SELECT feature, {r('r', 4)} AS r FROM (
        SELECT unnest({ALL_COLUMNS!r}) AS feature, unnest([{', '.join(f'corr({c}, close)' for c in ALL_COLUMNS)}]) AS r FROM wide)
        WHERE abs(r) >= 0.5 AND isfinite(r)""",
    "corr_matrix_all": f"""{_WIDE}, pairs AS (SELECT unnest({ALL_COLUMNS!r}) AS feature_x, unnest(
        [{', '.join('[' + ', '.join(f'corr({a}, {b})' for b in ALL_COLUMNS) + ']' for a in ALL_COLUMNS)}]) AS rs FROM wide)
        SELECT feature_x, unnest({ALL_COLUMNS!r}) AS feature_y, unnest(list_transform(rs, lambda x: CASE WHEN isfinite(x) THEN {r('x', 4)} END)) AS r FROM pairs""",
    "selected_features": f"""{_WIDE}, lagged AS (SELECT close, {', '.join(
          f"lag({_PLAIN.get(c, c)}) OVER (PARTITION BY symbol ORDER BY date_time) AS {c}" for c in ALL_COLUMNS)} FROM wide)
        SELECT feature, {r('r', 3)} AS r FROM (
          SELECT unnest({ALL_COLUMNS!r}) AS feature, unnest([{', '.join(f'corr({c}, close)' for c in ALL_COLUMNS)}]) AS r FROM lagged)
        WHERE abs(r) >= 0.02 AND isfinite(r)""",
}
