"""Joins, unions, ordering, positions, signals."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidebars.catalog.common import BARS, FINANCIAL, NUM, bars, financial, predictions, r, roll, rounded, series, table, ticks
from tidebars.operators import relational as R
from tidebars.operators.asof import as_of_join
from tidebars.operators.indicators import add_indicators
from tidebars.operators.profile import corr_select
from tidebars.operators.signals import bracket_levels, trade_signal
from tidebars.session import stage
from tidebars.sources.files import filter_after, filter_before


def _technical(spark, sf_dir):
    return add_indicators(series(spark, sf_dir), ["sma", "ichimoku"]).result(
        "trend_sma_fast", "trend_ichimoku_base"
    )


def _fin_tech(spark, sf_dir):
    joined = R.join_fin_tech(bars(spark, sf_dir), _technical(spark, sf_dir))
    return rounded(joined.orderBy("symbol", "date_time"))


def _fin_tech_since(spark, sf_dir):
    fin = financial(spark, sf_dir)
    columns = ["open", "hist_close", "close", "trend_sma_fast", "trend_ichimoku_base"]
    return rounded(R.join_fin_tech(fin, _technical(spark, sf_dir), "2024-01-20 00:00:00", columns))


def _pred_actual(spark, sf_dir):
    fin = stage(financial(spark, sf_dir))
    return rounded(R.join_pred_actual(predictions(fin), fin).orderBy("symbol", "date_time"))


def _unscored(spark, sf_dir):
    fin = stage(financial(spark, sf_dir))
    scored = filter_before(predictions(fin), "2024-01-25 00:00:00")
    return R.unscored_rows(fin, scored).select("symbol", "date_time", "close")


def _after_mark(spark, sf_dir):
    fin = stage(financial(spark, sf_dir))
    scored = filter_before(predictions(fin), "2024-01-25 00:00:00")
    return R.rows_after_mark(fin, scored, "2024-01-01 00:00:00").select("symbol", "date_time", "close")


def _quotes(spark, sf_dir):
    """The ticks as quotes with a spread of 0.02."""
    return ticks(spark, sf_dir).select("symbol", "ts", F.col("price").alias("bid"), (F.col("price") + 0.02).alias("ask"))


def _live(spark, sf_dir):
    s = add_indicators(series(spark, sf_dir), ["sma", "ichimoku"])
    features = s.result("open", "trend_sma_fast", "trend_ichimoku_base")
    return rounded(R.live_row(features, _quotes(spark, sf_dir), ["open", "trend_sma_fast", "trend_ichimoku_base"]))


def _context(spark, sf_dir):
    b = stage(bars(spark, sf_dir))
    stored = filter_before(b, "2024-01-28 00:00:00")
    new = filter_after(b, "2024-01-27 23:00:00")
    return R.union_context(R.latest_n_per_symbol(stored, 30), new).select("symbol", "date_time", "close")


def _names(spark, sf_dir):
    """Names picked from two families that share a column and hold the target."""
    b = stage(bars(spark, sf_dir))
    first = corr_select(b, ["open", "high", "close"], "close", 0.3)
    second = corr_select(b, ["high", "low", "tick_vol"], "close", 0.3)
    return R.union_names([first, second], "close")


def _pooled(spark, sf_dir):
    fin = stage(financial(spark, sf_dir))
    return R.pool(fin, fin, "close", "hist_close").groupBy("side").agg(
        F.count("value").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )


def _latest(spark, sf_dir):
    return R.latest_n(bars(spark, sf_dir), 30, "symbol")


def _latest_per_symbol(spark, sf_dir):
    return R.latest_n_per_symbol(bars(spark, sf_dir), 10)


def _position(spark, sf_dir):
    return R.with_position(bars(spark, sf_dir)).select("symbol", "date_time", F.col("position").cast("bigint").alias("position"))


def _slice(spark, sf_dir):
    return R.slice_range(bars(spark, sf_dir), 100, 199).select("symbol", "date_time", "close")


def _signals(spark, sf_dir):
    """Every tick as a quote against the average of its hour as prediction."""
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    q = _quotes(spark, sf_dir).withColumn("date_time", hour)
    mean = q.groupBy("symbol", "date_time").agg(F.avg("bid").alias("prediction"))
    return trade_signal(q.join(mean, ["symbol", "date_time"]))


def _signal_rows(spark, sf_dir):
    return rounded(_signals(spark, sf_dir).select("symbol", "ts", "bid", "ask", "side"))


def _brackets(spark, sf_dir):
    placed = bracket_levels(_signals(spark, sf_dir))
    return rounded(placed.select("symbol", "ts", "side", "price", "take_profit", "stop_loss", "volume"))


def _closed(spark, sf_dir):
    """Bars by the time they closed."""
    closed = (F.col("date_time") + F.expr("INTERVAL 1 HOUR")).alias("closed")
    return bars(spark, sf_dir).select("symbol", closed, "close", "tick_vol")


def _asof_quotes(spark, sf_dir):
    """Every tick with the last bar of its symbol that had closed by then."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp_ntz").alias("ts"))
    return as_of_join(events, _closed(spark, sf_dir), ["symbol"], "ts", "closed")


def _asof_recent(spark, sf_dir):
    """The same for bars that closed before the tick and half an hour before it at most."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp_ntz").alias("ts"))
    return as_of_join(events, _closed(spark, sf_dir), ["symbol"], "ts", "closed", exclusive=True, within="30 minutes")


QUERIES = {
    "asof_quotes": _asof_quotes,
    "asof_recent": _asof_recent,
    "join_fin_tech": _fin_tech,
    "join_fin_tech_since": _fin_tech_since,
    "pred_vs_actual": _pred_actual,
    "unscored": _unscored,
    "rows_after_mark": _after_mark,
    "live_row": _live,
    "union_context": _context,
    "selected_names": _names,
    "pooled": _pooled,
    "latest_n": _latest,
    "latest_n_per_symbol": _latest_per_symbol,
    "row_position": _position,
    "slice_range": _slice,
    "head_rows": lambda spark, sf_dir: R.head(bars(spark, sf_dir), 5, "date_time", "symbol"),
    "tail_rows": lambda spark, sf_dir: R.tail(bars(spark, sf_dir), 96, "date_time", "symbol"),
    "top_values": lambda spark, sf_dir: R.frequent_values(table(spark, sf_dir, "events"), "value"),
    "bottom_values": lambda spark, sf_dir: R.frequent_values(table(spark, sf_dir, "events"), "value", least=True),
    "value_counts": lambda spark, sf_dir: R.value_counts(table(spark, sf_dir, "lineitem"), "l_quantity"),
    "signals": _signal_rows,
    "brackets": _brackets,
}

_TECH = f"""{FINANCIAL}, technical AS (SELECT symbol, date_time, {roll('avg', 'close', 12)} AS trend_sma_fast,
  ({roll('max', 'high', 26)} + {roll('min', 'low', 26)}) / 2 AS trend_ichimoku_base FROM num)"""
_LAST = "(SELECT max(date_time) FROM predictions WHERE date_time < TIMESTAMP '2024-01-25')"
_QUOTES = """q AS (SELECT event_type AS symbol, ts, time_bucket(INTERVAL '1 hour', ts) AS date_time, value AS bid,
  value + 0.02::DOUBLE AS ask FROM events),
s AS (SELECT q.*, m.prediction, CASE WHEN ask <> 0 AND bid <> 0 THEN
        CASE WHEN ask < m.prediction THEN 'BUY' WHEN ask > m.prediction THEN 'SELL' END END AS side
      FROM q JOIN (SELECT symbol, date_time, avg(bid) AS prediction FROM q GROUP BY 1, 2) m
      ON q.symbol = m.symbol AND q.date_time = m.date_time)"""
_SIDE = "CASE WHEN side = 'BUY' THEN 0.001::DOUBLE ELSE -0.001::DOUBLE END"

_CLOSED = f"WITH {BARS}, c AS (SELECT symbol, date_time + INTERVAL 1 HOUR AS closed, close, tick_vol FROM bars)"
ORACLES = {
    "asof_quotes": f"""{_CLOSED} SELECT e.event_id, e.event_type AS symbol, e.ts, c.closed, c.close, c.tick_vol
        FROM events e ASOF LEFT JOIN c ON c.symbol = e.event_type AND c.closed <= e.ts""",
    "asof_recent": f"""{_CLOSED} SELECT e.event_id, e.event_type AS symbol, e.ts, x.closed, x.close, x.tick_vol
        FROM events e LEFT JOIN (SELECT e.event_id, c.* FROM events e ASOF JOIN c ON c.symbol = e.event_type AND c.closed < e.ts) x
        ON x.event_id = e.event_id AND x.closed >= e.ts - INTERVAL 30 MINUTE""",
    "join_fin_tech": f"""WITH {_TECH} SELECT f.symbol, f.date_time, {r('open')} AS open, {r('high')} AS high, {r('low')} AS low,
        {r('close')} AS close, tick_vol, {r('trend_sma_fast')} AS trend_sma_fast, {r('trend_ichimoku_base')} AS trend_ichimoku_base
        FROM financial f JOIN technical t ON f.symbol = t.symbol AND f.date_time = t.date_time""",
    "join_fin_tech_since": f"""WITH {_TECH} SELECT f.symbol, f.date_time, {r('open')} AS open, {r('hist_close')} AS hist_close,
        {r('close')} AS close, {r('trend_sma_fast')} AS trend_sma_fast, {r('trend_ichimoku_base')} AS trend_ichimoku_base
        FROM financial f JOIN technical t ON f.symbol = t.symbol AND f.date_time = t.date_time
        WHERE f.date_time > TIMESTAMP '2024-01-20'""",
    "pred_vs_actual": f"""WITH {FINANCIAL} SELECT f.symbol, f.date_time, {r('predictions')} AS predictions, {r('close')} AS close
        FROM predictions p JOIN financial f ON f.symbol = p.symbol AND f.date_time = p.date_time""",
    "unscored": f"""WITH {FINANCIAL} SELECT symbol, date_time, close FROM financial f WHERE NOT EXISTS (
        SELECT 1 FROM predictions p WHERE p.symbol = f.symbol AND p.date_time = f.date_time AND p.date_time < TIMESTAMP '2024-01-25')""",
    "rows_after_mark": f"WITH {FINANCIAL} SELECT symbol, date_time, close FROM financial WHERE date_time > {_LAST}",
    "live_row": f"""WITH {_TECH}, b AS (SELECT event_type AS symbol, arg_max(value, ts) AS bid FROM events GROUP BY 1)
        SELECT t.symbol, t.date_time, {r('bid')} AS open, {r('trend_sma_fast')} AS trend_sma_fast,
               {r('trend_ichimoku_base')} AS trend_ichimoku_base, {r('bid')} AS bid, {r('bid + 0.02::DOUBLE')} AS ask
        FROM technical t JOIN b ON b.symbol = t.symbol
        WHERE (t.symbol, t.date_time) IN (SELECT symbol, max(date_time) FROM technical GROUP BY 1)""",
    "union_context": f"""WITH {BARS} SELECT symbol, date_time, close FROM (
        SELECT *, row_number() OVER (PARTITION BY symbol, date_time < TIMESTAMP '2024-01-28' ORDER BY date_time DESC) AS k FROM bars) x
        WHERE k <= 30 OR date_time >= TIMESTAMP '2024-01-28'""",
    "selected_names": f"""WITH {BARS} SELECT feature FROM (
        SELECT 'open' AS feature, corr(open, close) AS r FROM bars UNION SELECT 'high', corr(high, close) FROM bars
        UNION SELECT 'low', corr(low, close) FROM bars UNION SELECT 'tick_vol', corr(tick_vol, close) FROM bars) x
        WHERE abs(r) >= 0.3""",
    "pooled": f"""WITH {FINANCIAL} SELECT 0 AS side, count(close) AS n, min(close) AS low, max(close) AS high FROM financial
        UNION ALL SELECT 1, count(hist_close), min(hist_close), max(hist_close) FROM financial""",
    "latest_n": f"WITH {BARS} SELECT * FROM bars ORDER BY date_time DESC, symbol LIMIT 30",
    "latest_n_per_symbol": f"""WITH {BARS} SELECT symbol, date_time, open, high, low, close, tick_vol FROM (
        SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date_time DESC) AS k FROM bars) x WHERE k <= 10""",
    "row_position": f"WITH {NUM} SELECT symbol, date_time, pos AS position FROM num",
    "slice_range": f"WITH {NUM} SELECT symbol, date_time, close FROM num WHERE pos BETWEEN 100 AND 199",
    "head_rows": f"WITH {BARS} SELECT * FROM bars ORDER BY date_time, symbol LIMIT 5",
    "tail_rows": f"WITH {BARS} SELECT * FROM bars ORDER BY date_time DESC, symbol DESC LIMIT 96",
    "top_values": "SELECT value, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, value LIMIT 10",
    "bottom_values": "SELECT value, count(*) AS n FROM events GROUP BY 1 ORDER BY n, value LIMIT 10",
    "value_counts": "SELECT l_quantity, count(*) AS n FROM lineitem GROUP BY 1",
    "signals": f"WITH {_QUOTES} SELECT symbol, ts, {r('bid')} AS bid, {r('ask')} AS ask, side FROM s",
    "brackets": f"""WITH {_QUOTES} SELECT symbol, ts, side, {r("CASE WHEN side = 'BUY' THEN ask ELSE bid END")} AS price,
        {r(f'ask + {_SIDE}')} AS take_profit, {r(f'ask - ({_SIDE})')} AS stop_loss, {r('0.01')} AS volume
        FROM s WHERE side IS NOT NULL""",
}
