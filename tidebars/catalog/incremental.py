"""Incremental loads and streams, checked against the batch result."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from tidebars.catalog.common import BARS, FINANCIAL, bars, financial, over, predictions, r, roll, rounded, table
from tidebars.catalog.indicators_recursive import ORACLES as RECURSIVE
from tidebars.catalog.indicators_recursive import _avg, _ema, _join, _pick
from tidebars.catalog.indicators_window import _TR
from tidebars.catalog.profiling import _DOANE, _POOL, _psi_sql
from tidebars.operators.relational import high_water_mark
from tidebars.plans import hourly, load
from tidebars.plans import models as P
from tidebars.plans import scoring
from tidebars.session import shared_dir, stage
from tidebars.sources import tables as T
from tidebars.sources.files import filter_before
from tidebars.streaming import bars as B
from tidebars.operators.indicators import TECHNICAL_COLUMNS
from tidebars.streaming.stateful import closing_row, indicator_sink, indicator_stream

_RECIPES = ["sma", "ema", "macd", "kama", "obv", "returns"]
_COLUMNS = [
    "trend_sma_fast", "trend_ema_fast", "trend_ema_slow", "trend_macd_signal", "momentum_kama", "volume_obv", "others_cr",
]


def _load(spark, sf_dir):
    """Three runs, each past the marks that the run before has carried on."""
    folder = _paths(spark, "load")[0]
    source = stage(bars(spark, sf_dir))
    for until in (*_BOUNDS, None):
        load.hourly_load(spark, folder, source if until is None else filter_before(source, until), _RECIPES, _COLUMNS, chunk_rows=256)
    return rounded(load.loaded(spark, folder, "technical").select("symbol", "date_time", *_COLUMNS))


_BOUNDS = ("2024-01-16 00:00:00", "2024-01-22 07:00:00")


def _hourly(spark, sf_dir):
    """Three runs into the three tables; the second breaks off before its commit and is repeated."""
    folder = _paths(spark, "hourly")[0]
    source = stage(bars(spark, sf_dir))
    for until in (*_BOUNDS, None):
        landed = source if until is None else filter_before(source, until)
        if until == _BOUNDS[1]:
            broken = load.runs.Run(spark, folder, load.runs.newest(spark, folder))  # what a run leaves that broke off
            for name in ("financial", "technical"):
                broken.write(name, load.loaded(spark, folder, name).limit(50).withColumn("ym", F.lit("2024-01")), ("symbol", "ym"))
        load.hourly_load(spark, folder, landed.unionByName(landed.limit(20)), chunk_rows=256)
    assert load.hourly_load(spark, folder, source) is None
    tables = [load.loaded(spark, folder, name) for name in load.TABLES]
    joined = tables[0].join(tables[1], ["symbol", "date_time"]).join(tables[2], ["symbol", "date_time"])
    return rounded(joined.select(
        "symbol", "date_time", "fin_key", "tech_key", "date_key", "close", "hist_close", "trend_ema_fast", "trend_ema_slow",
        "trend_sma_fast", "volume_obv", "others_cr", "momentum_kama", "hour_sin", "hour_cos"))


def _hourly_runs(spark, sf_dir):
    """What the runs say of themselves, without the times they took."""
    folder = _paths(spark, "runs")[0]
    source = stage(bars(spark, sf_dir))
    for until in (*_BOUNDS, None):
        load.hourly_load(spark, folder, source if until is None else filter_before(source, until), ["sma"])
    return load.run_log(spark, folder).filter("read_s > 0 AND indicators_s > 0 AND write_s > 0").select("run", "rows", "first", "last", "last_key")


def _many_runs(spark, sf_dir):
    """A run for each three days, with two folders of a level merged at once; every seventh hour lands a run late."""
    folder = _paths(spark, "many")[0]
    source = stage(bars(spark, sf_dir))
    turn = F.least(F.floor(_days(source) / 3), F.lit(9)) + F.when(F.hour("date_time") % 7 == 0, 1).otherwise(0)
    source = stage(source.withColumn("_turn", turn))
    for number in range(11):
        load.hourly_load(spark, folder, source.filter(F.col("_turn") == number), ["sma"], fan=2)
    known = load.runs.newest(spark, folder)
    assert all(len(parts) <= 4 for parts in known.folders.values()), known.folders
    rows = load.loaded(spark, folder, "financial").select("symbol", "date_time", "close", F.lit(False).alias("late"), "fin_key")
    return rows.unionByName(load.loaded(spark, folder, load.LATE).select(
        "symbol", "date_time", "close", F.lit(True).alias("late"), F.lit(None).cast("bigint").alias("fin_key")))


def _events_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return raw.select(F.col("event_type").alias("symbol"), "ts", F.col("value").alias("price"), "event_id")


def _paths(spark, name):
    base = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    return f"{base}/out", f"{base}/state"


def _stream_bars(spark, sf_dir):
    out, state = _paths(spark, "stream")
    stream = B.bar_stream(_events_stream(spark, sf_dir))
    B.run_batches(stream, state, B.append_sink(out)).awaitTermination()
    return spark.read.parquet(out).select("symbol", "date_time", "open", "high", "low", "close", "tick_vol")


def _landed_stream(spark, b, turn, n_turns: int, hold: str, files: int):
    """Bars land as files in the order of their ``turn`` (0 to ``n_turns`` - 1), then a row that ends the input, ``files`` a trigger; a
    stateful stream adds the indicators.  Returns the indicator rows and the late bars."""
    landed, (out, state), late = _paths(spark, "landed")[0], _paths(spark, "indicators"), _paths(spark, "late")[0]
    b = stage(b.withColumn("_turn", turn.cast("int")))
    for k in range(n_turns):
        b.filter(F.col("_turn") == k).drop("_turn").coalesce(1).write.mode("append").parquet(landed)
    b = b.drop("_turn")
    closing_row(b, b.agg(F.max("date_time")).first()[0], hold).write.mode("append").parquet(landed)
    stream = spark.readStream.schema(b.schema).option("maxFilesPerTrigger", files).parquet(landed)
    B.run_batches(indicator_stream(stream, hold), state, indicator_sink(out, late)).awaitTermination()
    return spark.read.parquet(out), late


def _days(b):
    """Days since the first bar of all."""
    first = b.agg(F.min("date_time")).first()[0]
    return F.floor((F.unix_seconds(F.col("date_time").cast("timestamp")) - F.unix_seconds(F.lit(first).cast("timestamp"))) / 86_400)


HOLD = "6 days"


def _indicator_rows(spark, sf_dir):
    """Runs of three days, pairwise in the wrong order, each split in two: as far out of order as ``HOLD``."""
    b = stage(bars(spark, sf_dir))
    run = F.least(F.floor(_days(b) / 3), F.lit(9)).cast("int")
    swapped = run + 1 - 2 * (run % 2)
    return _landed_stream(spark, b, 2 * swapped + F.col("tick_vol") % 2, 20, HOLD, 3)[0]


def _stream_indicators(spark, sf_dir):
    return rounded(_indicator_rows(spark, sf_dir).select(
        "symbol", "date_time", "hist_close", "trend_ema_fast", "trend_ema_slow", "volume_obv", "others_cr",
        F.ln("volatility_atr").alias("ln_atr")))


def _stream_technical(spark, sf_dir):
    """All stored columns; the volume trend, which spans many magnitudes, as a logarithm."""
    done = _indicator_rows(spark, sf_dir).select("symbol", "date_time", *TECHNICAL_COLUMNS)
    return rounded(done.withColumn("volume_vpt", F.signum("volume_vpt") * F.log1p(F.abs("volume_vpt"))))


def _stream_score(spark, sf_dir):
    """A stream of feature rows is scored and stored; a second run adds nothing."""
    landed, (out, state) = _paths(spark, "features")[0], _paths(spark, "scored")
    fin = financial(spark, sf_dir).filter(F.col("pos") > 0).select("symbol", "date_time", "close", "hist_close")
    T.append_rows(fin, landed)
    stored = spark.read.parquet(landed)
    model = P.linear_pipeline(["hist_close"], "close").fit(stored)
    for _ in range(2):
        stream = spark.readStream.schema(stored.drop("ym").schema).parquet(landed)
        B.run_batches(stream, state, B.scoring_sink(model, out)).awaitTermination()
    return rounded(spark.read.parquet(out).select("symbol", "date_time", "pred_key", "predictions"))


def _score_new(spark, sf_dir):
    """Rows past the last stored prediction get the next keys."""
    fin = stage(financial(spark, sf_dir).filter(F.col("pos") > 0))
    model = P.linear_pipeline(["hist_close"], "close").fit(fin)
    first = stage(scoring.score_new(model, filter_before(fin, "2024-01-29 00:00:00"), None))
    rest = scoring.score_new(model, fin, first, "2024-01-01 00:00:00")
    return rounded(rest.select("symbol", "date_time", "pred_key", "predictions"))


def _mark(spark, sf_dir):
    b = bars(spark, sf_dir)
    mark = high_water_mark(filter_before(b, "2024-01-20 00:00:00"))
    return b.filter(F.col("date_time") > F.lit(mark).cast("timestamp_ntz")).select("symbol", "date_time", "close")


def _late(spark, sf_dir):
    """Ticks that arrive for bars already stored."""
    stored = filter_before(bars(spark, sf_dir), "2024-01-05 00:00:00")
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol"), "ts", "event_id")
    return B.late_ticks(events, stored).select("symbol", "event_id")


def _late_bars(spark, sf_dir):
    """The bars of every fifth hour land two triggers after their time, the others in order: those behind what was applied by then are late."""
    b = stage(bars(spark, sf_dir))
    turn = F.least(F.floor(_days(b) / 3), F.lit(9)) + F.when(F.hour("date_time") % 5 == 0, 2).otherwise(0)
    on_time, late = _landed_stream(spark, b, turn, 12, "1 day", 1)
    both = on_time.select("symbol", "date_time", "close", F.lit(False).alias("late")).unionByName(
        spark.read.parquet(late).select("symbol", "date_time", "close", F.lit(True).alias("late")))
    return both


def _metrics(spark, sf_dir):
    """Rows written per run, measured by the write itself."""
    out = _paths(spark, "metrics")[0]
    seen_rows, watch = hourly.observed(bars(spark, sf_dir), "load")
    T.append_rows(seen_rows, out)
    seen = watch.get
    return spark.createDataFrame([(seen["rows"], seen["first"], seen["last"])], "n bigint, first timestamp_ntz, last timestamp_ntz")


def _report(spark, sf_dir):
    fin = stage(financial(spark, sf_dir))
    out = scoring.report(predictions(fin), fin, "2024-01-10 00:00:00", "2024-01-20 00:00:00")
    return rounded(out.select("bins", "psi", "status", "rmse"))


QUERIES = {
    "incremental_load": _load,
    "hourly_load": _hourly,
    "hourly_runs": _hourly_runs,
    "many_runs": _many_runs,
    "stream_bars": _stream_bars,
    "stream_indicators": _stream_indicators,
    "stream_technical": _stream_technical,
    "stream_score": _stream_score,
    "score_new": _score_new,
    "high_water_mark": _mark,
    "late_data": _late,
    "late_bars": _late_bars,
    "run_metrics": _metrics,
    "monitor_range": _report,
}

_KAMA = RECURSIVE["kama"]
_ATR = _pick(
    f", t AS (SELECT *, {_TR} AS tr FROM num), t0 AS (SELECT *, avg(tr) {over(10)} AS tr0 FROM t)"
    + _avg("g", "t0", "tr", 0.1, 9, 9, "tr0"), {"ln_atr": "ln(g.y)"}, _join("g"))
_ADDED = (
    _ema("f", "num", "close", 12) + _ema("s", "num", "close", 26)
    + ", m AS (SELECT s.symbol, s.date_time, s.pos, f.y - s.y AS x FROM f JOIN s ON f.symbol = s.symbol AND f.pos = s.pos)"
    + _ema("g", "m", "x", 9, 25)
    + f", sm AS (SELECT symbol, date_time, pos, {roll('avg', 'close', 12)} AS y, sum(CASE WHEN close < c1 THEN -tick_vol ELSE tick_vol END)"
    " OVER (PARTITION BY symbol ORDER BY pos) AS obv, first_value(close) OVER (PARTITION BY symbol ORDER BY pos) AS c0 FROM num)"
)
_RANGE = "p.date_time BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'"
_CR = "100 * (n.close - sm.c0) / nullif(sm.c0, 0)"
_MODEL = f"""{FINANCIAL}, t AS (SELECT *, row_number() OVER (ORDER BY date_time, symbol) AS k FROM financial WHERE pos > 0),
  f AS (SELECT regr_slope(close, hist_close) AS b, regr_intercept(close, hist_close) AS a FROM t)"""
_SCORES = f"SELECT symbol, date_time, 100985 + k AS pred_key, {r('a + b * hist_close')} AS predictions FROM t, f"

_RUN = f"""CASE WHEN date_time < TIMESTAMP '{_BOUNDS[0]}' THEN 1 WHEN date_time < TIMESTAMP '{_BOUNDS[1]}' THEN 2 ELSE 3 END"""
_LOADED = f"""WITH k AS ({_KAMA}), o AS ({_pick(_ADDED, {
    'close': 'n.close', 'hist_close': 'coalesce(n.c1, 0)', 'trend_ema_fast': 'f.y', 'trend_ema_slow': 's.y', 'trend_sma_fast': 'sm.y',
    'volume_obv': 'sm.obv', 'others_cr': _CR}, _join('f', 's', 'sm'))}),
    a AS (SELECT *, row_number() OVER (ORDER BY {_RUN}, date_time, symbol) AS key FROM o)
    SELECT a.* EXCLUDE (key), key AS fin_key, key AS tech_key, key AS date_key, k.momentum_kama,
      {r("sin(hour(a.date_time) * 2 * pi() / 24.0)")} AS hour_sin, {r("cos(hour(a.date_time) * 2 * pi() / 24.0)")} AS hour_cos
    FROM a JOIN k ON k.symbol = a.symbol AND k.date_time = a.date_time"""
ORACLES = {
    "hourly_load": _LOADED,
    "hourly_runs": f"""WITH {BARS}, x AS (SELECT {_RUN} AS run, * FROM bars), g AS (
        SELECT CAST(run AS INTEGER) AS run, count(*) AS rows, min(date_time) AS first, max(date_time) AS last FROM x GROUP BY 1)
        SELECT *, CAST(sum(rows) OVER (ORDER BY run) AS BIGINT) AS last_key FROM g""",
    # a bar is late if its symbol has a stored bar that is as new: all bars of a run are held against the newest of the runs before
    "many_runs": f"""WITH {BARS}, b AS (
        SELECT symbol, date_time, close, least(date_diff('second', (SELECT min(date_time) FROM bars), date_time) // 259200, 9)
          + CASE WHEN hour(date_time) % 7 = 0 THEN 1 ELSE 0 END AS run FROM bars),
      top AS (SELECT symbol, run, max(date_time) AS newest FROM b GROUP BY ALL),
      m AS (SELECT b.*, (SELECT max(newest) FROM top WHERE top.symbol = b.symbol AND top.run < b.run) AS mark FROM b),
      k AS (SELECT *, coalesce(date_time <= mark, false) AS late FROM m),
      n AS (SELECT *, row_number() OVER (ORDER BY run, date_time, symbol) AS key FROM k WHERE NOT late)
      SELECT symbol, date_time, close, late, key AS fin_key FROM n UNION ALL SELECT symbol, date_time, close, late, NULL FROM k WHERE late""",
    "incremental_load": f"""WITH k AS ({_KAMA}), o AS ({_pick(_ADDED, {
        'trend_sma_fast': 'sm.y', 'trend_ema_fast': 'f.y', 'trend_ema_slow': 's.y', 'trend_macd_signal': 'g.y',
        'volume_obv': 'sm.obv', 'others_cr': _CR}, _join('f', 's', 'g', 'sm'))})
        SELECT o.*, k.momentum_kama FROM o JOIN k ON k.symbol = o.symbol AND k.date_time = o.date_time""",
    # closed bars: their end is not after the newest event less the delay
    "stream_bars": f"""WITH {BARS} SELECT symbol, date_time, open, high, low, close, tick_vol FROM bars
        WHERE date_time + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""",
    "stream_indicators": f"""WITH a AS ({_ATR}), o AS ({_pick(_ADDED, {
        'hist_close': 'coalesce(n.c1, 0)', 'trend_ema_fast': 'f.y', 'trend_ema_slow': 's.y', 'volume_obv': 'sm.obv',
        'others_cr': _CR}, _join('f', 's', 'sm'))})
        SELECT o.*, a.ln_atr FROM o JOIN a ON a.symbol = o.symbol AND a.date_time = o.date_time""",
    "stream_technical": f"""SELECT symbol, date_time, {', '.join(TECHNICAL_COLUMNS)} FROM ({RECURSIVE['indicators_all']}) o
       """,
    "stream_score": f"WITH {_MODEL} {_SCORES}",
    "score_new": f"WITH {_MODEL} {_SCORES} WHERE date_time >= TIMESTAMP '2024-01-29'",
    "high_water_mark": f"""WITH {BARS} SELECT symbol, date_time, close FROM bars
        WHERE date_time > (SELECT max(date_time) FROM bars WHERE date_time < TIMESTAMP '2024-01-20')""",
    "late_data": "SELECT event_type AS symbol, event_id FROM events WHERE ts < TIMESTAMP '2024-01-05'",
    # one trigger a turn: by the end of a turn a symbol's bars are applied up to a day before its newest, or before the newest of
    # the turns before; a bar is late if a newer one of its symbol was applied before its turn
    "late_bars": f"""WITH {BARS}, t AS (
        SELECT symbol, date_time, close, least(date_diff('second', (SELECT min(date_time) FROM bars), date_time) // 259200, 9)
          + CASE WHEN hour(date_time) % 5 = 0 THEN 2 ELSE 0 END AS turn FROM bars),
      turns AS (SELECT unnest(range(0, 12)) AS turn), symbols AS (SELECT DISTINCT symbol FROM t),
      reached AS (SELECT symbols.symbol, turns.turn, greatest(
          (SELECT max(t.date_time) FROM t WHERE t.symbol = symbols.symbol AND t.turn <= turns.turn),
          (SELECT max(t.date_time) FROM t WHERE t.turn < turns.turn)) - INTERVAL 1 DAY AS until FROM symbols, turns),
      applied AS (SELECT r.symbol, r.turn, max(t.date_time) AS last FROM reached r
          JOIN t ON t.symbol = r.symbol AND t.turn <= r.turn AND t.date_time <= r.until GROUP BY ALL)
      SELECT t.symbol, t.date_time, t.close, coalesce(t.date_time <= a.last, false) AS late
      FROM t LEFT JOIN applied a ON a.symbol = t.symbol AND a.turn = t.turn - 1""",
    "monitor_range": _psi_sql(
        _POOL.replace("f.date_time = p.date_time)", f"f.date_time = p.date_time WHERE {_RANGE})"), _DOANE,
        f", CASE WHEN psi > 0.25 THEN 'red' ELSE 'green' END AS status, "
        f"(SELECT {r('sqrt(avg(power(close - predictions, 2)))')} FROM scored) AS rmse"),
    "run_metrics": f"WITH {BARS} SELECT count(*) AS n, min(date_time) AS first, max(date_time) AS last FROM bars",
}
