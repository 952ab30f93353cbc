import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidebars.functions import schemas
from tidebars.operators import relational as R
from tidebars.operators.indicators import TECHNICAL_COLUMNS
from tidebars.plans import load
from tidebars.plans import models as P
from tidebars.plans import scoring
from tidebars.plans.history import technical_table
from tidebars.sources import runs, files, news
from tidebars.sources import tables as T
from tidebars.sources.ticks import bars_from_ticks
from tidebars.streaming import bars as B
from tidebars.streaming.stateful import closing_row, indicator_sink, indicator_stream

HEADER = "<DATE>\t<TIME>\t<OPEN>\t<HIGH>\t<LOW>\t<CLOSE>\t<TICKVOL>\t<VOL>\t<SPREAD>\n"


def test_tab_separated_export(spark, tmp_path):
    rows = "2008.01.02\t00:00:00\t1.1\t1.2\t1.0\t1.15\t100\t0\t5\n2024.07.27\t00:00:00\t1\t1\t1\t1\t1\t0\t1\nbad\trow\tx\t1\t1\t1\t1\t0\t1\n"
    (tmp_path / "usdcad h1.csv").write_text(HEADER + rows)
    (tmp_path / "eurcad h1.csv").write_text(HEADER + rows.splitlines()[0] + "\n")
    raw = files.read_bars_tsv(spark, str(tmp_path))
    assert raw.columns[:9] == schemas.BARS_TSV.fieldNames() and raw.count() == 4
    typed = files.type_bars(raw, "2024-07-27 00:00:00").orderBy("symbol").collect()
    assert [(r["symbol"], r["date_time"], r["close"], r["tick_vol"]) for r in typed] == [
        ("EURCAD", dt.datetime(2008, 1, 2), 1.15, 100), ("USDCAD", dt.datetime(2008, 1, 2), 1.15, 100)]
    assert files.type_bars(raw).filter("date_time IS NULL AND open IS NULL").count() == 1


def test_rates_range(spark, tmp_path):
    rates = spark.createDataFrame([(t, 1.0, 2.0, 0.5, 1.5, 9, 1, 0) for t in (0, 3600, 7200)], schemas.RATES)
    rates.write.parquet(str(tmp_path / "r"))
    rows = files.read_rates(spark, str(tmp_path / "r"), 3600, 7200).orderBy("date_time").collect()
    assert [r["date_time"] for r in rows] == [dt.datetime(1970, 1, 1, 1), dt.datetime(1970, 1, 1, 2)]
    assert rows[0].asDict().keys() == {"date_time", "open", "high", "low", "close", "tick_vol"}


def test_news_json(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"news_results": [{"title": "x", "link": "l"}, {"title": "y"}]}')
    (tmp_path / "b.json").write_text('{"error": "none"}')
    rows = news.read_news_json(spark, str(tmp_path), "STRUCT<title: STRING, link: STRING>").orderBy("title").collect()
    assert [(r["title"], r["link"]) for r in rows] == [("x", "l"), ("y", None)]
    (tmp_path / "only").mkdir()
    (tmp_path / "only" / "b.json").write_text('{"error": "none"}')
    assert news.read_news_json(spark, str(tmp_path / "only")).count() == 0


def test_articles(spark):
    page = """<html><div class="article big"><h3 class="title">A &amp; B<br>C</h3><span class="date">May 1</span>
      <p class="summary">One <b>two</b> three</p><a href="/one">more</a><a href="/two">x</a></div>
      <p class="title">outside</p><div class="article"><a>no link</a><p class="title">Second</p></div></html>"""
    rows = news.extract_articles(spark.createDataFrame([(page,), (None,), ("",)], "html string")).collect()
    assert [tuple(r) for r in rows] == [
        ("A & BC", "May 1", "One two three", "/one"), ("Second", None, None, None)]


def test_dedup_keeps_the_newest(make_bars):
    bars = make_bars([("a", 0, 1, 1, 1, 1, 1), ("a", 0, 2, 2, 2, 2, 2), ("a", 1, 3, 3, 3, 3, 3)]).withColumn("load", F.col("tick_vol"))
    rows = files.dedup_bars(bars, "load").orderBy("date_time").collect()
    assert [(r["close"], r["load"]) for r in rows] == [(2.0, 2), (3.0, 3)]
    assert files.dedup_bars(bars, "load").columns == bars.columns


def test_tables(spark, make_bars, tmp_path):
    path = str(tmp_path / "t")
    T.create_table(spark, path, schemas.FINANCIAL_DATA)
    T.create_table(spark, path, schemas.FINANCIAL_DATA)
    table = T.read_fixed(spark, path, schemas.FINANCIAL_DATA)
    assert table.count() == 0
    bars = make_bars([(s, h, 1, 1, 1, 1, 1) for h in range(30) for s in "ab"])
    keyed = T.surrogate_key(bars, "pred_key", schemas.FIRST_PREDICTION_KEY)
    first = keyed.filter(F.col("pred_key") < 100986 + 40)
    assert first.count() == 40
    rest = T.surrogate_key(bars.join(first, ["symbol", "date_time"], "left_anti"), "pred_key", 1, stored=first)
    assert sorted(r["pred_key"] for r in rest.collect()) == list(range(100986 + 40, 100986 + 60))
    out = str(tmp_path / "bars")
    T.append_new(bars.filter("symbol = 'a'"), out)
    T.append_new(bars, out)
    T.append_new(bars, out)
    assert spark.read.parquet(out).count() == 60


def test_unscored_rows_fill_gaps(spark, make_bars):
    bars = make_bars([("a", h, 1, 1, 1, 1, 1) for h in range(10)])
    scored = bars.filter(F.hour("date_time").isin(0, 1, 2, 5)).withColumn("predictions", F.lit(1.0))
    assert [r["date_time"].hour for r in R.unscored_rows(bars, scored).orderBy("date_time").collect()] == [3, 4, 6, 7, 8, 9]
    after = R.rows_after_mark(bars, scored, "2024-01-01 00:00:00")
    assert sorted(r["date_time"].hour for r in after.collect()) == [6, 7, 8, 9]
    none = R.rows_after_mark(bars, scored.limit(0), "2024-01-01 07:00:00")
    assert sorted(r["date_time"].hour for r in none.collect()) == [8, 9]


def test_live_signal_path(spark, make_bars):
    bars = make_bars([("a", h, h, h, h, 2 * h, 1) for h in range(10)])
    model = P.linear_pipeline(["open"], "close").fit(bars)
    ticks = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 1, 9, m), 20.0 + m, 20.5 + m) for m in range(3)], schemas.TICKS)
    row = scoring.live_signals(model, bars.select("symbol", "date_time", "open"), ticks, ["open"]).first()
    assert row["bid"] == 22.0 and row["prediction"] == pytest.approx(44.0) and row["side"] == "BUY"
    assert row["price"] == 22.5 and row["take_profit"] == pytest.approx(22.501)


def _ticks(spark, rows):
    start = dt.datetime(2024, 1, 1)
    data = [(s, start + dt.timedelta(minutes=m), float(p), i) for i, (s, m, p) in enumerate(rows)]
    return spark.createDataFrame(data, "symbol string, ts timestamp_ntz, price double, event_id bigint")


def test_stream_emits_closed_bars_and_drops_late_ticks(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    first = [("a", m, m) for m in range(0, 600, 10)]
    second = [("a", 5, 999.0)] + [("a", m, m) for m in range(600, 900, 10)]  # one tick far too late
    third = [("a", m, m) for m in range(900, 1000, 10)]
    for rows in (first, second, third):
        _ticks(spark, rows).coalesce(1).write.mode("append").parquet(src)
        stream = B.bar_stream(B.tick_stream(spark, src, _ticks(spark, rows).schema, 1))
        B.run_batches(stream, state, B.append_sink(out)).awaitTermination()
    got = {r["date_time"].hour: r for r in spark.read.parquet(out).collect()}
    assert set(got) == set(range(14))  # last tick 16:30, delay two hours
    assert got[0]["high"] == 50 and got[0]["tick_vol"] == 6 and got[3]["open"] == 180
    batch = bars_from_ticks(_ticks(spark, first + second[1:] + third), tie="event_id").collect()
    for r in batch:
        if r["date_time"].hour in got:
            assert got[r["date_time"].hour]["close"] == r["close"]


def test_stateful_indicators_continue_over_batches(spark, walk, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    bars = walk(60)
    for low, high in ((0, 20), (20, 21), (15, 60)):  # the last batch repeats five bars
        start = F.lit("2024-01-01").cast("timestamp_ntz")
        part = bars.filter((F.col("date_time") >= start + F.expr(f"INTERVAL {low} HOUR")) & (F.col("date_time") < start + F.expr(f"INTERVAL {high} HOUR")))
        part.coalesce(1).write.mode("append").parquet(src)
        stream = indicator_stream(spark.readStream.schema(bars.schema).option("maxFilesPerTrigger", 1).parquet(src), "0 seconds")
        B.run_batches(stream, state, indicator_sink(out, out + "-late")).awaitTermination()
    rows = spark.read.parquet(out).orderBy("date_time").collect()
    closes = [r["close"] for r in bars.orderBy("date_time").collect()]
    assert len(rows) == 60
    e = None
    for t, (r, c) in enumerate(zip(rows, closes)):
        e = c if e is None else e + (c - e) * 2 / 13
        assert r["close"] == c and r["trend_ema_fast"] == (pytest.approx(e) if t >= 11 else None)


@pytest.mark.parametrize("a_trigger", [1, 3, 100])
def test_bars_in_any_file_order_are_applied_in_time_order(spark, walk, tmp_path, a_trigger):
    src, out, late, state = (str(tmp_path / n) for n in ("src", "out", "late", "state"))
    bars = walk(240, ("a", "b"))
    for low in (20, 0, 40, 80, 60, 100, 140, 120, 160, 200, 180, 220):
        start = F.lit("2024-01-01").cast("timestamp_ntz")
        part = bars.filter((F.col("date_time") >= start + F.expr(f"INTERVAL {low} HOUR")) & (F.col("date_time") < start + F.expr(f"INTERVAL {low + 20} HOUR")))
        part.coalesce(1).write.mode("append").parquet(src)
    stream = indicator_stream(spark.readStream.schema(bars.schema).option("maxFilesPerTrigger", a_trigger).parquet(src), "41 hours")
    B.run_batches(stream, state, indicator_sink(out, late)).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 2 * (240 - 41) and spark.read.schema(bars.schema).parquet(late).count() == 0 if os.path.exists(late) else True
    want = {(r["symbol"], r["date_time"]): r for r in technical_table(bars).collect()}
    for r in got.collect():
        other = want[r["symbol"], r["date_time"]]
        for c in TECHNICAL_COLUMNS:
            assert r[c] == (None if other[c] is None else pytest.approx(other[c], rel=1e-9, abs=1e-9)), c


def test_bars_that_come_too_late_are_set_apart(spark, walk, tmp_path):
    src, out, late, state = (str(tmp_path / n) for n in ("src", "out", "late", "state"))
    bars = walk(60)
    missing = F.col("date_time") == F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")
    for part in (bars.filter(~missing), bars.filter(missing)):
        part.coalesce(1).write.mode("append").parquet(src)
        stream = indicator_stream(spark.readStream.schema(bars.schema).parquet(src))
        B.run_batches(stream, state, indicator_sink(out, late)).awaitTermination()
    assert spark.read.parquet(out).count() == 57
    assert [str(r["date_time"]) for r in spark.read.parquet(late).collect()] == ["2024-01-01 10:00:00"]


def test_all_articles_of_a_page(spark):
    html = '<article class="x"><h1>A</h1><p>one</p></article><div></div><article><h1>B</h1></article><article><p>cut'
    pages = spark.createDataFrame([(1, "u", html), (2, "v", "no article"), (3, "w", None)], "page_id bigint, url string, html string")
    got = [(r["page_id"], r["title"], r["summary"], r["link"]) for r in news.page_articles(pages).collect()]
    assert got == [(1, "A", "one", "u"), (1, "B", None, "u"), (1, None, None, "u")]


def test_keys_number_all_rows(spark, make_bars):
    bars = make_bars([(s, 0, 1, 1, 1, 1, 1) for s in "abcdefgh"] + [("a", h, 1, 1, 1, 1, 1) for h in range(1, 30)])
    broken = bars.unionByName(bars.limit(3).withColumn("date_time", F.lit(None).cast("timestamp_ntz")))
    rows = T.surrogate_key(broken, "k", 5).orderBy("k").collect()
    assert [r["k"] for r in rows] == list(range(5, 45))
    assert [r["date_time"] is None for r in rows] == [True] * 3 + [False] * 37
    times = [(r["date_time"], r["symbol"]) for r in rows[3:]]
    assert times == sorted(times)


def test_tables_are_rewritten(spark, make_bars, tmp_path):
    path = str(tmp_path / "t")
    bars = make_bars([(s, h, 1, 1, 1, 1, 1) for h in range(30) for s in "ab"])
    T.append_new(bars.unionByName(bars), path)
    assert spark.read.parquet(path).count() == 60
    assert "tick_vol" not in T.drop_column(spark, path, "tick_vol").columns and spark.read.parquet(path).count() == 60
    assert T.truncate_table(spark, path).count() == 0
    T.append_rows(bars.drop("tick_vol"), path)
    assert spark.read.parquet(path).count() == 60
    assert T.drop_table(spark, path) and not T.drop_table(spark, path)


def test_a_broken_run_is_not_seen_and_repeated(spark, walk, tmp_path, monkeypatch):
    folder, bars = str(tmp_path / "load"), walk(700, ("a", "b"))
    cut = F.lit("2024-01-20 03:00:00").cast("timestamp_ntz")
    load.hourly_load(spark, folder, bars.filter(F.col("date_time") < cut), ["ema", "obv"])
    seen = load.loaded(spark, folder, "financial").count()
    with monkeypatch.context() as m:
        m.setattr(load, "_carry", lambda series: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load.hourly_load(spark, folder, bars, ["ema", "obv"])
    assert {load.loaded(spark, folder, t).count() for t in load.TABLES} == {seen}
    assert load.hourly_load(spark, folder, bars.unionByName(bars.limit(9)), ["ema", "obv"])["rows"] == 1400 - seen
    assert load.hourly_load(spark, folder, bars) is None
    keys = sorted(r["tech_key"] for r in load.loaded(spark, folder, "technical").collect())
    assert keys == list(range(1, 1401))
    want = {(r["symbol"], r["date_time"]): r["trend_ema_slow"] for r in technical_table(bars).collect()}
    for r in load.loaded(spark, folder, "technical").collect():
        other = want[r["symbol"], r["date_time"]]
        assert r["trend_ema_slow"] == (None if other is None else pytest.approx(other))


def test_a_silent_symbol_and_the_end_of_input_leave_nothing_held(spark, walk, tmp_path):
    src, out, late, state = (str(tmp_path / n) for n in ("src", "out", "late", "state"))
    bars = walk(50, ("a", "b")).filter("symbol = 'a' OR hour(date_time) < 5 AND day(date_time) = 1")

    def run(part):
        part.coalesce(1).write.mode("append").parquet(src)
        stream = indicator_stream(spark.readStream.schema(bars.schema).parquet(src), "3 hours")
        B.run_batches(stream, state, indicator_sink(out, late)).awaitTermination()
        return {r["symbol"]: r["count"] for r in spark.read.parquet(out).groupBy("symbol").count().collect()}

    assert run(bars.filter("day(date_time) = 1")) == {"a": 21, "b": 5}  # b falls silent: the clock of a frees its bars
    assert run(bars.filter("day(date_time) > 1")) == {"a": 47, "b": 5}
    newest = bars.agg(F.max("date_time")).first()[0]
    assert run(closing_row(bars, newest, "3 hours")) == {"a": 50, "b": 5}
    assert spark.read.parquet(out).select("symbol", "date_time").distinct().count() == 55


def test_of_two_loads_at_once_one_commits(spark, walk, tmp_path, monkeypatch):
    folder, bars = str(tmp_path / "load"), walk(60, ("a", "b"))
    cut = F.lit("2024-01-02").cast("timestamp_ntz")
    assert load.loaded(spark, folder, "financial").count() == 0 and load.loaded(spark, folder, "late").columns == load._BARS
    load.hourly_load(spark, folder, bars.filter(F.col("date_time") < cut), ["sma"])
    carry = load._carry

    def other_first(series):  # another load commits while this one works
        monkeypatch.setattr(load, "_carry", carry)
        assert load.hourly_load(spark, folder, bars, ["sma"])["run"] == 2
        return carry(series)

    monkeypatch.setattr(load, "_carry", other_first)
    with pytest.raises(runs.Conflict):
        load.hourly_load(spark, folder, bars, ["sma"])
    assert load.loaded(spark, folder, "financial").count() == 120 and load.run_log(spark, folder).count() == 2
    names = {n for _, n in runs.newest(spark, folder).folders["financial"]}
    assert {n for n in os.listdir(f"{folder}/financial") if n[0] != "."} == names  # the loser's folders are gone
    assert not [n for n in os.listdir(f"{folder}/runs") if n.startswith("_")]


def test_folders_merge_and_late_bars_are_kept_once(spark, walk, tmp_path):
    folder, bars = str(tmp_path / "load"), walk(60, ("a", "b"))
    hour = F.hour("date_time") + 24 * (F.day("date_time") - 1)
    for at in range(0, 60, 10):
        part = bars.filter((hour >= at) & (hour < at + 10) & ~((hour == 13) & (F.col("symbol") == "a")))
        load.hourly_load(spark, folder, part.unionByName(bars.filter(hour < at)) if at == 40 else part, ["sma"], fan=2)
        known = runs.newest(spark, folder)
        run = at // 10 + 1
        assert len(known.folders["financial"]) == bin(run).count("1") and len(known.folders["carry"]) == 1
        assert load.loaded(spark, folder, "financial").count() == sum(min(10, 60 - k) * 2 for k in range(0, at + 1, 10)) - (at >= 10)
    late = [(r["symbol"], str(r["date_time"])) for r in load.loaded(spark, folder, "late").collect()]
    assert late == [("a", "2024-01-01 13:00:00")]
    assert load.hourly_load(spark, folder, bars, ["sma"], fan=2) is None  # known as late by now
    keys = sorted(r["fin_key"] for r in load.loaded(spark, folder, "financial").collect())
    assert keys == list(range(1, 120))


def test_marks_of_articles_may_have_attributes(spark):
    html = '<ARTICLE id="x"><H1 class="t">A</H1 ><p lang="en">one<p>two</article>'
    pages = spark.createDataFrame([(1, "u", html)], "page_id bigint, url string, html string")
    assert [(r["title"], r["summary"]) for r in news.page_articles(pages).collect()] == [("A", "one")]


def test_batches_are_scored_once_and_keys_go_on(spark, walk, tmp_path):
    path, bars = str(tmp_path / "scored"), walk(80, ("a", "b")).withColumn("hist_close", F.col("open"))
    model = P.linear_pipeline(["hist_close"], "close").fit(bars)
    early = F.col("date_time") < F.lit("2024-01-02").cast("timestamp_ntz")
    for part in (bars.filter(early), bars.filter(early), bars):
        scoring.score_batch(model, part, path)
    rows = spark.read.parquet(path).collect()
    first = schemas.FIRST_PREDICTION_KEY
    assert sorted(r["pred_key"] for r in rows) == list(range(first, first + 160)) and len({(r["symbol"], r["date_time"]) for r in rows}) == 160
