"""Sources, typing, filters, table maintenance."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from tidebars.catalog.common import BARS, NUM, bars, financial, r, rounded, series, table
from tidebars.functions import schemas
from tidebars.functions.scalar import plus_hours, to_numeric, to_timestamp
from tidebars.operators.layout import keyless_rows
from tidebars.operators.windows import lag_fill
from tidebars.session import shared_dir
from tidebars.sources import files, news
from tidebars.sources import tables as T


def _scratch(spark, name: str) -> str:
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def _text_bars(spark, sf_dir):
    """The bars as the nine text columns of an export."""
    b = bars(spark, sf_dir)
    text = [F.col(c).cast("string").alias(c) for c in ("open", "high", "low", "close", "tick_vol")]
    return b.select(
        "symbol", F.date_format("date_time", "yyyy.MM.dd").alias("date"),
        F.date_format("date_time", "HH:mm:ss").alias("time"), *text,
        F.lit("0").alias("vol"), F.lit("3").alias("spread"),
    )


def _typed_bars(spark, sf_dir):
    """Write exports (one folder of files per symbol), read them back, type them."""
    path = _scratch(spark, "export")
    columns = schemas.BARS_TSV.fieldNames()
    _text_bars(spark, sf_dir).select("symbol", *columns).write.partitionBy("symbol").csv(path, sep="\t", header=True)
    raw = files.read_bars_tsv(spark, f"{path}/*/*.csv")
    folder = F.regexp_extract(F.input_file_name(), r"symbol=([^/]+)/", 1)
    return files.type_bars(raw.withColumn("symbol", folder))


def _cutoff(spark, sf_dir):
    return files.type_bars(_text_bars(spark, sf_dir), "2024-01-20 00:00:00").drop("vol", "spread")


def _epoch_bars(spark, sf_dir):
    b = bars(spark, sf_dir)
    rates = b.select(
        "symbol", F.unix_seconds(F.col("date_time").cast("timestamp")).alias("time"), "open", "high", "low", "close",
        F.col("tick_vol").alias("tick_volume"), F.lit(3).alias("spread"), F.lit(0).alias("real_volume"),
    )
    start, stop = 1704412800, 1705622400  # 2024-01-05 to 2024-01-19, both included
    return files.rates_to_bars(rates.filter(F.col("time").between(start, stop)))


def _news(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    wrapped = events.select(F.concat(F.lit('{"news_results":['), "props", F.lit("]}")).alias("json"))
    items = news.explode_news(wrapped, "json", "STRUCT<k: BIGINT>")
    return items.groupBy("k").agg(F.count(F.lit(1)).alias("n"))


def _json_path(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", news.json_path("props", "$.k").cast("bigint").alias("k"))


def _articles(spark, sf_dir):
    return news.page_articles(table(spark, sf_dir, "pages"))


def _article_elements(spark, sf_dir):
    return news.extract_articles(table(spark, sf_dir, "pages"))


def _typed_text(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"), F.col("ts").cast("string").alias("text"),
        F.col("value").cast("string").alias("value"), "props",
    )
    return to_numeric(events.withColumn("date_time", to_timestamp("text")).drop("text"))


def _since(spark, sf_dir):
    return files.filter_after(bars(spark, sf_dir), "2024-01-15 12:00:00")


def _from(spark, sf_dir):
    return files.slice_from(bars(spark, sf_dir), "2024-01-15 12:00:00").select("symbol", "date_time", "close")


def _at(spark, sf_dir):
    return files.point_lookup(bars(spark, sf_dir), "2024-01-10 05:00:00", "symbol", "close")


def _dedup(spark, sf_dir):
    hourly = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("date_time"),
        "event_id", "value", "user_id",
    )
    return files.dedup_bars(hourly, "event_id")


def _dense(spark, sf_dir):
    s = series(spark, sf_dir, lookback=300)
    s = s.add(sma_12=s.rolling(F.avg, "close", 12), sma_300=s.rolling(F.avg, "close", 300), prev=s.lag("close"))
    wide = s.result()
    n = wide.count()
    names = files.dense_columns(wide, ["sma_12", "sma_300", "prev"], int(n * 0.8))
    return rounded(files.fill_zero(wide.select("symbol", "date_time", *names), *names))


def _projected(spark, sf_dir):
    b = files.drop_columns(bars(spark, sf_dir), "tick_vol", "no_such_column")
    b = files.rename_by_position(b, ["pair", "at", "o", "h", "l", "c"])
    return b.select(*files.exclude_columns(b, "o"))


def _next_hour(spark, sf_dir):
    return bars(spark, sf_dir).select("symbol", "date_time", plus_hours("date_time").alias("next_hour"))


def _surrogate(spark, sf_dir):
    b = bars(spark, sf_dir).select("symbol", "date_time", "close")
    return T.surrogate_key(b, "pred_key", schemas.FIRST_PREDICTION_KEY)


def _schema_change(spark, sf_dir):
    """Store bars without and later with a column, read both as one table."""
    path = _scratch(spark, "schema")
    b = financial(spark, sf_dir)
    T.create_table(spark, path, b.drop("hist_close", "pos").schema)
    old = files.filter_before(b, "2024-01-10 00:00:00").drop("hist_close", "pos")
    new = b.filter(F.col("date_time") >= F.lit("2024-01-10").cast("timestamp_ntz")).drop("pos")
    old.write.mode("append").parquet(path)
    T.add_column(new, "hist_close", "double").write.mode("append").parquet(path)
    merged = spark.read.option("mergeSchema", True).parquet(path)
    return files.drop_columns(merged, "tick_vol").select("symbol", "date_time", "close", "hist_close")


def _append(spark, sf_dir):
    """Append the same bars twice: the second time adds nothing."""
    path = _scratch(spark, "bars")
    b = bars(spark, sf_dir)
    T.append_new(files.filter_before(b, "2024-01-20 00:00:00"), path)
    T.append_new(b, path)
    T.append_new(b, path)
    return files.read_table(spark, path).select("symbol", "date_time", "open", "high", "low", "close", "tick_vol")


def _saved_csv(spark, sf_dir):
    path = _scratch(spark, "features")
    b = lag_fill(series(spark, sf_dir), "close", "hist_close", 0.0).result("close", "open", "hist_close")
    files.write_table(b.drop("symbol"), path, "csv")
    return files.read_features_csv(spark, path, ["date_time", "close", "open", "hist_close"])


def _keyless(spark, sf_dir):
    """Bars whose time or symbol is missing, as exports may have them."""
    b = bars(spark, sf_dir)
    lost = b.withColumn("date_time", F.when(F.col("tick_vol") % 7 != 0, F.col("date_time"))).withColumn(
        "symbol", F.when(F.col("tick_vol") % 5 != 0, F.col("symbol")))
    return keyless_rows(lost).select("symbol", "date_time", "close")


def _truncated(spark, sf_dir):
    """A table emptied and filled again."""
    path = _scratch(spark, "truncated")
    b = bars(spark, sf_dir)
    T.append_rows(b, path)
    T.truncate_table(spark, path)
    T.append_rows(files.filter_before(b, "2024-01-10 00:00:00"), path)
    return files.read_table(spark, path).select("symbol", "date_time", "close")


def _column_dropped(spark, sf_dir):
    path = _scratch(spark, "narrower")
    T.append_rows(bars(spark, sf_dir), path)
    T.drop_column(spark, path, "tick_vol", "no_such_column")
    return spark.read.parquet(path).select("*").drop("ym")


QUERIES = {
    "keyless_rows": _keyless,
    "truncate_table": _truncated,
    "drop_column": _column_dropped,
    "bars_hourly": bars,
    "bars_daily": lambda spark, sf_dir: bars(spark, sf_dir, "1 day"),
    "typed_bars": _typed_bars,
    "typed_text": _typed_text,
    "epoch_bars": _epoch_bars,
    "features_csv": _saved_csv,
    "news_json": _news,
    "json_path": _json_path,
    "articles": _articles,
    "article_elements": _article_elements,
    "cutoff": _cutoff,
    "since_mark": _since,
    "slice_from": _from,
    "point_lookup": _at,
    "dense_columns": _dense,
    "dedup": _dedup,
    "projected": _projected,
    "plus_hour": _next_hour,
    "surrogate_key": _surrogate,
    "schema_change": _schema_change,
    "append_rows": _append,
}

_ALL = "symbol, date_time, open, high, low, close, tick_vol"
ORACLES = {
    "keyless_rows": f"""WITH {BARS}, lost AS (SELECT CASE WHEN tick_vol % 5 <> 0 THEN symbol END AS symbol,
        CASE WHEN tick_vol % 7 <> 0 THEN date_time END AS date_time, close FROM bars)
        SELECT * FROM lost WHERE symbol IS NULL OR date_time IS NULL""",
    "truncate_table": f"WITH {BARS} SELECT symbol, date_time, close FROM bars WHERE date_time < TIMESTAMP '2024-01-10'",
    "drop_column": f"WITH {BARS} SELECT symbol, date_time, open, high, low, close FROM bars",
    "bars_hourly": f"WITH {BARS} SELECT {_ALL} FROM bars",
    "bars_daily": f"WITH {BARS.replace('1 hour', '1 day')} SELECT {_ALL} FROM bars",
    "typed_bars": f"""WITH {BARS} SELECT symbol, date_time, open, high, low, close, CAST(tick_vol AS INTEGER) AS tick_vol,
        CAST(0 AS BIGINT) AS vol, 3 AS spread FROM bars""",
    "typed_text": """SELECT event_type AS symbol, value, TRY_CAST(props AS DOUBLE) AS props, ts AS date_time FROM events""",
    "epoch_bars": f"WITH {BARS} SELECT {_ALL} FROM bars WHERE date_time BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-19'",
    "features_csv": f"WITH {NUM} SELECT date_time, close, open, coalesce(c1, 0) AS hist_close FROM num",
    "news_json": "SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1",
    "json_path": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "articles": """SELECT page_id, nullif(regexp_extract(a, '(?s)<h1>(.*?)</h1>', 1), '') AS title, CAST(NULL AS VARCHAR) AS date,
        nullif(regexp_extract(a, '(?s)<p>(.*?)</?p>', 1), '') AS summary, url AS link
        FROM (SELECT *, unnest(regexp_extract_all(html, '(?s)<article(?:\\s[^>]*)?>(.*?)(?:</article>|\\z)', 1)) AS a FROM pages) x""",
    "article_elements": """SELECT CAST(NULL AS VARCHAR) AS title, CAST(NULL AS VARCHAR) AS date, CAST(NULL AS VARCHAR) AS summary,
        nullif(regexp_extract(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<a href="([^"]*)"', 1), '') AS link
        FROM pages WHERE html LIKE '%<article>%'""",
    "cutoff": f"""WITH {BARS} SELECT symbol, date_time, open, high, low, close, CAST(tick_vol AS INTEGER) AS tick_vol
        FROM bars WHERE date_time < TIMESTAMP '2024-01-20'""",
    "since_mark": f"WITH {BARS} SELECT {_ALL} FROM bars WHERE date_time > TIMESTAMP '2024-01-15 12:00:00'",
    "slice_from": f"WITH {BARS} SELECT symbol, date_time, close FROM bars WHERE date_time >= TIMESTAMP '2024-01-15 12:00:00'",
    "point_lookup": f"WITH {BARS} SELECT symbol, close FROM bars WHERE date_time = TIMESTAMP '2024-01-10 05:00:00'",
    "dense_columns": f"""WITH {NUM} SELECT symbol, date_time, {r('coalesce(CASE WHEN pos >= 11 THEN avg(close) OVER (PARTITION BY symbol ORDER BY date_time ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) END, 0)')} AS sma_12,
        {r('coalesce(c1, 0)')} AS prev FROM num""",
    "dedup": """SELECT event_type AS symbol, date_trunc('hour', ts) AS date_time, max(event_id) AS event_id,
        arg_max(value, event_id) AS value, arg_max(user_id, event_id) AS user_id FROM events GROUP BY 1, 2""",
    "projected": f"WITH {BARS} SELECT symbol AS pair, date_time AS at, high AS h, low AS l, close AS c FROM bars",
    "plus_hour": f"WITH {BARS} SELECT symbol, date_time, date_time + INTERVAL 1 HOUR AS next_hour FROM bars",
    "surrogate_key": f"""WITH {BARS} SELECT symbol, date_time, close,
        100985 + row_number() OVER (ORDER BY date_time, symbol) AS pred_key FROM bars""",
    "schema_change": f"""WITH {NUM} SELECT symbol, date_time, close,
        CASE WHEN date_time >= TIMESTAMP '2024-01-10' THEN coalesce(c1, 0) END AS hist_close FROM num""",
    "append_rows": f"WITH {BARS} SELECT {_ALL} FROM bars",
}
