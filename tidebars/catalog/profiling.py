"""Profiles, distributions, monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidebars.catalog.common import FINANCIAL, bars, financial, predictions, r, rounded, table
from tidebars.operators import monitor as M
from tidebars.operators import profile as P
from tidebars.operators.relational import join_pred_actual
from tidebars.plans.models import model_ranking
from tidebars.session import stage

_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


def _scored(spark, sf_dir):
    fin = stage(financial(spark, sf_dir))
    return stage(join_pred_actual(predictions(fin), fin))


def _describe(spark, sf_dir):
    out = P.describe_t(_lines(spark, sf_dir), _COLUMNS)
    return rounded(out, 5)


def _outliers(spark, sf_dir):
    return P.zscore_outliers(bars(spark, sf_dir), ["open", "high", "low", "close"], ["symbol", "date_time"])


def _psi(bins):
    def run(spark, sf_dir):
        scored = _scored(spark, sf_dir)
        return rounded(M.psi(scored, scored, "close", "predictions", bins))

    return run


def _psi_sides(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    before, after = events.filter(F.col("ts") < middle), events.filter(F.col("ts") >= middle)
    return rounded(M.psi_status(M.psi(before, after, "value", bins=10)))


def _ranking(spark, sf_dir):
    """Three naive forecasts of the close, ranked by error."""
    fin = stage(financial(spark, sf_dir))
    scored = join_pred_actual(predictions(fin), fin).join(fin.select("symbol", "date_time", "hist_close", "open"), ["symbol", "date_time"])
    scores = scored.agg(
        *[F.sqrt(F.avg(M.squared_error("close", c))).alias(c) for c in ("predictions", "hist_close", "open")]
    ).unpivot([], ["predictions", "hist_close", "open"], "model", "score")
    return rounded(model_ranking(scores))


def _daily(width, slide=None):
    def run(spark, sf_dir):
        return rounded(M.monitor_window(_scored(spark, sf_dir), "close", "predictions", width, slide))

    return run


def _xy(spark, sf_dir):
    return P.xy_pairs(bars(spark, sf_dir), ["open", "high", "low", "tick_vol"], "close", ["symbol", "date_time"])


QUERIES = {
    "describe": _describe,
    "null_profile": lambda spark, sf_dir: P.schema_info(_lines(spark, sf_dir)).drop("type"),
    "schema_info": lambda spark, sf_dir: P.schema_info(table(spark, sf_dir, "events")),
    "zeros": lambda spark, sf_dir: P.zeros_per_column(_lines(spark, sf_dir), _COLUMNS),
    "count_rows": lambda spark, sf_dir: P.count_rows(table(spark, sf_dir, "orders"), "o_orderkey"),
    "corr_matrix": lambda spark, sf_dir: rounded(P.corr_matrix(_lines(spark, sf_dir), _COLUMNS)),
    "corr_select": lambda spark, sf_dir: rounded(P.corr_select(bars(spark, sf_dir), ["open", "high", "low", "tick_vol"], "close", 0.3)),
    "histogram": lambda spark, sf_dir: rounded(P.histogram(_lines(spark, sf_dir), "l_extendedprice")),
    "boxplot": lambda spark, sf_dir: rounded(P.boxplot_stats(table(spark, sf_dir, "events"), ["value"])),
    "kde": lambda spark, sf_dir: rounded(M.kde_grid(_scored(spark, sf_dir), "close", "predictions")),
    "zscore_outliers": _outliers,
    "vif_2": lambda spark, sf_dir: rounded(P.vif(_lines(spark, sf_dir), ["l_quantity", "l_extendedprice"])),
    "vif": lambda spark, sf_dir: P.vif(bars(spark, sf_dir), ["open", "high", "low", "tick_vol"]),
    "collinearity": lambda spark, sf_dir: rounded(P.collinearity_profile(_lines(spark, sf_dir), _COLUMNS)),
    "psi_fixed": _psi(10),
    "psi_doane": _psi(None),
    "psi_status": _psi_sides,
    "rmse": lambda spark, sf_dir: rounded(M.rmse(_scored(spark, sf_dir), "close", "predictions")),
    "mse": lambda spark, sf_dir: rounded(M.mse(_scored(spark, sf_dir), "close", "predictions")),
    "bic": lambda spark, sf_dir: rounded(M.bic(_scored(spark, sf_dir), "close", "predictions", 8)),
    "axis_range": lambda spark, sf_dir: rounded(P.axis_range(_scored(spark, sf_dir), "close", "predictions")),
    "xy_pairs": _xy,
    "time_line": lambda spark, sf_dir: P.time_line(bars(spark, sf_dir), ["close"]),
    "time_line_daily": lambda spark, sf_dir: rounded(P.time_line(bars(spark, sf_dir), ["close"], width="1 day")),
    "model_ranking": _ranking,
    "daily_monitor": _daily("1 day"),
    "sliding_monitor": _daily("2 days", "1 day"),
}

_SCORED = f"""{FINANCIAL}, scored AS (SELECT f.symbol, f.date_time, f.close, p.predictions, f.hist_close, f.open
  FROM predictions p JOIN financial f ON f.symbol = p.symbol AND f.date_time = p.date_time)"""
_POOL = f"""{_SCORED}, pool AS (SELECT 0 AS side, close AS v FROM scored UNION ALL SELECT 1, predictions FROM scored),
m AS (SELECT avg(v) AS mu, min(v) AS lo, max(v) AS hi, count(*) AS n FROM pool),
sk AS (SELECT avg(power(v - mu, 3)) / power(avg(power(v - mu, 2)), 1.5) AS g FROM pool, m)"""
_DOANE = """k AS (SELECT CAST(ceil(1 + log2(n) + log2(1 + abs(g) / sqrt(6.0 * (n - 2) / ((n + 1.0) * (n + 3.0))))) AS INTEGER) AS bins
  FROM m, sk)"""


def _psi_sql(pool: str, bins: str, extra: str = "") -> str:
    """``pool`` defines pool(side, v) and m(lo, hi); ``bins`` defines k(bins)."""
    return f"""WITH {pool}, {bins},
        b AS (SELECT side, least(k.bins - 1, CAST(floor((v - lo) / ((hi - lo) / k.bins)) AS INTEGER)) AS bin FROM pool, m, k),
        c AS (SELECT g.bin, count(*) FILTER (WHERE b.side = 0) AS n0, count(*) FILTER (WHERE b.side = 1) AS n1
              FROM (SELECT unnest(range(k.bins)) AS bin FROM k) g LEFT JOIN b ON b.bin = g.bin GROUP BY 1),
        s AS (SELECT CASE WHEN n0 = 0 THEN 1e-6 ELSE n0 / t0 END AS a, CASE WHEN n1 = 0 THEN 1e-6 ELSE n1 / t1 END AS z
              FROM c, (SELECT CAST(sum(n0) AS DOUBLE) AS t0, CAST(sum(n1) AS DOUBLE) AS t1 FROM c) t),
        p AS (SELECT sum((z - a) * ln(z / a)) AS psi FROM s)
        SELECT k.bins AS bins, {r('psi')} AS psi{extra} FROM p, k"""


def _union(template: str, columns: list[str]) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in columns)


def _monitor_sql(starts: str, days: int) -> str:
    return f"""WITH {_SCORED},
        w AS ({starts}),
        x AS (SELECT w.window_start, s.close, s.predictions FROM w JOIN scored s
              ON s.date_time >= w.window_start AND s.date_time < w.window_start + INTERVAL {days} DAY),
        e AS (SELECT window_start, count(*) AS n, sqrt(avg(power(close - predictions, 2))) AS rmse,
                     least(min(close), min(predictions)) AS lo, greatest(max(close), max(predictions)) AS hi FROM x GROUP BY 1),
        v AS (SELECT window_start, 0 AS side, close AS v FROM x UNION ALL SELECT window_start, 1, predictions FROM x),
        b AS (SELECT v.window_start, e.n, e.rmse, side, least(9, floor((v - lo) / ((hi - lo) / 10.0))) AS bin
              FROM v JOIN e ON e.window_start = v.window_start),
        c AS (SELECT window_start, n, rmse, bin, count(*) FILTER (WHERE side = 0) AS n0, count(*) FILTER (WHERE side = 1) AS n1
              FROM b GROUP BY 1, 2, 3, 4),
        s AS (SELECT *, CASE WHEN n0 = 0 THEN 1e-6 ELSE n0 / n::DOUBLE END AS a, CASE WHEN n1 = 0 THEN 1e-6 ELSE n1 / n::DOUBLE END AS z FROM c),
        p AS (SELECT window_start, n, rmse, sum((z - a) * ln(z / a)) AS psi FROM s GROUP BY 1, 2, 3)
        SELECT window_start, n, {r('rmse')} AS rmse, {r('psi')} AS psi, CASE WHEN psi > 0.25 THEN 'red' ELSE 'green' END AS status FROM p"""


_EVENT_TYPES = {
    "event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string",
}
_LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]

ORACLES = {
    "describe": _union(
        "SELECT '{c}' AS feature, count({c}) AS count, " + r("avg({c})", 5) + " AS mean, " + r("stddev_samp({c})", 5) + " AS std, "
        + r("min({c})", 5) + " AS min, " + ", ".join(r(f"quantile_cont({{c}}, {q})", 5) + f" AS q{int(q * 100)}" for q in (0.25, 0.5, 0.75))
        + ", " + r("max({c})", 5) + " AS max FROM lineitem", _COLUMNS),
    "null_profile": _union(
        "SELECT '{c}' AS feature, count({c}) AS n_values, count(*) - count({c}) AS n_null FROM lineitem", _LINE_COLUMNS),
    "schema_info": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, '{t}' AS type, count({c}) AS n_values, count(*) - count({c}) AS n_null FROM events"
        for c, t in _EVENT_TYPES.items()),
    "zeros": _union("SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} = 0) AS n_zero FROM lineitem", _COLUMNS),
    "count_rows": "SELECT count(o_orderkey) AS n FROM orders",
    "corr_matrix": " UNION ALL ".join(
        f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, {r(f'corr({a}, {b})')} AS r FROM lineitem" for a in _COLUMNS for b in _COLUMNS),
    "corr_select": f"WITH {FINANCIAL} SELECT feature, {r('r')} AS r FROM (" + _union(
        "SELECT '{c}' AS feature, corr({c}, close) AS r FROM financial", ["open", "high", "low", "tick_vol"]) + ") x WHERE abs(r) >= 0.3",
    "histogram": f"""WITH m AS (SELECT min(l_extendedprice) AS lo, (max(l_extendedprice) - min(l_extendedprice)) / 50 AS w FROM lineitem),
        c AS (SELECT least(49, CAST(floor((l_extendedprice - lo) / w) AS INTEGER)) AS bin, count(*) AS n FROM lineitem, m GROUP BY 1)
        SELECT CAST(g.bin AS INTEGER) AS bin, {r('lo + g.bin * w')} AS low, {r('lo + (g.bin + 1) * w')} AS high, coalesce(n, 0) AS n
        FROM (SELECT unnest(range(50)) AS bin) g CROSS JOIN m LEFT JOIN c ON c.bin = g.bin""",
    "boxplot": f"""WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2, quantile_cont(value, 0.75) AS q3 FROM events),
        f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
        SELECT 'value' AS feature, {r('any_value(q1)')} AS q25, {r('any_value(q2)')} AS q50, {r('any_value(q3)')} AS q75,
               {r('min(value) FILTER (WHERE value BETWEEN lo AND hi)')} AS whisker_low, {r('max(value) FILTER (WHERE value BETWEEN lo AND hi)')} AS whisker_high,
               count(*) FILTER (WHERE value NOT BETWEEN lo AND hi) AS n_outlier FROM events, f""",
    "kde": f"""WITH {_SCORED},
        a AS (SELECT least(min(close), min(predictions)) AS lo, greatest(max(close), max(predictions)) AS hi,
                     power(count(*), -0.2) * stddev_samp(close) AS ha, power(count(*), -0.2) * stddev_samp(predictions) AS hb,
                     count(*) AS n FROM scored),
        g AS (SELECT CAST(unnest(range(1000)) AS INTEGER) AS point),
        x AS (SELECT point, lo + point * ((hi - lo) / 999) AS x, ha, hb, n FROM g, a)
        SELECT point, {r('x')} AS x, {r(f'sum(exp(-0.5 * power((x - close) / ha, 2))) / (n * ha * sqrt(2 * pi()))')} AS density_a,
               {r(f'sum(exp(-0.5 * power((x - predictions) / hb, 2))) / (n * hb * sqrt(2 * pi()))')} AS density_b
        FROM x, scored GROUP BY point, x, ha, hb, n""",
    "zscore_outliers": f"""WITH {FINANCIAL}, z AS (SELECT """ + ", ".join(
        f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in ("open", "high", "low", "close"))
        + " FROM financial) SELECT symbol, date_time FROM financial, z WHERE "
        + " OR ".join(f"abs((financial.{c} - m_{c}) / s_{c}) >= 2" for c in ("open", "high", "low", "close")),
    "vif_2": f"""WITH c AS (SELECT corr(l_quantity, l_extendedprice) AS c FROM lineitem)
        SELECT 'l_quantity' AS feature, {r('1 / (1 - c * c)')} AS vif FROM c UNION ALL
        SELECT 'l_extendedprice', {r('1 / (1 - c * c)')} FROM c""",
    "psi_fixed": _psi_sql(_POOL, "k AS (SELECT 10 AS bins)"),
    "psi_doane": _psi_sql(_POOL, _DOANE),
    "psi_status": _psi_sql(
        """pool AS (SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END AS side, value AS v FROM events),
           m AS (SELECT min(v) AS lo, max(v) AS hi FROM pool)""", "k AS (SELECT 10 AS bins)",
        ", CASE WHEN psi > 0.25 THEN 'red' ELSE 'green' END AS status"),
    "rmse": f"WITH {_SCORED} SELECT {r('sqrt(avg(power(close - predictions, 2)))')} AS rmse FROM scored",
    "mse": f"WITH {_SCORED} SELECT {r('avg(power(close - predictions, 2))')} AS mse FROM scored",
    "bic": f"WITH {_SCORED} SELECT {r('count(*) * ln(sum(power(close - predictions, 2)) / count(*)) + 9 * ln(count(*))')} AS bic FROM scored",
    "axis_range": f"""WITH {_SCORED} SELECT {r('least(min(close), min(predictions))')} AS low,
        {r('greatest(max(close), max(predictions))')} AS high FROM scored""",
    "xy_pairs": f"WITH {FINANCIAL} " + _union(
        "SELECT symbol, date_time, close, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM financial", ["open", "high", "low", "tick_vol"]),
    "time_line": f"WITH {FINANCIAL} SELECT symbol, date_time, close FROM financial",
    "time_line_daily": f"WITH {FINANCIAL} SELECT symbol, time_bucket(INTERVAL '1 day', date_time) AS date_time, {r('avg(close)')} AS close FROM financial GROUP BY 1, 2",
    "model_ranking": f"""WITH {_SCORED}, e AS (""" + _union(
        "SELECT '{c}' AS model, sqrt(avg(power(close - {c}, 2))) AS score FROM scored", ["predictions", "hist_close", "open"])
        + f") SELECT model, {r('score')} AS score, {r('1 / score')} AS inverse, CAST(rank() OVER (ORDER BY score) AS INTEGER) AS place FROM e",
    "daily_monitor": _monitor_sql("SELECT DISTINCT time_bucket(INTERVAL '1 day', date_time) AS window_start FROM scored", 1),
    "sliding_monitor": _monitor_sql(
        "SELECT DISTINCT time_bucket(INTERVAL '1 day', date_time) + d * INTERVAL 1 DAY AS window_start FROM scored, (VALUES (0), (-1)) o(d)", 2),
}


def _determinant(rows: list[int], columns: list[int], cell) -> str:
    """The determinant of a small matrix, written out by its first row."""
    if not rows:
        return "1.0"
    first, rest = rows[0], rows[1:]
    terms = [f"{'-' if k % 2 else '+'} {cell(first, c)} * ({_determinant(rest, columns[:k] + columns[k + 1:], cell)})" for k, c in enumerate(columns)]
    return " ".join(terms)


def _cell(i: int, j: int) -> str:
    return "1.0" if i == j else f"r{min(i, j)}{max(i, j)}"


_ALL = list(range(len(_COLUMNS)))
_PAIRS = [(i, j) for i in _ALL for j in _ALL if i < j]
ORACLES["collinearity"] = "WITH c AS (SELECT " + ", ".join(f"corr({_COLUMNS[i]}, {_COLUMNS[j]}) AS r{i}{j}" for i, j in _PAIRS) + " FROM lineitem) " + " UNION ALL ".join(
    f"SELECT '{_COLUMNS[i]}' AS feature, {r('greatest(' + ', '.join(f'abs({_cell(i, j)})' for j in _ALL if j != i) + ')')} AS max_abs_r, "
    + r(f"({_determinant([j for j in _ALL if j != i], [j for j in _ALL if j != i], _cell)}) / ({_determinant(_ALL, _ALL, _cell)})") + " AS vif FROM c"
    for i in _ALL)
