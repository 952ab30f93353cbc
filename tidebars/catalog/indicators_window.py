"""Window operators, finite-window and cumulative indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebars.catalog.common import across_chunks, across_chunks_sql, at_chunk, NUM, over, r, roll, rounded, series
from tidebars.operators import windows as W
from tidebars.operators.expr import F as X
from tidebars.operators.indicators import add_indicators, volume
from tidebars.operators.indicators.base import apply_recipes
from tidebars.operators.layout import CHUNK_ROWS, HALO


def _recipe(name: str, columns: list[str], digits: int = 6):
    def run(spark, sf_dir):
        return rounded(add_indicators(series(spark, sf_dir), [name]).result(*columns), digits)

    return run


def _sql(columns: dict[str, str], ctes: str = "", source: str = "num", digits: int = 6) -> str:
    picks = ", ".join(f"{r(x, digits)} AS {name}" for name, x in columns.items())
    return f"WITH {NUM}{ctes} SELECT symbol, date_time, {picks} FROM {source}"


def _hist_close(spark, sf_dir):
    return W.lag_fill(series(spark, sf_dir), "close", "hist_close", 0.0).result("close", "hist_close")


def _lag_all(spark, sf_dir):
    return W.lag_all_but(series(spark, sf_dir), "close").result("open", "high", "low", "close", "tick_vol")


def _rolling(spark, sf_dir):
    s = W.rolling(
        series(spark, sf_dir), "close", 24,
        mean_24=F.avg, sum_24=F.sum, min_24=F.min, max_24=F.max, std_24=F.stddev,
    )
    return rounded(s.result("mean_24", "sum_24", "min_24", "max_24", "std_24"))


def _returns(spark, sf_dir):
    s = series(spark, sf_dir)
    s = s.add(change=W.change("close", s), log_return=W.log_return("close", s))
    return rounded(s.result("change", "log_return"))


def _cumulative(spark, sf_dir):
    s = W.cumulative(series(spark, sf_dir), "close")
    # the product spans many magnitudes: compare its logarithm
    s = s.add(ln_product=F.when(F.col("cum_product") > 0, F.ln("cum_product")))
    return rounded(s.result("cum_sum", "ln_product", "cum_return"))


def _em(spark, sf_dir):
    s = apply_recipes(series(spark, sf_dir), [lambda s: volume.em(s, scale=1.0)])
    return rounded(s.result("volume_em", "volume_sma_em"))


def _nvi(spark, sf_dir):
    s = add_indicators(series(spark, sf_dir), ["nvi"])
    return rounded(s.add(ln_nvi=F.when(F.col("volume_nvi") > 0, F.ln("volume_nvi"))).result("ln_nvi"))


def _returns_pct(spark, sf_dir):
    s = add_indicators(series(spark, sf_dir), ["returns"])
    return rounded(s.result("others_dr", "others_dlr", "others_cr"))



_BB = ["bbm", "bbh", "bbl", "bbw", "bbp", "bbhi", "bbli"]
_KC = ["kcc", "kch", "kcl", "kcw", "kcp", "kchi", "kcli"]
_DC = ["dcl", "dch", "dcm", "dcw", "dcp"]

def _rolling_long(spark, sf_dir):
    """Windows and lags beyond the usual copies of a chunk."""
    s = series(spark, sf_dir, lookback=400)
    s = s.add(sma_300=s.rolling(F.avg, "close", 300), lag_400=s.lag("close", 400))
    return rounded(s.result("sma_300", "lag_400"))


def _rolling_chain(spark, sf_dir):
    """Windows over lags of nested calls, under a quoted name: 349 rows back in all, in chunks of any size."""
    s = series(spark, sf_dir, lookback=349)
    s = s.add(**{"my col": s.lag(X.coalesce(X.abs(X.col("close") - 1.0), X.lit(0.0)), 200)})
    s = s.add(chain_mean=s.rolling(F.avg, "`my col`", 100), chain_gap=X.col("close") - X.greatest(s.lag(X.col("`my col`"), 149), X.lit(0.0)))
    return rounded(s.result("chain_mean", "chain_gap"))


def _both_sizes(run):
    """The query over bars of a second in the smallest and in the usual chunks: each row has both results."""

    def both(spark: SparkSession, sf_dir: str) -> DataFrame:
        small, usual = (at_chunk(run, rows)(spark, sf_dir) for rows in (HALO, CHUNK_ROWS))
        names = [c for c in small.columns if c not in ("symbol", "date_time")]
        return small.join(usual.withColumnsRenamed({c: f"{c}_usual" for c in names}), ["symbol", "date_time"], "full")

    return both


QUERIES = {
    "rolling_long": across_chunks(_rolling_long),
    "rolling_chain": _both_sizes(_rolling_chain),
    "hist_close": _hist_close,
    "lag_all": _lag_all,
    "rolling": _rolling,
    "returns": _returns,
    "cumulative": _cumulative,
    "volume_adi": _recipe("adi", ["volume_adi"]),
    "volume_obv": _recipe("obv", ["volume_obv"]),
    "volume_cmf": _recipe("cmf", ["volume_cmf"]),
    "volume_em": _em,
    "volume_vpt": _recipe("vpt", ["volume_vpt"], 4),
    "volume_vwap": _recipe("vwap", ["volume_vwap"]),
    "volume_mfi": _recipe("mfi", ["volume_mfi"]),
    "volume_nvi": _nvi,
    "volatility_bollinger": _recipe("bollinger", [f"volatility_{c}" for c in _BB]),
    "volatility_keltner": _recipe("keltner", [f"volatility_{c}" for c in _KC]),
    "volatility_donchian": _recipe("donchian", [f"volatility_{c}" for c in _DC]),
    "volatility_ulcer": _recipe("ulcer", ["volatility_ui"]),
    "trend_sma": _recipe("sma", ["trend_sma_fast", "trend_sma_slow"]),
    "trend_vortex": _recipe("vortex", ["trend_vortex_ind_pos", "trend_vortex_ind_neg", "trend_vortex_ind_diff"]),
    "trend_dpo": _recipe("dpo", ["trend_dpo"]),
    "trend_kst": _recipe("kst", ["trend_kst", "trend_kst_sig", "trend_kst_diff"]),
    "trend_ichimoku": _recipe(
        "ichimoku",
        ["trend_ichimoku_conv", "trend_ichimoku_base", "trend_ichimoku_a", "trend_ichimoku_b",
         "trend_visual_ichimoku_a", "trend_visual_ichimoku_b"],
    ),
    "trend_cci": _recipe("cci", ["trend_cci"]),
    "trend_aroon": _recipe("aroon", ["trend_aroon_up", "trend_aroon_down", "trend_aroon_ind"]),
    "momentum_ultimate": _recipe("ultimate", ["momentum_uo"]),
    "momentum_stochastic": _recipe("stochastic", ["momentum_stoch", "momentum_stoch_signal", "momentum_wr"]),
    "momentum_awesome": _recipe("awesome", ["momentum_ao"]),
    "momentum_roc": _recipe("roc", ["momentum_roc"]),
    "others_returns": _returns_pct,
}

_W = "OVER (PARTITION BY symbol ORDER BY date_time)"
_FLOW = "(CASE WHEN high = low THEN 0 ELSE ((close - low) - (high - close)) / (high - low) * tick_vol END)"
_TR = "greatest(high - low, coalesce(abs(high - c1), high - low), coalesce(abs(low - c1), high - low))"


def _channel(prefix: str, hi: str, lo: str, mid: str, tags: str) -> dict[str, str]:
    h, l, m, w, p, fh, fl = (f"volatility_{prefix}{t}" for t in tags.split())
    return {
        m: mid, h: hi, l: lo,
        w: f"({hi} - {lo}) / nullif({mid}, 0) * 100",
        p: f"(close - {lo}) / nullif({hi} - {lo}, 0)",
        fh: f"CASE WHEN close > {hi} THEN 1.0 ELSE 0.0 END",
        fl: f"CASE WHEN close < {lo} THEN 1.0 ELSE 0.0 END",
    }


_MID = lambda n: f"({roll('max', 'high', n)} + {roll('min', 'low', n)}) / 2"
_ROCS = ", ".join(
    f"(close - lag(close, {k}) {_W}) / nullif(lag(close, {k}) {_W}, 0) AS roc{k}" for k in (10, 15, 20, 30)
)


def _full(x: str, n: int) -> str:
    """Rolling mean over a column that has NULLs of its own."""
    return f"CASE WHEN count({x}) {over(n)} = {n} THEN avg({x}) {over(n)} END"


ORACLES = {
    "hist_close": f"WITH {NUM} SELECT symbol, date_time, close, coalesce(c1, 0) AS hist_close FROM num",
    "lag_all": f"""WITH {NUM} SELECT symbol, date_time, lag(open) {_W} AS open, h1 AS high, l1 AS low, close, v1 AS tick_vol
        FROM num""",
    "rolling_long": across_chunks_sql(_sql({"sma_300": roll("avg", "close", 300), "lag_400": "lag(close, 400) OVER (PARTITION BY symbol ORDER BY date_time)"})),
    "rolling_chain": across_chunks_sql(f"""WITH {NUM}, a AS (SELECT *, lag(coalesce(abs(close - 1), 0), 200) {_W} AS m FROM num),
        b AS (SELECT symbol, date_time, {r(_full('m', 100))} AS chain_mean, {r(f'close - greatest(lag(m, 149) {_W}, 0)')} AS chain_gap FROM a)
        SELECT symbol, date_time, chain_mean, chain_gap, chain_mean AS chain_mean_usual, chain_gap AS chain_gap_usual FROM b"""),
    "rolling": _sql({
        "mean_24": roll("avg", "close", 24), "sum_24": roll("sum", "close", 24), "min_24": roll("min", "close", 24),
        "max_24": roll("max", "close", 24), "std_24": roll("stddev_samp", "close", 24),
    }),
    "returns": _sql({
        "change": "(close - c1) / nullif(c1, 0)",
        "log_return": "CASE WHEN close > 0 AND c1 > 0 THEN ln(close / c1) END",
    }),
    "cumulative": _sql(
        {"cum_sum": f"sum(close) {_W}",
         "ln_product": f"CASE WHEN sum(CASE WHEN growth = 0 THEN 1 ELSE 0 END) {_W} = 0 THEN "
                       f"sum(coalesce(ln(nullif(growth, 0)), 0)) {_W} END",
         "cum_return": f"(close - first_value(close) {_W}) / nullif(first_value(close) {_W}, 0)"},
        ", g AS (SELECT *, CASE WHEN c1 <> 0 THEN close / c1 END AS growth FROM num)", "g"),
    "volume_adi": _sql({"volume_adi": f"sum({_FLOW}) {_W}"}),
    "volume_obv": _sql({"volume_obv": f"CAST(sum(CASE WHEN close < c1 THEN -tick_vol ELSE tick_vol END) {_W} AS DOUBLE)"}),
    "volume_cmf": _sql({"volume_cmf": f"{roll('sum', _FLOW, 20)} / nullif({roll('sum', 'tick_vol', 20)}, 0)"}),
    "volume_em": _sql(
        {"volume_em": "em", "volume_sma_em": _full("em", 14)},
        ", e AS (SELECT *, ((high - h1) + (low - l1)) * (high - low) / nullif(2.0 * tick_vol, 0) AS em FROM num)", "e"),
    "volume_vpt": _sql({"volume_vpt": f"sum(coalesce((close - c1) / nullif(c1, 0) * tick_vol, 0)) {_W}"}, digits=4),
    "volume_vwap": _sql({"volume_vwap": f"{roll('sum', 'tp * tick_vol', 14)} / nullif({roll('sum', 'tick_vol', 14)}, 0)"}),
    "volume_mfi": _sql(
        {"volume_mfi": f"100.0 * {roll('sum', 'up', 14, 1)} / nullif({roll('sum', 'up', 14, 1)} + {roll('sum', 'down', 14, 1)}, 0)"},
        f""", p AS (SELECT *, lag(tp) {_W} AS tp1 FROM num),
        f AS (SELECT *, CASE WHEN tp > tp1 THEN tp * tick_vol ELSE 0 END AS up,
                     CASE WHEN tp < tp1 THEN tp * tick_vol ELSE 0 END AS down FROM p)""", "f"),
    "volume_nvi": _sql(
        {"ln_nvi": f"CASE WHEN sum(CASE WHEN f = 0 THEN 1 ELSE 0 END) {_W} = 0 THEN ln(1000.0) + sum(ln(nullif(f, 0))) {_W} END"},
        ", f AS (SELECT *, CASE WHEN tick_vol < v1 AND c1 <> 0 THEN close / c1 ELSE 1 END AS f FROM num)", "f"),
    "volatility_bollinger": _sql(
        _channel("bb", "(m + 2 * sd)", "(m - 2 * sd)", "m", "h l m w p hi li"),
        f", b AS (SELECT *, {roll('avg', 'close', 20)} AS m, {roll('stddev_pop', 'close', 20)} AS sd FROM num)", "b"),
    "volatility_keltner": _sql(
        _channel("kc", "hh", "ll", "mm", "h l c w p hi li"),
        f""", k AS (SELECT *, {roll('avg', 'tp', 10)} AS mm, {roll('avg', '(4 * high - 2 * low + close) / 3.0', 10)} AS hh,
              {roll('avg', '(-2 * high + 4 * low + close) / 3.0', 10)} AS ll FROM num)""", "k"),
    "volatility_donchian": _sql(
        {"volatility_dcl": "ll", "volatility_dch": "hh", "volatility_dcm": "(hh + ll) / 2",
         "volatility_dcw": "(hh - ll) / nullif(m, 0) * 100", "volatility_dcp": "(close - ll) / nullif(hh - ll, 0)"},
        f", d AS (SELECT *, {roll('min', 'low', 20)} AS ll, {roll('max', 'high', 20)} AS hh, {roll('avg', 'close', 20)} AS m FROM num)", "d"),
    "volatility_ulcer": _sql(
        {"volatility_ui": f"sqrt({_full('rr', 14)})"},
        f""", t AS (SELECT *, {roll('max', 'close', 14)} AS top FROM num),
        u AS (SELECT *, power(100 * (close - top) / nullif(top, 0), 2) AS rr FROM t)""", "u"),
    "trend_sma": _sql({"trend_sma_fast": roll("avg", "close", 12), "trend_sma_slow": roll("avg", "close", 26)}),
    "trend_vortex": _sql(
        {"trend_vortex_ind_pos": "p", "trend_vortex_ind_neg": "n", "trend_vortex_ind_diff": "p - n"},
        f""", t AS (SELECT *, {_TR} AS tr, abs(high - l1) AS up, abs(low - h1) AS down FROM num),
        v AS (SELECT *, {roll('sum', 'up', 14, 1)} / nullif({roll('sum', 'tr', 14)}, 0) AS p,
                     {roll('sum', 'down', 14, 1)} / nullif({roll('sum', 'tr', 14)}, 0) AS n FROM t)""", "v"),
    "trend_dpo": _sql({"trend_dpo": f"lag(close, 11) {_W} - {roll('avg', 'close', 20)}"}),
    "trend_kst": _sql(
        {"trend_kst": "k", "trend_kst_sig": _full("k", 9), "trend_kst_diff": f"k - ({_full('k', 9)})"},
        f""", a AS (SELECT *, {_ROCS} FROM num),
        b AS (SELECT *, 100 * (({_full('roc10', 10)}) + 2 * ({_full('roc15', 10)}) + 3 * ({_full('roc20', 10)})
              + 4 * ({_full('roc30', 15)})) AS k FROM a)""", "b"),
    "trend_ichimoku": _sql(
        {"trend_ichimoku_conv": "conv", "trend_ichimoku_base": "base", "trend_ichimoku_a": "a", "trend_ichimoku_b": "b",
         "trend_visual_ichimoku_a": f"lag(a, 26) {_W}", "trend_visual_ichimoku_b": f"lag(b, 26) {_W}"},
        f""", i AS (SELECT *, {_MID(9)} AS conv, {_MID(26)} AS base, {_MID(52)} AS b FROM num),
        ii AS (SELECT *, (conv + base) / 2 AS a FROM i)""", "ii"),
    "trend_cci": _sql(
        {"trend_cci": "(tp - m) / nullif(0.015 * mad, 0)"},
        f""", m AS (SELECT *, {roll('avg', 'tp', 20)} AS m FROM num),
        d AS (SELECT a.symbol, a.date_time, a.tp, a.m, avg(abs(b.tp - a.m)) AS mad
              FROM m a JOIN m b ON a.symbol = b.symbol AND b.pos BETWEEN a.pos - 19 AND a.pos
              GROUP BY a.symbol, a.date_time, a.tp, a.m)""", "d"),
    "trend_aroon": _sql(
        {"trend_aroon_up": "u", "trend_aroon_down": "d", "trend_aroon_ind": "u - d"},
        f""", x AS (SELECT a.symbol, a.date_time, a.pos, arg_max(b.pos, b.high * 1e6 - b.pos) AS top,
                     arg_min(b.pos, b.low * 1e6 + b.pos) AS bottom
              FROM num a JOIN num b ON a.symbol = b.symbol AND b.pos BETWEEN a.pos - 24 AND a.pos GROUP BY 1, 2, 3),
        y AS (SELECT *, CASE WHEN pos >= 24 THEN (25 - (pos - top)) * 100.0 / 25 END AS u,
                     CASE WHEN pos >= 24 THEN (25 - (pos - bottom)) * 100.0 / 25 END AS d FROM x)""", "y"),
    "momentum_ultimate": _sql(
        {"momentum_uo": "100.0 * (4 * " + " + ".join(
            f"{w}({roll('sum', 'bp', n)}) / nullif({roll('sum', 'tr', n)}, 0)" for n, w in ((7, ""), (14, "2 * "), (28, ""))
        ) + ") / 7"},
        """, b AS (SELECT *, close - least(low, coalesce(c1, low)) AS bp,
                   greatest(high, coalesce(c1, high)) - least(low, coalesce(c1, low)) AS tr FROM num)""", "b"),
    "momentum_stochastic": _sql(
        {"momentum_stoch": "k", "momentum_stoch_signal": _full("k", 3), "momentum_wr": "-100 * (hh - close) / nullif(hh - ll, 0)"},
        f""", s AS (SELECT *, {roll('max', 'high', 14)} AS hh, {roll('min', 'low', 14)} AS ll FROM num),
        t AS (SELECT *, 100 * (close - ll) / nullif(hh - ll, 0) AS k FROM s)""", "t"),
    "momentum_awesome": _sql({"momentum_ao": f"{roll('avg', '(high + low) / 2', 5)} - {roll('avg', '(high + low) / 2', 34)}"}),
    "momentum_roc": _sql({"momentum_roc": f"100 * (close - lag(close, 12) {_W}) / nullif(lag(close, 12) {_W}, 0)"}),
    "others_returns": _sql({
        "others_dr": "100 * (close - c1) / nullif(c1, 0)",
        "others_dlr": "CASE WHEN close > 0 AND c1 > 0 THEN 100 * ln(close / c1) END",
        "others_cr": f"100 * (close - first_value(close) {_W}) / nullif(first_value(close) {_W}, 0)",
    }),
}

QUERIES["cumulative_long"] = across_chunks(_cumulative)
ORACLES["cumulative_long"] = across_chunks_sql(ORACLES["cumulative"])
