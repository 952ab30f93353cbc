"""Recursive indicators.  In SQL an average with constant weights is the weighted
sum over all earlier bars; the others are recursive queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidebars.catalog.common import NUM, across_chunks, across_chunks_sql, over, r, rounded, series
from tidebars.catalog.indicators_window import ORACLES as WINDOWED
from tidebars.catalog.indicators_window import _TR, _W, _full, _recipe, _sql
from tidebars.operators.indicators import ALL_COLUMNS, add_all_indicators
from tidebars.operators.indicators.psar import COLUMNS as PSAR_COLUMNS
from tidebars.operators.indicators.psar import psar


_SIGNED = ["volume_em", "volume_sma_em", "volume_vpt"]


def _psar(spark, sf_dir):
    return rounded(psar(series(spark, sf_dir)).result(*PSAR_COLUMNS))


def _all(spark, sf_dir):
    """All 86 columns; those that span many magnitudes as logarithms."""
    wide = add_all_indicators(series(spark, sf_dir)).result(*ALL_COLUMNS)
    signed = {c: F.signum(c) * F.log1p(F.abs(c)) for c in _SIGNED}
    nvi = F.when(F.col("volume_nvi") > 0, F.ln("volume_nvi"))
    return rounded(wide.withColumns({**signed, "volume_nvi": nvi}))


QUERIES = {
    "ema": _recipe("ema", ["trend_ema_fast", "trend_ema_slow"]),
    "macd": _recipe("macd", ["trend_macd", "trend_macd_signal", "trend_macd_diff"]),
    "fi": _recipe("fi", ["volume_fi"]),
    "atr": _recipe("atr", ["volatility_atr"]),
    "trix": _recipe("trix", ["trend_trix"]),
    "mass": _recipe("mass", ["trend_mass_index"]),
    "stc": _recipe("stc", ["trend_stc"]),
    "adx": _recipe("adx", ["trend_adx", "trend_adx_pos", "trend_adx_neg"]),
    "rsi": _recipe("rsi", ["momentum_rsi"]),
    "stoch_rsi": _recipe("stoch_rsi", ["momentum_stoch_rsi", "momentum_stoch_rsi_k", "momentum_stoch_rsi_d"]),
    "tsi": _recipe("tsi", ["momentum_tsi"]),
    "ppo": _recipe("ppo", ["momentum_ppo", "momentum_ppo_signal", "momentum_ppo_hist"]),
    "pvo": _recipe("pvo", ["momentum_pvo", "momentum_pvo_signal", "momentum_pvo_hist"]),
    "kama": _recipe("kama", ["momentum_kama"]),
    "psar": _psar,
    "indicators_all": _all,
}


def _avg(name: str, source: str, x: str, alpha: float, first: int, ready: int, seed: str | None = None) -> str:
    """CTE with the recursive average of ``x``: starts at position ``first`` with
    ``seed`` (its first value if not given), NULL before position ``ready``."""
    return f""", {name} AS (
      SELECT a.symbol, a.date_time, a.pos, CASE WHEN a.pos >= {ready} THEN
        sum(CASE WHEN b.pos = {first} THEN b.{seed or x} ELSE {alpha!r} * b.{x} END * power({1 - alpha!r}, a.pos - b.pos)) END AS y
      FROM {source} a JOIN {source} b ON a.symbol = b.symbol AND b.pos BETWEEN {first} AND a.pos
      GROUP BY a.symbol, a.date_time, a.pos)"""


def _ema(name: str, source: str, x: str, n: int, first: int = 0, ready: int | None = None) -> str:
    return _avg(name, source, x, 2.0 / (n + 1), first, first + n - 1 if ready is None else ready)


def _pick(ctes: str, columns: dict[str, str], source: str) -> str:
    picks = ", ".join(f"{r(x)} AS {name}" for name, x in columns.items())
    return f"WITH {NUM}{ctes} SELECT n.symbol, n.date_time, {picks} FROM {source}"


def _join(*names: str) -> str:
    return "num n" + "".join(f" LEFT JOIN {m} ON {m}.symbol = n.symbol AND {m}.pos = n.pos" for m in names)


def _oscillator(x: str, prefix: str) -> str:
    ctes = (
        f", src AS (SELECT symbol, date_time, pos, {x} AS x FROM num)"
        + _ema("f", "src", "x", 12) + _ema("s", "src", "x", 26)
        + """, o AS (SELECT s.symbol, s.date_time, s.pos, 100 * (f.y - s.y) / nullif(s.y, 0) AS x
             FROM f JOIN s ON f.symbol = s.symbol AND f.pos = s.pos)"""
        + _ema("g", "o", "x", 9, 25)
    )
    return _pick(ctes, {prefix: "o.x", f"{prefix}_signal": "g.y", f"{prefix}_hist": "o.x - g.y"}, _join("o", "g"))


def _stoch(source: str, name: str, first: int) -> str:
    top, bottom = f"max(y) {over(10)}", f"min(y) {over(10)}"
    return f""", {name} AS (SELECT symbol, date_time, pos, CASE WHEN pos >= {first} THEN
        coalesce(100 * (y - {bottom}) / nullif({top} - {bottom}, 0), 0) END AS x FROM {source})"""


_MOVES = """, mv AS (SELECT *, CASE WHEN close > c1 THEN close - c1 ELSE 0 END AS gain,
      CASE WHEN close < c1 THEN c1 - close ELSE 0 END AS loss FROM num)"""
_RSI = (
    _MOVES + _avg("u", "mv", "gain", 1 / 14, 0, 13) + _avg("d", "mv", "loss", 1 / 14, 0, 13)
    + """, rsi AS (SELECT u.symbol, u.date_time, u.pos, CASE WHEN u.pos >= 13 THEN
          CASE WHEN d.y = 0 THEN 100 ELSE 100 * u.y / (u.y + d.y) END END AS x
          FROM u JOIN d ON u.symbol = d.symbol AND u.pos = d.pos)"""
)
_ADX = f""", mv AS (SELECT *, {_TR} AS tr,
      CASE WHEN high - h1 > l1 - low AND high - h1 > 0 THEN high - h1 ELSE 0 END AS up,
      CASE WHEN l1 - low > high - h1 AND l1 - low > 0 THEN l1 - low ELSE 0 END AS down FROM num),
    sd AS (SELECT *, avg(tr) {over(14)} AS tr0, avg(up) {over(14)} AS up0, avg(down) {over(14)} AS down0 FROM mv)""" + (
    _avg("a", "sd", "tr", 1 / 14, 14, 14, "tr0") + _avg("u", "sd", "up", 1 / 14, 14, 14, "up0")
    + _avg("d", "sd", "down", 1 / 14, 14, 14, "down0")
    + f""", di AS (SELECT a.symbol, a.date_time, a.pos, coalesce(100 * u.y / nullif(a.y, 0), 0) AS p,
                 coalesce(100 * d.y / nullif(a.y, 0), 0) AS m
          FROM a JOIN u ON a.symbol = u.symbol AND a.pos = u.pos JOIN d ON a.symbol = d.symbol AND a.pos = d.pos),
        dx AS (SELECT *, coalesce(100 * abs(p - m) / nullif(p + m, 0), 0) AS x FROM di),
        dxs AS (SELECT *, avg(x) {over(14)} AS x0 FROM dx)"""
    + _avg("g", "dxs", "x", 1 / 14, 27, 27, "x0")
)

ORACLES = {
    "ema": _pick(
        _ema("f", "num", "close", 12) + _ema("s", "num", "close", 26),
        {"trend_ema_fast": "f.y", "trend_ema_slow": "s.y"}, _join("f", "s")),
    "macd": _pick(
        _ema("f", "num", "close", 12) + _ema("s", "num", "close", 26)
        + ", m AS (SELECT s.symbol, s.date_time, s.pos, f.y - s.y AS x FROM f JOIN s ON f.symbol = s.symbol AND f.pos = s.pos)"
        + _ema("g", "m", "x", 9, 25),
        {"trend_macd": "m.x", "trend_macd_signal": "g.y", "trend_macd_diff": "m.x - g.y"}, _join("m", "g")),
    "fi": _pick(
        ", f AS (SELECT symbol, date_time, pos, (close - c1) * tick_vol AS x FROM num)" + _ema("g", "f", "x", 13, 1),
        {"volume_fi": "g.y"}, _join("g")),
    "atr": _pick(
        f", t AS (SELECT *, {_TR} AS tr FROM num), t0 AS (SELECT *, avg(tr) {over(10)} AS tr0 FROM t)"
        + _avg("g", "t0", "tr", 0.1, 9, 9, "tr0"), {"volatility_atr": "g.y"}, _join("g")),
    "trix": _pick(
        _ema("e1", "num", "close", 15) + _ema("e2", "e1", "y", 15, 14) + _ema("e3", "e2", "y", 15, 28)
        + ", l AS (SELECT *, lag(y) OVER (PARTITION BY symbol ORDER BY pos) AS y1 FROM e3)",
        {"trend_trix": "100 * (l.y - l.y1) / nullif(l.y1, 0)"}, _join("l")),
    "mass": _pick(
        ", h AS (SELECT symbol, date_time, pos, high - low AS x FROM num)" + _ema("e1", "h", "x", 9) + _ema("e2", "e1", "y", 9, 8)
        + """, q AS (SELECT e2.symbol, e2.date_time, e2.pos, CASE WHEN e2.pos >= 16 THEN coalesce(e1.y / nullif(e2.y, 0), 0) END AS x
             FROM e1 JOIN e2 ON e1.symbol = e2.symbol AND e1.pos = e2.pos),"""
        + f" z AS (SELECT symbol, date_time, pos, CASE WHEN pos >= 40 THEN sum(x) {over(25)} END AS y FROM q)",
        {"trend_mass_index": "z.y"}, _join("z")),
    "stc": _pick(
        _ema("f", "num", "close", 23, 0, 0) + _ema("s", "num", "close", 50)
        + ", m AS (SELECT s.symbol, s.date_time, s.pos, f.y - s.y AS y FROM f JOIN s ON f.symbol = s.symbol AND f.pos = s.pos)"
        + _stoch("m", "k", 58) + _ema("d", "k", "x", 3, 58) + _stoch("d", "kd", 69) + _ema("g", "kd", "x", 3, 69),
        {"trend_stc": "g.y"}, _join("g")),
    "adx": _pick(
        _ADX, {"trend_adx": "g.y", "trend_adx_pos": "di.p", "trend_adx_neg": "di.m"}, _join("di", "g")),
    "rsi": _pick(_RSI, {"momentum_rsi": "rsi.x"}, _join("rsi")),
    "stoch_rsi": _pick(
        _RSI + f""", q AS (SELECT *, CASE WHEN pos >= 26 THEN (x - min(x) {over(14)}) / nullif(max(x) {over(14)} - min(x) {over(14)}, 0) END AS s FROM rsi),
        k AS (SELECT *, {_full('s', 3)} AS k FROM q), kk AS (SELECT *, {_full('k', 3)} AS d FROM k)""",
        {"momentum_stoch_rsi": "kk.s", "momentum_stoch_rsi_k": "kk.k", "momentum_stoch_rsi_d": "kk.d"}, _join("kk")),
    "tsi": _pick(
        ", mv AS (SELECT symbol, date_time, pos, close - c1 AS m, abs(close - c1) AS a FROM num)"
        + _ema("m1", "mv", "m", 25, 1) + _ema("a1", "mv", "a", 25, 1) + _ema("m2", "m1", "y", 13, 25) + _ema("a2", "a1", "y", 13, 25),
        {"momentum_tsi": "100 * m2.y / nullif(a2.y, 0)"}, _join("m2", "a2")),
    "ppo": _oscillator("close", "momentum_ppo"),
    "pvo": _oscillator("CAST(tick_vol AS DOUBLE)", "momentum_pvo"),
    "kama": f"""WITH RECURSIVE {NUM},
        st AS (SELECT *, abs(close - c1) AS step, abs(close - lag(close, 10) OVER (PARTITION BY symbol ORDER BY pos)) AS move FROM num),
        er AS (SELECT *, coalesce(move / nullif(sum(step) {over(10)}, 0), 0) AS er FROM st),
        sc AS (SELECT *, power(er * (2.0 / 3 - 2.0 / 31) + 2.0 / 31, 2) AS sc FROM er),
        k AS (SELECT symbol, pos, close AS y FROM sc WHERE pos = 10
              UNION ALL SELECT s.symbol, s.pos, (1 - s.sc) * k.y + s.sc * s.close FROM k JOIN sc s ON s.symbol = k.symbol AND s.pos = k.pos + 1)
        SELECT n.symbol, n.date_time, {r('k.y')} AS momentum_kama FROM num n LEFT JOIN k ON k.symbol = n.symbol AND k.pos = n.pos""",
    "psar": f"""WITH RECURSIVE {NUM},
        p AS (
          SELECT symbol, pos, TRUE AS rising, low AS stop, high AS ep, CAST(0.02 AS DOUBLE) AS af, FALSE AS turned, low AS pl, low AS pl2, high AS ph, high AS ph2
          FROM num WHERE pos = 0
          UNION ALL
          SELECT symbol, pos, CASE WHEN hit THEN NOT rising ELSE rising END,
                 CASE WHEN hit THEN ep ELSE s END,
                 CASE WHEN hit THEN CASE WHEN rising THEN low ELSE high END WHEN rising THEN greatest(ep, high) ELSE least(ep, low) END,
                 CASE WHEN hit THEN CAST(0.02 AS DOUBLE) WHEN (rising AND high > ep) OR (NOT rising AND low < ep) THEN least(af + 0.02, 0.2) ELSE af END,
                 hit, low, pl, high, ph
          FROM (SELECT *, CASE WHEN rising THEN low < s ELSE high > s END AS hit
                FROM (SELECT n.symbol, n.pos, n.high, n.low, p.rising, p.ep, p.af, p.pl, p.ph,
                             CASE WHEN p.rising THEN least(p.stop + p.af * (p.ep - p.stop), p.pl, p.pl2)
                                  ELSE greatest(p.stop + p.af * (p.ep - p.stop), p.ph, p.ph2) END AS s
                      FROM p JOIN num n ON n.symbol = p.symbol AND n.pos = p.pos + 1) x) y)
        SELECT n.symbol, n.date_time,
               {r('CASE WHEN p.rising AND p.pos > 0 THEN p.stop END')} AS trend_psar_up,
               {r('CASE WHEN NOT p.rising THEN p.stop END')} AS trend_psar_down,
               CASE WHEN p.turned AND p.rising THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS trend_psar_up_indicator,
               CASE WHEN p.turned AND NOT p.rising THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS trend_psar_down_indicator
        FROM num n JOIN p ON p.symbol = n.symbol AND p.pos = n.pos""",
}


def _signed(x: str) -> str:
    return f"sign({x}) * ln(1 + abs({x}))"


_VPT = f"sum(coalesce((close - c1) / nullif(c1, 0) * tick_vol, 0)) {_W}"
_PARTS = {
    **{k: v for k, v in WINDOWED.items() if k.split("_")[0] in ("volume", "volatility", "trend", "momentum", "others")},
    **{k: v for k, v in ORACLES.items()},
    "volume_em": _sql(
        {"volume_em": _signed("em"), "volume_sma_em": _signed(f"({_full('em', 14)})")},
        ", e AS (SELECT *, ((high - h1) + (low - l1)) * (high - low) / nullif(2.0 * tick_vol, 0) * 1e8 AS em FROM num)", "e"),
    "volume_vpt": _sql({"volume_vpt": _signed(f"({_VPT})")}),
    "volume_nvi": WINDOWED["volume_nvi"].replace("AS ln_nvi", "AS volume_nvi"),
}
ORACLES["indicators_all"] = "SELECT * FROM " + " JOIN ".join(
    f"({sql}) p{i}" + (" USING (symbol, date_time)" if i else "") for i, sql in enumerate(_PARTS.values())
)

for _name in ("ema", "kama", "adx", "psar"):
    QUERIES[f"{_name}_long"] = across_chunks(QUERIES[_name])
    ORACLES[f"{_name}_long"] = across_chunks_sql(ORACLES[_name])
