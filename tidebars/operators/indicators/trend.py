"""Trend indicators (34 columns; the four parabolic-stop columns are in ``psar``)."""

from __future__ import annotations

from tidebars.operators.expr import Expr, F
from tidebars.operators.indicators.base import (
    close, high, low, typical, Step, highest, lowest, ratio, ready, rsum, sma, true_range,
)
from tidebars.operators.layout import POS, Series
from tidebars.operators.scan import ema, wilder


def sma_pair(s: Series, fast: int = 12, slow: int = 26) -> list[Step]:
    return [{"trend_sma_fast": sma(s, "close", fast), "trend_sma_slow": sma(s, "close", slow)}]


def ema_pair(s: Series, fast: int = 12, slow: int = 26) -> list[Step]:
    return [
        [ema(f"_ema{fast}", close(), fast), ema(f"_ema{slow}", close(), slow)],
        {"trend_ema_fast": ready(f"_ema{fast}", fast), "trend_ema_slow": ready(f"_ema{slow}", slow)},
    ]


def macd(s: Series, fast: int = 12, slow: int = 26, sign: int = 9) -> list[Step]:
    """Difference of two EMAs, its EMA, and the difference of those."""
    return [
        [ema(f"_ema{fast}", close(), fast), ema(f"_ema{slow}", close(), slow)],
        {"trend_macd": ready(F.col(f"_ema{fast}") - F.col(f"_ema{slow}"), slow)},
        [ema("_macd_signal", F.col("trend_macd"), sign)],
        {"trend_macd_signal": ready("_macd_signal", slow + sign - 1)},
        {"trend_macd_diff": F.col("trend_macd") - F.col("trend_macd_signal")},
    ]


def vortex(s: Series, n: int = 14) -> list[Step]:
    return [
        {"_tr": true_range(s), "_vx_up": F.abs(high() - s.lag("low")), "_vx_down": F.abs(low() - s.lag("high"))},
        {"_vx_tr": rsum(s, "_tr", n)},
        {
            "trend_vortex_ind_pos": ratio(rsum(s, "_vx_up", n), F.col("_vx_tr")),
            "trend_vortex_ind_neg": ratio(rsum(s, "_vx_down", n), F.col("_vx_tr")),
        },
        {"trend_vortex_ind_diff": F.col("trend_vortex_ind_pos") - F.col("trend_vortex_ind_neg")},
    ]


def trix(s: Series, n: int = 15) -> list[Step]:
    """Percent change of a triple EMA."""
    return [
        [ema("_trix1", close(), n)],
        {"_trix1r": ready("_trix1", n)},
        [ema("_trix2", F.col("_trix1r"), n)],
        {"_trix2r": ready("_trix2", 2 * n - 1)},
        [ema("_trix3", F.col("_trix2r"), n)],
        {"_trix3r": ready("_trix3", 3 * n - 2)},
        {"_trix_prev": s.lag("_trix3r")},
        {"trend_trix": ratio((F.col("_trix3r") - F.col("_trix_prev")) * 100.0, F.col("_trix_prev"))},
    ]


def mass_index(s: Series, fast: int = 9, slow: int = 25) -> list[Step]:
    """Sum of the ratio of an EMA of the range to the EMA of that EMA (0/0 counts as 0)."""
    return [
        [ema("_mass1", high() - low(), fast)],
        {"_mass1r": ready("_mass1", fast)},
        [ema("_mass2", F.col("_mass1r"), fast)],
        {"_mass": ready(F.coalesce(ratio(F.col("_mass1"), F.col("_mass2")), F.lit(0.0)), 2 * fast - 1)},
        {"trend_mass_index": rsum(s, "_mass", slow)},
    ]


def dpo(s: Series, n: int = 20) -> list[Step]:
    """Detrended price: the close ``n/2 + 1`` bars ago less the average."""
    return [{"trend_dpo": s.lag("close", n // 2 + 1) - sma(s, "close", n)}]


def kst(s: Series, spans=(10, 15, 20, 30), averages=(10, 10, 10, 15), sign: int = 9) -> list[Step]:
    """Know-sure-thing: weighted sum of four averaged rates of change."""
    rocs = {f"_roc{r}": ratio(close() - s.lag("close", r), s.lag("close", r)) for r in spans}
    terms = [sma(s, f"_roc{r}", n) * float(w) for w, (r, n) in enumerate(zip(spans, averages), 1)]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return [
        rocs,
        {"trend_kst": total * 100.0},
        {"trend_kst_sig": sma(s, "trend_kst", sign)},
        {"trend_kst_diff": F.col("trend_kst") - F.col("trend_kst_sig")},
    ]


def ichimoku(s: Series, short: int = 9, middle: int = 26, long: int = 52) -> list[Step]:
    """Midpoints of three windows; the visual spans are shifted ``middle`` bars."""

    def mid(n: int) -> Expr:
        return (highest(s, "high", n) + lowest(s, "low", n)) / 2.0

    return [
        {"trend_ichimoku_conv": mid(short), "trend_ichimoku_base": mid(middle), "trend_ichimoku_b": mid(long)},
        {"trend_ichimoku_a": (F.col("trend_ichimoku_conv") + F.col("trend_ichimoku_base")) / 2.0},
        {
            "trend_visual_ichimoku_a": s.lag("trend_ichimoku_a", middle),
            "trend_visual_ichimoku_b": s.lag("trend_ichimoku_b", middle),
        },
    ]


def stc(s: Series, fast: int = 23, slow: int = 50, cycle: int = 10, smooth: int = 3) -> list[Step]:
    """Schaff trend cycle: two stochastics of a MACD, each smoothed; a flat window counts as 0."""

    def stochastic(x: str, rows: int) -> Expr:
        top, bottom = highest(s, x, cycle), lowest(s, x, cycle)
        return ready(F.coalesce(ratio((F.col(x) - bottom) * 100.0, top - bottom), F.lit(0.0)), rows)

    k1 = slow + cycle - 1
    d1 = k1 + smooth - 1
    k2 = d1 + cycle - 1
    return [
        [ema(f"_ema{fast}", close(), fast), ema(f"_ema{slow}", close(), slow)],
        {"_stc_m": ready(F.col(f"_ema{fast}") - F.col(f"_ema{slow}"), slow)},
        {"_stc_k": stochastic("_stc_m", k1)},
        [ema("_stc_d0", F.col("_stc_k"), smooth)],
        {"_stc_d": ready("_stc_d0", d1)},
        {"_stc_kd": stochastic("_stc_d", k2)},
        [ema("_stc", F.col("_stc_kd"), smooth)],
        {"trend_stc": ready("_stc", k2 + smooth - 1)},
    ]


def adx(s: Series, n: int = 14) -> list[Step]:
    """Wilder's directional movement; averages seeded with the mean of the first ``n``."""
    up, down = high() - s.lag("high"), s.lag("low") - low()
    known = F.col(POS) >= 1
    total = F.col("trend_adx_pos") + F.col("trend_adx_neg")
    return [
        {
            "_tr": true_range(s),
            "_dm_up": F.when(known, F.when((up > down) & (up > 0), up).otherwise(0.0)),
            "_dm_down": F.when(known, F.when((down > up) & (down > 0), down).otherwise(0.0)),
        },
        {
            "_tr_seed": ready(sma(s, "_tr", n), n + 1),
            "_up_seed": sma(s, "_dm_up", n),
            "_down_seed": sma(s, "_dm_down", n),
        },
        [
            wilder("_adx_tr", F.col("_tr"), n, F.col("_tr_seed")),
            wilder("_adx_up", F.col("_dm_up"), n, F.col("_up_seed")),
            wilder("_adx_down", F.col("_dm_down"), n, F.col("_down_seed")),
        ],
        {
            "trend_adx_pos": F.coalesce(ratio(F.col("_adx_up") * 100.0, F.col("_adx_tr")), ready(F.lit(0.0), n + 1)),
            "trend_adx_neg": F.coalesce(ratio(F.col("_adx_down") * 100.0, F.col("_adx_tr")), ready(F.lit(0.0), n + 1)),
        },
        {
            "_dx": ready(
                F.coalesce(
                    ratio(F.abs(F.col("trend_adx_pos") - F.col("trend_adx_neg")) * 100.0, total), F.lit(0.0)
                ),
                n + 1,
            )
        },
        {"_dx_seed": sma(s, "_dx", n)},
        [wilder("trend_adx", F.col("_dx"), n, F.col("_dx_seed"))],
    ]


def cci(s: Series, n: int = 20, scale: float = 0.015) -> list[Step]:
    """Commodity channel index, with the mean absolute deviation of the window."""
    w = s.window(n)
    return [
        {"_tp": typical()},
        {"_tp_mean": sma(s, "_tp", n), "_tp_list": F.collect_list("_tp").over(w)},
        {
            "_tp_mad": F.aggregate(
                "_tp_list", F.lit(0.0), lambda acc, x: acc + F.abs(x - F.col("_tp_mean"))
            ) / float(n)
        },
        {"trend_cci": ratio(F.col("_tp") - F.col("_tp_mean"), F.col("_tp_mad") * scale)},
    ]


def aroon(s: Series, n: int = 25) -> list[Step]:
    """Place of the highest high and the lowest low among the last ``n`` bars, 1 to ``n``;
    of equal extremes the earliest counts."""
    w = s.window(n)
    top = F.max(F.struct(F.col("high").alias("x"), (-F.col(POS)).alias("p"))).over(w)
    bottom = F.min(F.struct(F.col("low").alias("x"), F.col(POS).alias("p"))).over(w)
    return [
        {"_top": -top["p"], "_bottom": bottom["p"]},
        {
            "trend_aroon_up": ready((F.lit(n) - (F.col(POS) - F.col("_top"))) * 100.0 / n, n),
            "trend_aroon_down": ready((F.lit(n) - (F.col(POS) - F.col("_bottom"))) * 100.0 / n, n),
        },
        {"trend_aroon_ind": F.col("trend_aroon_up") - F.col("trend_aroon_down")},
    ]


RECIPES = {
    "sma": sma_pair, "ema": ema_pair, "macd": macd, "vortex": vortex, "trix": trix, "mass": mass_index,
    "dpo": dpo, "kst": kst, "ichimoku": ichimoku, "stc": stc, "adx": adx, "cci": cci, "aroon": aroon,
}
COLUMNS = [
    "trend_macd", "trend_macd_signal", "trend_macd_diff", "trend_sma_fast", "trend_sma_slow",
    "trend_ema_fast", "trend_ema_slow", "trend_vortex_ind_pos", "trend_vortex_ind_neg",
    "trend_vortex_ind_diff", "trend_trix", "trend_mass_index", "trend_dpo", "trend_kst",
    "trend_kst_sig", "trend_kst_diff", "trend_ichimoku_conv", "trend_ichimoku_base",
    "trend_ichimoku_a", "trend_ichimoku_b", "trend_stc", "trend_adx", "trend_adx_pos",
    "trend_adx_neg", "trend_cci", "trend_visual_ichimoku_a", "trend_visual_ichimoku_b",
    "trend_aroon_up", "trend_aroon_down", "trend_aroon_ind",
]
