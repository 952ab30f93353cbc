"""Volatility indicators (21 columns)."""

from __future__ import annotations

from tidebars.operators.expr import F
from tidebars.operators.indicators.base import (
    close, high, low, typical, Step, flag, highest, lowest, ratio, ready, sma, true_range,
)
from tidebars.operators.layout import Series
from tidebars.operators.scan import wilder


def bollinger(s: Series, n: int = 20, k: float = 2.0) -> list[Step]:
    """Bollinger bands with the population standard deviation."""
    h, l, m = F.col("volatility_bbh"), F.col("volatility_bbl"), F.col("volatility_bbm")
    return [
        {"volatility_bbm": sma(s, "close", n), "_bb_sd": s.rolling(F.stddev_pop, "close", n)},
        {"volatility_bbh": m + F.col("_bb_sd") * k, "volatility_bbl": m - F.col("_bb_sd") * k},
        {
            "volatility_bbw": ratio(h - l, m) * 100.0,
            "volatility_bbp": ratio(close() - l, h - l),
            "volatility_bbhi": flag(close() > h),
            "volatility_bbli": flag(close() < l),
        },
    ]


def keltner(s: Series, n: int = 10) -> list[Step]:
    """Keltner channel, averages of the typical price and its two offsets."""
    h, l, m = F.col("volatility_kch"), F.col("volatility_kcl"), F.col("volatility_kcc")
    return [
        {
            "volatility_kcc": sma(s, typical(), n),
            "volatility_kch": sma(s, (high() * 4.0 - low() * 2.0 + close()) / 3.0, n),
            "volatility_kcl": sma(s, (low() * 4.0 - high() * 2.0 + close()) / 3.0, n),
        },
        {
            "volatility_kcw": ratio(h - l, m) * 100.0,
            "volatility_kcp": ratio(close() - l, h - l),
            "volatility_kchi": flag(close() > h),
            "volatility_kcli": flag(close() < l),
        },
    ]


def donchian(s: Series, n: int = 20) -> list[Step]:
    """Donchian channel."""
    h, l = F.col("volatility_dch"), F.col("volatility_dcl")
    return [
        {"volatility_dcl": lowest(s, "low", n), "volatility_dch": highest(s, "high", n), "_dc_m": sma(s, "close", n)},
        {
            "volatility_dcm": (h + l) / 2.0,
            "volatility_dcw": ratio(h - l, F.col("_dc_m")) * 100.0,
            "volatility_dcp": ratio(close() - l, h - l),
        },
    ]


def atr(s: Series, n: int = 10) -> list[Step]:
    """Average true range: Wilder average seeded with the mean of the first ``n``."""
    return [
        {"_tr": true_range(s)},
        {"_atr_seed": ready(sma(s, "_tr", n), n)},
        [wilder("volatility_atr", F.col("_tr"), n, F.col("_atr_seed"))],
    ]


def ulcer(s: Series, n: int = 14) -> list[Step]:
    """Ulcer index: root mean square of the drawdown from the rolling maximum."""
    return [
        {"_ui_top": highest(s, "close", n)},
        {"_ui_r": ratio((close() - F.col("_ui_top")) * 100.0, F.col("_ui_top"))},
        {"volatility_ui": F.sqrt(sma(s, F.col("_ui_r") * F.col("_ui_r"), n))},
    ]


RECIPES = {"bollinger": bollinger, "keltner": keltner, "donchian": donchian, "atr": atr, "ulcer": ulcer}
COLUMNS = [
    "volatility_bbm", "volatility_bbh", "volatility_bbl", "volatility_bbw", "volatility_bbp",
    "volatility_bbhi", "volatility_bbli", "volatility_kcc", "volatility_kch", "volatility_kcl",
    "volatility_kcw", "volatility_kcp", "volatility_kchi", "volatility_kcli", "volatility_dcl",
    "volatility_dch", "volatility_dcm", "volatility_dcw", "volatility_dcp", "volatility_atr", "volatility_ui",
]
