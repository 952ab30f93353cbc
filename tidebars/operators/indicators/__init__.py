"""The 86 indicator columns, by family."""

from __future__ import annotations

from tidebars.operators.indicators import momentum, trend, volatility, volume
from tidebars.operators.indicators import psar as _psar
from tidebars.operators.indicators.base import apply_recipes
from tidebars.operators.layout import Series

RECIPES = {
    **volume.RECIPES, **volatility.RECIPES, **trend.RECIPES, **momentum.RECIPES, **momentum.RETURN_RECIPES,
}
FAMILIES = {
    "volume": volume.COLUMNS,
    "volatility": volatility.COLUMNS,
    "trend": trend.COLUMNS + _psar.COLUMNS,
    "momentum": momentum.COLUMNS + momentum.RETURN_COLUMNS,
}
ALL_COLUMNS = [c for columns in FAMILIES.values() for c in columns]

# The columns kept in the technical table and those of the scoring model.
TECHNICAL_COLUMNS = [
    "momentum_kama", "others_cr", "trend_ema_fast", "trend_ema_slow", "trend_ichimoku_a",
    "trend_ichimoku_b", "trend_ichimoku_base", "trend_ichimoku_conv", "trend_sma_fast",
    "trend_sma_slow", "trend_visual_ichimoku_a", "trend_visual_ichimoku_b", "volatility_bbh",
    "volatility_bbl", "volatility_bbm", "volatility_dch", "volatility_dcl", "volatility_dcm",
    "volatility_kcc", "volatility_kch", "volatility_kcl", "volume_obv", "volume_vpt", "volume_vwap",
]
TECHNICAL_RECIPES = [
    "kama", "returns", "ema", "ichimoku", "sma", "bollinger", "donchian", "keltner", "obv", "vpt", "vwap",
]


def add_indicators(series: Series, names: list[str], cut_scans: bool = False) -> Series:
    """Add the columns of the named recipes."""
    return apply_recipes(series, [RECIPES[n] for n in names], cut_scans)


def add_all_indicators(series: Series) -> Series:
    """Add all 86 columns."""
    series = apply_recipes(series, RECIPES.values(), cut_scans=True)
    return _psar.psar(series)
