"""Volume indicators (10 columns)."""

from __future__ import annotations

from tidebars.operators.expr import F
from tidebars.operators.indicators.base import close, high, low, typical, volume, Step, ratio, ready, rsum, sma
from tidebars.operators.layout import Series
from tidebars.operators.scan import ema, running_sum


def _flow_volume():
    spread = high() - low()
    return F.when(spread == 0, F.lit(0.0)).otherwise(ratio((close() - low()) - (high() - close()), spread) * volume())


def adi(s: Series) -> list[Step]:
    """Accumulation/distribution: running sum of money-flow volume."""
    return [[running_sum("volume_adi", _flow_volume())]]


def obv(s: Series) -> list[Step]:
    """On-balance volume; a bar that closes unchanged (or the first) counts as up."""
    return [
        {"_obv": F.when(close() < s.lag("close"), -volume()).otherwise(volume())},
        [running_sum("volume_obv", F.col("_obv"))],
    ]


def cmf(s: Series, n: int = 20) -> list[Step]:
    """Chaikin money flow."""
    return [{"volume_cmf": ratio(rsum(s, _flow_volume(), n), rsum(s, volume(), n))}]


def fi(s: Series, n: int = 13) -> list[Step]:
    """Force index: EMA of price change times volume."""
    return [
        {"_force": (close() - s.lag("close")) * volume()},
        [ema("_fi", F.col("_force"), n)],
        {"volume_fi": ready("_fi", n + 1)},
    ]


def em(s: Series, n: int = 14, scale: float = 1e8) -> list[Step]:
    """Ease of movement and its average; NULL on bars without volume."""
    moved = (high() - s.lag("high")) + (low() - s.lag("low"))
    return [
        {"volume_em": ratio(moved * (high() - low()), volume() * 2.0) * F.lit(scale)},
        {"volume_sma_em": sma(s, "volume_em", n)},
    ]


def vpt(s: Series) -> list[Step]:
    """Volume-price trend: running sum of relative change times volume."""
    prev = s.lag("close")
    return [
        {"_vpt": F.coalesce(ratio(close() - prev, prev) * volume(), F.lit(0.0))},
        [running_sum("volume_vpt", F.col("_vpt"))],
    ]


def vwap(s: Series, n: int = 14) -> list[Step]:
    """Volume-weighted average of the typical price."""
    return [{"volume_vwap": ratio(rsum(s, typical() * volume(), n), rsum(s, volume(), n))}]


def mfi(s: Series, n: int = 14) -> list[Step]:
    """Money flow index: share of money flow on bars whose typical price rose."""
    return [
        {"_tp": typical()},
        {"_tp_prev": s.lag("_tp")},
        {
            "_mf_up": F.when(F.col("_tp_prev").isNotNull(), F.when(F.col("_tp") > F.col("_tp_prev"), typical() * volume()).otherwise(0.0)),
            "_mf_down": F.when(F.col("_tp_prev").isNotNull(), F.when(F.col("_tp") < F.col("_tp_prev"), typical() * volume()).otherwise(0.0)),
        },
        {"_up": rsum(s, "_mf_up", n), "_down": rsum(s, "_mf_down", n)},
        {"volume_mfi": ratio(F.col("_up") * 100.0, F.col("_up") + F.col("_down"))},
    ]


def nvi(s: Series, start: float = 1000.0) -> list[Step]:
    """Negative volume index: follows relative price change on falling volume.

    A product, so summed as logarithms; a close of 0 makes it 0 for good and is
    counted apart.
    """
    prev = s.lag("close")
    return [
        {
            "_nvi": F.when(
                (volume() < s.lag(volume())) & (prev != 0), F.when(close() == 0, F.lit(0.0)).otherwise(ratio(close(), prev))
            ).otherwise(F.lit(1.0))
        },
        [
            running_sum("_nvi_log", F.when(F.col("_nvi") != 0, F.ln(F.abs("_nvi"))).otherwise(0.0)),
            running_sum("_nvi_turns", F.when(F.col("_nvi") < 0, 1.0).otherwise(0.0)),
            running_sum("_nvi_zero", F.when(F.col("_nvi") == 0, 1.0).otherwise(0.0)),
        ],
        {"volume_nvi": F.when(F.col("_nvi_zero") > 0, 0.0).otherwise(
            F.exp("_nvi_log") * F.when(F.col("_nvi_turns") % 2 == 1, -1.0).otherwise(1.0) * F.lit(start))},
    ]


RECIPES = {
    "adi": adi, "obv": obv, "cmf": cmf, "fi": fi, "em": em, "vpt": vpt, "vwap": vwap, "mfi": mfi, "nvi": nvi,
}
COLUMNS = [
    "volume_adi", "volume_obv", "volume_cmf", "volume_fi", "volume_em", "volume_sma_em",
    "volume_vpt", "volume_vwap", "volume_mfi", "volume_nvi",
]
