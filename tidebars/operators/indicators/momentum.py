"""Momentum indicators (18 columns) and the three return columns."""

from __future__ import annotations

from tidebars.operators.expr import Expr, F
from tidebars.operators.indicators.base import (
    close, high, low, volume, Step, highest, lowest, ratio, ready, rsum, sma,
)
from tidebars.operators.layout import POS, Series
from tidebars.operators.scan import Recurrence, ema, first_value, wilder


def _rsi_steps(s: Series, n: int) -> list[Step]:
    move = close() - s.lag("close")
    up, down = F.col("_rsi_up"), F.col("_rsi_down")
    return [
        {
            "_gain": F.when(move > 0, move).otherwise(0.0),
            "_loss": F.when(move < 0, -move).otherwise(0.0),
        },
        [wilder("_rsi_up", F.col("_gain"), n), wilder("_rsi_down", F.col("_loss"), n)],
        {"_rsi": ready(F.when(down == 0, 100.0).otherwise(ratio(up * 100.0, up + down)), n)},
    ]


def rsi(s: Series, n: int = 14) -> list[Step]:
    """Relative strength; 100 where nothing has fallen yet."""
    return [*_rsi_steps(s, n), {"momentum_rsi": F.col("_rsi")}]


def stoch_rsi(s: Series, n: int = 14, smooth: int = 3) -> list[Step]:
    """Place of the RSI in its own window, 0 to 1, and two averages of it."""
    return [
        *_rsi_steps(s, n),
        {"_rsi_low": lowest(s, "_rsi", n), "_rsi_high": highest(s, "_rsi", n)},
        {"momentum_stoch_rsi": ratio(F.col("_rsi") - F.col("_rsi_low"), F.col("_rsi_high") - F.col("_rsi_low"))},
        {"momentum_stoch_rsi_k": sma(s, "momentum_stoch_rsi", smooth)},
        {"momentum_stoch_rsi_d": sma(s, "momentum_stoch_rsi_k", smooth)},
    ]


def tsi(s: Series, slow: int = 25, fast: int = 13) -> list[Step]:
    """True strength: doubly averaged change over doubly averaged absolute change."""
    move = close() - s.lag("close")
    return [
        {"_move": move, "_abs_move": F.abs(move)},
        [ema("_tsi_m1", F.col("_move"), slow), ema("_tsi_a1", F.col("_abs_move"), slow)],
        {"_tsi_m1r": ready("_tsi_m1", slow + 1), "_tsi_a1r": ready("_tsi_a1", slow + 1)},
        [ema("_tsi_m2", F.col("_tsi_m1r"), fast), ema("_tsi_a2", F.col("_tsi_a1r"), fast)],
        {"momentum_tsi": ready(ratio(F.col("_tsi_m2") * 100.0, F.col("_tsi_a2")), slow + fast)},
    ]


def ultimate(s: Series, spans=(7, 14, 28), weights=(4.0, 2.0, 1.0)) -> list[Step]:
    """Ultimate oscillator."""
    prev = s.lag("close")
    floor = F.least(low(), prev)
    total: Expr | None = None
    for n, w in zip(spans, weights):
        term = ratio(rsum(s, "_bp", n), rsum(s, "_utr", n)) * w
        total = term if total is None else total + term
    return [
        {"_bp": close() - floor, "_utr": F.greatest(high(), prev) - floor},
        {"momentum_uo": total * 100.0 / sum(weights)},
    ]


def stochastic(s: Series, n: int = 14, smooth: int = 3) -> list[Step]:
    """Stochastic oscillator, its average, and Williams %R."""
    h, l = F.col("_st_high"), F.col("_st_low")
    return [
        {"_st_high": highest(s, "high", n), "_st_low": lowest(s, "low", n)},
        {
            "momentum_stoch": ratio((close() - l) * 100.0, h - l),
            "momentum_wr": ratio((h - close()) * -100.0, h - l),
        },
        {"momentum_stoch_signal": sma(s, "momentum_stoch", smooth)},
    ]


def awesome(s: Series, fast: int = 5, slow: int = 34) -> list[Step]:
    mid = (high() + low()) / 2.0
    return [{"momentum_ao": sma(s, mid, fast) - sma(s, mid, slow)}]


def roc(s: Series, n: int = 12) -> list[Step]:
    prev = s.lag("close", n)
    return [{"momentum_roc": ratio((close() - prev) * 100.0, prev)}]


def _oscillator(x: Expr, prefix: str, mark: str, fast: int, slow: int, sign: int) -> list[Step]:
    e_fast, e_slow = f"_ema{mark}{fast}", f"_ema{mark}{slow}"
    return [
        [ema(e_fast, x, fast), ema(e_slow, x, slow)],
        {prefix: ready(ratio((F.col(e_fast) - F.col(e_slow)) * 100.0, F.col(e_slow)), slow)},
        [ema(f"_{prefix}", F.col(prefix), sign)],
        {f"{prefix}_signal": ready(f"_{prefix}", slow + sign - 1)},
        {f"{prefix}_hist": F.col(prefix) - F.col(f"{prefix}_signal")},
    ]


def ppo(s: Series, fast: int = 12, slow: int = 26, sign: int = 9) -> list[Step]:
    """Percentage price oscillator."""
    return _oscillator(close(), "momentum_ppo", "", fast, slow, sign)


def pvo(s: Series, fast: int = 12, slow: int = 26, sign: int = 9) -> list[Step]:
    """Percentage volume oscillator."""
    return _oscillator(volume(), "momentum_pvo", "_v", fast, slow, sign)


def kama(s: Series, n: int = 10, fast: int = 2, slow: int = 30) -> list[Step]:
    """Kaufman's adaptive average; starts at the first close with a full window."""
    f, g = 2.0 / (fast + 1), 2.0 / (slow + 1)
    sc = F.col("_kama_sc")
    return [
        {"_step": F.abs(close() - s.lag("close"))},
        {"_er": ratio(F.abs(close() - s.lag("close", n)), rsum(s, "_step", n))},
        {"_kama_sc": ready(F.pow(F.coalesce(F.col("_er"), F.lit(0.0)) * (f - g) + g, F.lit(2.0)), n + 1)},
        [Recurrence("momentum_kama", F.lit(1.0) - sc, sc * close(), F.when(sc.isNotNull(), close()))],
    ]


def returns(s: Series) -> list[Step]:
    """Percent change and log change from the bar before, and since the first bar."""
    prev = s.lag("close")
    return [
        {
            "others_dr": ratio((close() - prev) * 100.0, prev),
            "others_dlr": F.when((close() > 0) & (prev > 0), F.ln(ratio(close(), prev)) * 100.0),
        },
        [first_value("_first_close", close())],
        {"others_cr": ratio((close() - F.col("_first_close")) * 100.0, F.col("_first_close"))},
    ]


RECIPES = {
    "rsi": rsi, "stoch_rsi": stoch_rsi, "tsi": tsi, "ultimate": ultimate, "stochastic": stochastic,
    "awesome": awesome, "roc": roc, "ppo": ppo, "pvo": pvo, "kama": kama,
}
COLUMNS = [
    "momentum_rsi", "momentum_stoch_rsi", "momentum_stoch_rsi_k", "momentum_stoch_rsi_d", "momentum_tsi",
    "momentum_uo", "momentum_stoch", "momentum_stoch_signal", "momentum_wr", "momentum_ao", "momentum_roc",
    "momentum_ppo", "momentum_ppo_signal", "momentum_ppo_hist", "momentum_pvo", "momentum_pvo_signal",
    "momentum_pvo_hist", "momentum_kama",
]
RETURN_RECIPES = {"returns": returns}
RETURN_COLUMNS = ["others_dr", "others_dlr", "others_cr"]
