import math

import pytest
from pyspark.sql import functions as F

from tidebars.operators.indicators import (
    ALL_COLUMNS, FAMILIES, TECHNICAL_COLUMNS, TECHNICAL_RECIPES, add_all_indicators, add_indicators,
)
from tidebars.operators.layout import lay_out
from tidebars.plans import history, hourly
from tidebars.session import stage


def collect(df, symbol="a"):
    return [r.asDict() for r in df.filter(F.col("symbol") == symbol).orderBy("date_time").collect()]


def test_there_are_86_columns():
    assert {k: len(v) for k, v in FAMILIES.items()} == {"volume": 10, "volatility": 21, "trend": 34, "momentum": 21}
    assert len(set(ALL_COLUMNS)) == 86 and set(TECHNICAL_COLUMNS) <= set(ALL_COLUMNS)


def test_flat_bars_give_no_infinite_values(make_bars):
    bars = make_bars([("a", h, 5, 5, 5, 5, 0) for h in range(90)])
    rows = collect(add_all_indicators(lay_out(bars)).result(*ALL_COLUMNS))
    for row in rows:
        assert all(v is None or math.isfinite(v) for k, v in row.items() if k in ALL_COLUMNS)
    last = rows[-1]
    assert last["trend_sma_fast"] == 5 and last["trend_ema_slow"] == pytest.approx(5)
    assert last["volume_adi"] == 0 and last["others_cr"] == 0 and last["momentum_stoch"] is None
    assert last["momentum_rsi"] == 100 and last["volatility_atr"] == 0


def test_short_series_give_nulls(make_bars):
    rows = collect(add_indicators(lay_out(make_bars([("a", h, 1, 2, 0, 1, 1) for h in range(5)])), ["sma", "ema"]).result())
    assert all(r["trend_sma_fast"] is None and r["trend_ema_slow"] is None for r in rows)


def test_symbols_do_not_mix_and_input_order_does_not_matter(walk, small_chunks):
    two = walk(300, ("a", "b"))
    alone = collect(add_indicators(lay_out(two.filter("symbol = 'b'")), ["rsi", "macd", "bollinger"]).result(), "b")
    mixed = collect(add_indicators(lay_out(two.orderBy(F.rand(3))), ["rsi", "macd", "bollinger"]).result(), "b")
    for x, y in zip(alone, mixed):
        for k, v in x.items():
            assert y[k] == (pytest.approx(v) if isinstance(v, float) else v)


def test_ranges(walk, small_chunks):
    rows = collect(add_indicators(lay_out(walk(400)), ["rsi", "stochastic", "mfi", "aroon", "stoch_rsi", "adx", "stc"]).result())
    for r in rows:
        for c in ("momentum_rsi", "momentum_stoch", "volume_mfi", "trend_aroon_up", "trend_aroon_down", "trend_adx", "trend_stc"):
            assert r[c] is None or -1e-9 <= r[c] <= 100 + 1e-9
        assert r["momentum_stoch_rsi"] is None or 0 <= r["momentum_stoch_rsi"] <= 1


def test_first_values_by_hand(make_bars):
    closes = [1.0, 2.0, 4.0, 3.0, 3.0]
    volumes = [10, 20, 30, 40, 50]
    bars = make_bars([("a", h, c, c + 1, c - 1, c, v) for h, (c, v) in enumerate(zip(closes, volumes))])
    rows = collect(add_indicators(lay_out(bars), ["obv", "vpt", "returns", "nvi"]).result())
    assert [r["volume_obv"] for r in rows] == pytest.approx([10, 30, 60, 20, 70])
    assert [r["volume_vpt"] for r in rows] == pytest.approx([0, 20, 50, 40, 40])
    assert [r["others_cr"] for r in rows] == pytest.approx([0, 100, 300, 200, 200])
    assert [r["volume_nvi"] for r in rows] == pytest.approx([1000] * 5)


@pytest.mark.parametrize(
    "cuts, names",
    [([300, 305, 640, 700], ["returns", "ema", "kama", "obv", "stc"]), ([400, 700], [*TECHNICAL_RECIPES, "stoch_rsi", "adx", "nvi"])],
)
def test_runs_in_pieces_equal_one_run(walk, cuts, names):
    """All scans and the windows on top of them continue exactly."""
    bars = stage(walk(700, ("a", "b"), seed=9))
    whole = add_indicators(lay_out(bars), names)
    columns = [c for c in whole.result().columns if "_" in c and c not in ("date_time", "tick_vol")]
    expected = {(r["symbol"], r["date_time"]): r for r in whole.result().collect()}
    stored = carry = None
    seen = 0
    for cut in cuts:
        until = F.lit("2024-01-01").cast("timestamp_ntz") + F.expr(f"INTERVAL {cut} HOUR")
        new = hourly.new_bars(bars.filter(F.col("date_time") < until), stored)
        rows, series = hourly.load_step(new, stored, carry, names)
        rows = stage(rows)
        carry = stage(hourly.next_carry(series))
        for r in rows.collect():
            seen += 1
            want = expected[(r["symbol"], r["date_time"])]
            for c in columns:
                assert r[c] == (None if want[c] is None else pytest.approx(want[c], rel=1e-9, abs=1e-9)), (c, r["date_time"])
        stored = rows if stored is None else stage(stored.unionByName(rows))
    assert seen == len(expected)
    again = hourly.new_bars(bars, stored)
    assert again.isEmpty()


def test_feature_table_and_selection(walk):
    bars = walk(300)
    features = history.feature_table(bars)
    assert len(features.columns) == 2 + 1 + 3 + 24 + 8
    unlagged = collect(history.technical_table(bars))
    lagged = collect(features)
    assert lagged[100]["trend_sma_fast"] == pytest.approx(unlagged[99]["trend_sma_fast"])
    table, chosen = history.selected_features(bars, more_than=200)
    names = {r["feature"] for r in chosen.collect()}
    assert "trend_sma_fast" in names and set(table.columns) == {"symbol", "date_time", *names}
    assert table.filter(F.col("trend_sma_fast").isNull()).isEmpty()
