import numpy as np
import pytest
from pyspark.sql import functions as F

from tidebars.operators import scan as scan_module
from tidebars.operators.expr import F as X
from tidebars.operators.indicators.psar import COLUMNS, psar, psar_step
from tidebars.operators.layout import CHUNK, HALO, HALO_FLAG, POS, keyless_rows, lay_out
from tidebars.operators.scan import Recurrence, affine_scan, ema, first_value, running_sum
from tidebars.operators.windows import cumulative, lag_fill, rolling

pytestmark = pytest.mark.usefixtures("small_chunks")


def by_time(df, *columns, symbol="a"):
    return [tuple(r) for r in df.filter(F.col("symbol") == symbol).orderBy("date_time").select(*columns).collect()]


def test_positions_are_time_ranks_even_over_gaps(make_bars):
    hours = [0, 1, 5, 400, 401, 5000, 5001]
    bars = make_bars([("a", h, 1, 2, 0, 1, 1) for h in reversed(hours)] + [("b", 7, 1, 2, 0, 1, 1)])
    rows = lay_out(bars).body().select("symbol", "date_time", POS).orderBy("symbol", "date_time").collect()
    assert [r[POS] for r in rows] == [*range(len(hours)), 0]


def test_chunks_carry_the_rows_before_them(walk):
    s = lay_out(walk(600))
    copies = s.df.filter(F.col(HALO_FLAG)).groupBy(CHUNK).count().collect()
    assert {r[CHUNK]: r["count"] for r in copies} == {1: HALO, 2: HALO, 3: 88}
    assert s.result().count() == 600


def test_windows_cross_chunk_edges(walk):
    bars = walk(700, ("a", "b"))
    s = rolling(lay_out(bars), "close", 200, m=F.avg, top=F.max)
    got = by_time(s.result("m", "top"), "m", "top")
    close = np.array([r[0] for r in by_time(bars, "close")])
    for t, (m, top) in enumerate(got):
        if t < 199:
            assert m is None and top is None
        else:
            part = close[t - 199 : t + 1]
            assert m == pytest.approx(part.mean()) and top == part.max()


def test_short_series_and_nulls_leave_windows_empty(make_bars, spark):
    bars = make_bars([("a", h, 1, 2, 0, 1, 1) for h in range(5)])
    bars = bars.withColumn("close", F.when(F.hour("date_time") != 2, F.col("close")))
    s = rolling(lay_out(bars), "close", 2, m=F.avg)
    assert [m for (m,) in by_time(s.result("m"), "m")] == [None, 1.0, None, None, 1.0]
    s = rolling(lay_out(bars), "close", 9, m=F.avg)
    assert all(m is None for (m,) in by_time(s.result("m"), "m"))


def test_lag_fill_is_per_symbol(make_bars):
    bars = make_bars([(s, h, 1, 1, 1, 10 * h + (s == "b"), 1) for h in range(3) for s in "ab"])
    out = lag_fill(lay_out(bars), "close", "prev", 0.0).result("prev")
    assert [p for (p,) in by_time(out, "prev")] == [0.0, 0.0, 10.0]
    assert [p for (p,) in by_time(out, "prev", symbol="b")] == [0.0, 1.0, 11.0]


@pytest.mark.parametrize("n", [1, 127, 128, 129, 255, 256, 257, 1000])
def test_scan_equals_loop(walk, n):
    bars = walk(n)
    s = lay_out(bars).add(a=F.lit(0.5) + F.col("tick_vol") / 250.0)
    s = affine_scan(
        s,
        [
            Recurrence("y", F.col("a"), F.col("close"), F.col("open")),
            ema("e", F.col("close"), 3),
            running_sum("total", F.col("tick_vol").cast("double")),
            first_value("start", F.col("close")),
        ],
    )
    rows = by_time(s.result("a", "open", "close", "tick_vol", "y", "e", "total", "start"),
                   "a", "open", "close", "tick_vol", "y", "e", "total", "start")
    y = e = None
    total = 0.0
    for a, o, c, v, *got in rows:
        y = o if y is None else a * y + c
        e = c if e is None else e + (c - e) * 0.5
        total += v
        assert got == pytest.approx([y, e, total, rows[0][2]], rel=1e-10)


def test_scan_skips_rows_without_value(walk):
    bars = walk(600)
    s = lay_out(bars)
    x = F.when((F.col(POS) >= 300) & (F.col(POS) % 7 != 0), F.col("close"))
    s = affine_scan(s.add(x=x), [ema("e", F.col("x"), 9)])
    e = None
    for x, got in by_time(s.result("x", "e"), "x", "e"):
        if x is not None:
            e = x if e is None else e + (x - e) * 0.2
        assert got == (None if e is None else pytest.approx(e))


def test_scan_over_many_levels(walk, monkeypatch):
    monkeypatch.setattr(scan_module, "_GROUP", 4)
    s = affine_scan(lay_out(walk(3000)), [running_sum("n", F.lit(1.0)), ema("e", F.col("close"), 50)])
    rows = by_time(s.result("close", "n", "e"), "close", "n", "e")
    e = None
    for t, (c, n, got) in enumerate(rows, 1):
        e = c if e is None else e + (c - e) * 2 / 51
        assert n == t and got == pytest.approx(e)


def test_parabolic_stop_equals_one_pass(walk):
    bars = walk(900, ("a", "b"), seed=5)
    out = psar(lay_out(bars)).result(*COLUMNS)
    for symbol in "ab":
        state = None
        prices = by_time(bars, "high", "low", symbol=symbol)
        for t, ((high, low), got) in enumerate(zip(prices, by_time(out, *COLUMNS, symbol=symbol))):
            state, turned = psar_step(state, high, low, 0.02, 0.2)
            up = state[0] == 1.0
            expected = (
                state[1] if up and t else None, None if up else state[1],
                float(turned and up), float(turned and not up),
            )
            assert got == expected


def test_parabolic_stop_turns(make_bars):
    path = [10, 11, 12, 13, 14, 15, 9, 8, 7, 6, 5, 12, 13, 14]
    bars = make_bars([("a", h, p, p + 0.5, p - 0.5, p, 1) for h, p in enumerate(path)])
    turns = by_time(psar(lay_out(bars)).result(*COLUMNS), *COLUMNS[2:])
    assert [t for t, (up, down) in enumerate(turns) if down] == [6]
    # the stop has come down to 12.88 at bar 11 and 12.04 at bar 12
    assert [t for t, (up, down) in enumerate(turns) if up] == [12]


def test_a_wrong_guess_is_put_right(make_bars):
    """A steady fall never reverses, so guesses at chunk starts are all wrong at first."""
    n = 1100
    bars = make_bars([("a", h, 0, 5000 - 4 * h + 1.0, 5000 - 4 * h - 1.0, 5000 - 4 * h, 1) for h in range(n)])
    got = by_time(psar(lay_out(bars)).result(*COLUMNS), *COLUMNS[:2])
    state = None
    for t, (high, low) in enumerate(by_time(bars, "high", "low")):
        state, _ = psar_step(state, high, low, 0.02, 0.2)
        assert got[t][0 if state[0] else 1] == (state[1] if t or not state[0] else None)


@pytest.mark.parametrize("rows", [256, 512, 8192])
def test_long_windows_are_whole_at_any_chunk_size(walk, rows):
    bars = walk(1500)
    s = lay_out(bars, chunk_rows=rows, lookback=400)
    s = s.add(m=s.rolling(F.avg, "close", 300), back=s.lag("close", 400))
    got = by_time(s.result("m", "back"), "m", "back")
    close = np.array([r[0] for r in by_time(bars, "close")])
    assert sum(m is not None for m, _ in got) == 1201 and sum(b is not None for _, b in got) == 1100
    assert got[1400][0] == pytest.approx(close[1101:1401].mean()) and got[1400][1] == close[1000]


def test_windows_beyond_the_copies_are_refused(walk):
    s = lay_out(walk(50))
    with pytest.raises(ValueError, match="lookback"):
        s.lag("close", HALO + 1)
    s = s.add(x=s.rolling(F.avg, "close", 200))
    with pytest.raises(ValueError, match="lookback"):
        s.add(y=s.rolling(F.avg, "x", 100))
    s = affine_scan(s, [running_sum("r", F.col("x"))])
    assert s.reach["r"] == 256
    with pytest.raises(ValueError, match="lookback"):
        s.add(z=s.lag("r"))
    with pytest.raises(ValueError):
        ema("e", F.col("close"), 1)


def test_running_product_of_changing_sign(make_bars):
    s = cumulative(lay_out(make_bars([("a", h, c, c, c, c, 1) for h, c in enumerate([10, -5, 20, 40, -40])])), "close")
    assert [r[0] for r in by_time(s.result("cum_product"), "cum_product")] == pytest.approx([1.0, -0.5, 2.0, 4.0, -4.0])


def test_rows_without_key_are_set_apart(make_bars):
    bars = make_bars([(s, h, 1, 1, 1, 1, 1) for s in ("a", "b") for h in range(3)])
    broken = bars.unionByName(bars.limit(1).withColumn("symbol", F.lit(None).cast("string"))).unionByName(
        bars.limit(2).withColumn("date_time", F.lit(None).cast("timestamp_ntz")))
    assert lay_out(broken).result().count() == 6 and keyless_rows(broken).count() == 3


# --- how far back a column reaches ------------------------------------------------------------------------------------


def test_reach_counts_nested_calls_and_quoted_names(walk):
    s = lay_out(walk(600))
    s = s.add(**{"my col": s.lag(X.coalesce(X.abs(X.col("close") - 1), X.lit(0)), 200)})
    assert s.reach["my col"] == 200
    for name in ("my col", "`my col`"):
        with pytest.raises(ValueError, match="400"):
            s.add(z=s.lag(X.greatest(X.col(name), X.lit(0.0)), 200))
    with pytest.raises(ValueError, match="299"):
        rolling(s, "`my col`", 100, m=F.avg)
    with pytest.raises(ValueError, match="299"):
        s.add(z=s.rolling(lambda x: X.sum(x * X.col("`my col`")), "close", 100))
    assert s.add(z=s.lag("`my col`", 56)).reach["z"] == 256


@pytest.mark.parametrize("make, rows", [
    (lambda s: X.col("a") + 1, 10),
    (lambda s: 1 - X.col("a"), 10),
    (lambda s: -X.col("b"), 0),
    (lambda s: X.col("b") + F.col("b"), 30),  # a plain column may be any
    (lambda s: F.col("b"), 30),
    (lambda s: X.expr("b + 1"), 30),
    (lambda s: X.when(X.col("a") > 0, X.col("b")).otherwise(X.col("c")), 30),
    (lambda s: X.struct(X.col("a").alias("x"), X.col("b"))["x"], 10),
    (lambda s: X.aggregate(X.array("b"), X.lit(0.0), lambda acc, x: acc + x * X.col("a")), 10),
    (lambda s: X.array(X.col("a"), X.col("b")).getItem(0), 10),
    (lambda s: X.max(X.col("a")).over(s.window(5)), 14),
    (lambda s: X.sum(X.col("b")).over(s.window(5)) + s.lag(X.col("a") * X.col("b"), 3), 13),
    (lambda s: s.lag(s_lag := X.coalesce(X.col("c"), X.lit(0.0)), 7), 37),
    (lambda s: X.col("a").cast("string").isNull() & X.lit(True), 10),
])
def test_reach_of_expressions(walk, make, rows):
    s = lay_out(walk(300))
    s = s.add(a=s.lag("close", 10), b=F.lit(1.0), c=s.lag("close", 30))
    assert s.add(z=make(s)).reach["z"] == rows


def test_untyped_use_is_an_error(walk):
    s = lay_out(walk(300))
    with pytest.raises(Exception):
        F.coalesce(s.lag("close", 10), F.lit(0.0))
    with pytest.raises(TypeError):
        X.expr("sum(close) OVER (ORDER BY date_time)")
    with pytest.raises(TypeError):
        X.sum("close").over(s.window(5).spec)
    with pytest.raises(ValueError):
        bool(X.col("close") > 1)


def test_reach_of_scans_counts_whole_blocks(walk):
    s = lay_out(walk(600), lookback=512)
    s = s.add(x=s.lag("close", 5))
    s = affine_scan(s, [ema("e", X.col("x"), 3), running_sum("t", X.col("close"))])
    assert (s.reach["e"], s.reach["t"]) == (128, 0)
    assert s.add(z=s.lag(X.col("e") - X.col("t"), 100)).reach["z"] == 228
