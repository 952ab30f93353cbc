import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidebars.operators import monitor, profile
from tidebars.operators.signals import bracket_levels, trade_signal


def numbers(spark, values, name="x"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double")


@pytest.mark.parametrize(
    "values",
    [
        [3.0], [1, 2], list(range(1000)), [5] * 300 + [7] * 200 + [1e9], [None, 1, 2, None, 10],
        list(np.random.default_rng(3).lognormal(0, 3, 4000)),
    ],
)
def test_narrowed_quantiles_equal_sorting(spark, monkeypatch, values):
    monkeypatch.setattr(profile, "_BINS", 8)
    probs = (0.0, 0.25, 0.5, 0.75, 0.99, 1.0)
    got = profile.quantiles(numbers(spark, values), ["x"], probs)["x"]
    known = [v for v in values if v is not None]
    assert got == pytest.approx(list(np.quantile(known, probs)))


def test_quantiles_of_nothing(spark, monkeypatch):
    empty = numbers(spark, [None, None])
    assert profile.quantiles(empty, ["x"], (0.5,))["x"] == [None]


def test_quantiles_with_nan_and_infinities(spark):
    rows = [(1.0, math.nan), (2.0, -math.inf), (3.0, 1.0), (math.nan, math.inf), (None, 5.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    got = profile.quantiles(df, ["x", "y"], (0.0, 0.25, 0.5, 1.0))
    assert got["x"][:3] == [1.0, 1.75, 2.5] and math.isnan(got["x"][3])
    assert got["y"][:3] == [-math.inf, 1.0, 5.0] and math.isnan(got["y"][3])
    wide = spark.createDataFrame([(-1e308,), (1e308,), (0.0,)], "x double")
    assert profile.quantiles(wide, ["x"], (0.5,))["x"] == [0.0]


def test_constant_and_collinear_columns(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=200), rng.normal(size=200)
    df = spark.createDataFrame([(float(x), float(y), float(x + y), 7.0, float(x)) for x, y in zip(a, b)], "a double, b double, s double, c double, t double")
    r = {(x["feature_x"], x["feature_y"]): x["r"] for x in profile.corr_matrix(df, ["a", "s", "c"]).collect()}
    assert r["a", "s"] == pytest.approx(np.corrcoef(a, a + b)[0, 1]) and r["a", "a"] == pytest.approx(1.0) and r["a", "c"] is None
    assert {x["feature"] for x in profile.corr_select(df, ["a", "b", "c", "s"], "t", 0.5).collect()} == {"a", "s"}
    v = {x["feature"]: x["vif"] for x in profile.vif(df, ["a", "b", "s", "c"]).collect()}
    assert v == {"a": math.inf, "b": math.inf, "s": math.inf, "c": None}
    assert profile.collinearity_profile(df, ["a", "b", "c"]).count() == 3


def test_windows_leave_out_rows_without_a_value(spark):
    rows = [(f"2024-01-01 {h:02d}:00:00", float(h), float(h)) for h in range(20)]
    lost = rows + [("2024-01-01 21:00:00", None, 3.0), ("2024-01-01 22:00:00", None, None)]
    for data, n in ((rows, 20), (lost, 21)):
        df = spark.createDataFrame(data, "t string, close double, p double").withColumn("date_time", F.to_timestamp_ntz("t"))
        got = monitor.monitor_window(df, "close", "p").first()
        assert got["n"] == n and got["psi"] == pytest.approx(0.0, abs=0.02) and got["status"] == "green"


def test_kde_without_values(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (4.0, None)], "a double, b double")
    rows = monitor.kde_grid(df, "a", "b", 50).collect()
    assert len(rows) == 50 and all(r["density_b"] is None and r["density_a"] > 0 for r in rows)
    assert monitor.kde_grid(df.select(F.col("b").alias("a"), "b"), "a", "b", 50).collect() == []


def _psi(a, b, edges):
    x, y = (np.histogram(v, edges)[0] / len(v) for v in (a, b))
    x, y = (np.where(v == 0, 1e-6, v) for v in (x, y))
    return float(((y - x) * np.log(y / x)).sum())


def test_psi(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(0, 1, 500), rng.normal(0.5, 1, 400)
    da, db = numbers(spark, a), numbers(spark, b)
    same = monitor.psi(da, da, "x", bins=10).first()
    assert same["psi"] == pytest.approx(0)
    pooled = np.concatenate([a, b])
    got = monitor.psi(da, db, "x").first()
    edges = np.histogram_bin_edges(pooled, bins="doane")
    assert got["bins"] == len(edges) - 1 and got["psi"] == pytest.approx(_psi(a, b, edges))
    fixed = monitor.psi(da, db, "x", bins=7).first()
    assert fixed["psi"] == pytest.approx(_psi(a, b, np.linspace(pooled.min(), pooled.max(), 8)))


def test_psi_counts_empty_bins(spark):
    a, b = [0, 0.1, 9.9, 10], [0, 0.1, 5, 10]
    got = monitor.psi(numbers(spark, a), numbers(spark, b), "x", bins=5).first()["psi"]
    assert got == pytest.approx(_psi(a, b, np.linspace(0, 10, 6)))
    assert monitor.psi(numbers(spark, [1, 1]), numbers(spark, [1]), "x").first()["psi"] == pytest.approx(0)


def test_drift_light(spark):
    rows = monitor.psi_status(spark.createDataFrame([(0.25,), (0.26,)], "psi double")).orderBy("psi").collect()
    assert [r["status"] for r in rows] == ["green", "red"]


def test_kde(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(0, 1, 300).round(2), rng.normal(1, 2, 300).round(2)
    df = spark.createDataFrame(list(zip(a.tolist(), b.tolist())), "a double, b double")
    rows = monitor.kde_grid(df, "a", "b", 50).orderBy("point").collect()
    grid = np.linspace(min(a.min(), b.min()), max(a.max(), b.max()), 50)
    h = 300 ** -0.2 * a.std(ddof=1)
    density = np.exp(-0.5 * ((grid[:, None] - a) / h) ** 2).sum(1) / (300 * h * math.sqrt(2 * math.pi))
    assert [r["x"] for r in rows] == pytest.approx(list(grid))
    assert [r["density_a"] for r in rows] == pytest.approx(list(density))


def test_errors_and_bic(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 5.0)], "y double, p double")
    assert monitor.mse(df, "y", "p").first()[0] == pytest.approx(5 / 3)
    assert monitor.rmse(df, "y", "p").first()[0] == pytest.approx(math.sqrt(5 / 3))
    assert monitor.bic(df, "y", "p", 2).first()[0] == pytest.approx(3 * math.log(5 / 3) + 3 * math.log(3))


def test_histogram_closes_its_last_bin(spark):
    rows = profile.histogram(numbers(spark, [0, 1, 2, 10]), "x", 5).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [2, 1, 0, 0, 1]


def test_vif_and_outliers(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 2))
    z = x[:, 0] + 0.1 * x[:, 1]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x[:, 0], z)], "a double, b double")
    r = np.corrcoef(x[:, 0], z)[0, 1]
    assert [v["vif"] for v in profile.vif(df, ["a", "b"]).collect()] == pytest.approx([1 / (1 - r * r)] * 2)
    flat = spark.createDataFrame([(i, 1.0, 100.0 if i == 3 else 0.0) for i in range(10)], "k int, c double, v double")
    assert [r["k"] for r in profile.zscore_outliers(flat, ["c", "v"], ["k"]).collect()] == [3]


def test_signals(spark):
    quotes = [(1, 0.99, 1.0, 1.5), (2, 0.99, 1.0, 0.5), (3, 0.99, 1.0, 1.0), (4, 0.99, None, 1.5), (5, 0.0, 1.0, 1.5)]
    df = trade_signal(spark.createDataFrame(quotes, "k int, bid double, ask double, prediction double"))
    assert {r["k"]: r["side"] for r in df.collect()} == {1: "BUY", 2: "SELL", 3: None, 4: None, 5: None}
    buy, sell = bracket_levels(df).orderBy("k").collect()
    assert (buy["price"], buy["take_profit"], buy["stop_loss"], buy["volume"]) == pytest.approx((1.0, 1.001, 0.999, 0.01))
    assert (sell["price"], sell["take_profit"], sell["stop_loss"]) == pytest.approx((0.99, 0.999, 1.001))


@pytest.mark.parametrize("wide", [12, 1])
def test_correlations_of_frames_with_gaps(spark, monkeypatch, wide):
    """Built-in aggregates and matrix products agree with each pair computed alone."""
    monkeypatch.setattr(profile, "WIDE", wide)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 6)) * [1, 1e-6, 1e7, 1, 1, 1] + [0, 5, 1e9, 0, 0, 3]
    x[:, 3] = x[:, 0] * 2 + 1
    x[:, 5] = 3.0
    gaps = rng.random((400, 6)) < [0, 0.3, 0.1, 0, 0.5, 0]
    x[:, 4] = np.where(gaps[:, 1], x[:, 4], 2.0)  # moves, but not where the second column has values
    rows = [tuple(None if g else float(v) for v, g in zip(r, m)) for r, m in zip(x, gaps)]
    names = ["a", "b", "c", "d", "e", "f"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(5)
    got = {(r["feature_x"], r["feature_y"]): r["r"] for r in profile.corr_matrix(df, names).collect()}
    assert len(got) == 36
    for i, p in enumerate(names):
        for j, q in enumerate(names):
            both = ~gaps[:, i] & ~gaps[:, j]
            u, v = x[both, i], x[both, j]
            want = None if u.min() == u.max() or v.min() == v.max() else np.corrcoef(u, v)[0, 1]
            assert got[p, q] == (None if want is None else pytest.approx(want, abs=1e-9)), (p, q)
    assert profile.corr_matrix(df.limit(0), names).filter("r IS NOT NULL").count() == 0
    assert {r["feature"] for r in profile.corr_select(df, names, "a", 0.9).collect()} == {"a", "d"}
    v = {r["feature"]: r["vif"] for r in profile.vif(df.select("a", "c", "d", "f"), ["a", "c", "d", "f"]).collect()}
    assert v["a"] == v["d"] == math.inf and v["c"] == pytest.approx(1, abs=0.1) and v["f"] is None


@pytest.mark.parametrize("width, slide", [("5 hours", "2 hours"), ("6 hours", "2 hours"), ("90 minutes", "1 hour"), ("1 day", None)])
def test_windows_of_slices_equal_windows_of_copied_rows(spark, width, slide):
    rng = np.random.default_rng(6)
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(minutes=int(m)), *[None if rng.random() < 0.1 else float(v) for v in rng.normal(size=2)]) for m in rng.integers(0, 3000, 400)]
    df = spark.createDataFrame([*rows, (None, 1.0, 1.0)], "date_time timestamp_ntz, a double, b double").repartition(4)
    got = {r["window_start"]: r for r in monitor.monitor_window(df, "a", "b", width, slide, bins=5).collect()}
    copied = df.select(F.window("date_time", width, slide).alias("w"), "a", "b").groupBy(F.col("w.start").alias("w")).agg(
        F.collect_list(F.struct("a", "b")).alias("rows")).collect()
    assert {r["w"] for r in copied} == set(got)
    for r in copied:
        a, b = ([x[c] for x in r["rows"] if x[c] is not None] for c in "ab")
        both = [(x["a"] - x["b"]) ** 2 for x in r["rows"] if x["a"] is not None and x["b"] is not None]
        one = got[r["w"]]
        assert one["n"] == len(b) and one["rmse"] == (pytest.approx(np.sqrt(np.mean(both))) if both else None)
        low, high = min(a + b), max(a + b)
        if not a or not b or low == high:
            continue
        share = [np.maximum(np.bincount(np.minimum(((np.array(x) - low) / ((high - low) / 5)).astype(int), 4), minlength=5) / len(x), 0) for x in (a, b)]
        share = [np.where(s == 0, 1e-6, s) for s in share]
        assert one["psi"] == pytest.approx(float(np.sum((share[1] - share[0]) * np.log(share[1] / share[0]))))


def test_density_by_nodes_is_that_of_the_values(spark):
    rng = np.random.default_rng(8)
    a, b = np.concatenate([rng.normal(size=700), [9.0]]), rng.exponential(0.01, 701) + 3
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double").repartition(4)
    got = monitor.kde_grid(df, "a", "b", points=200).orderBy("point").collect()
    for name, values in (("density_a", a), ("density_b", b)):
        h = len(values) ** -0.2 * values.std(ddof=1)
        x = np.array([r["x"] for r in got])
        want = np.exp(-0.5 * ((x[:, None] - values) / h) ** 2).mean(axis=1) / (h * np.sqrt(2 * np.pi))
        top = 1 / (h * np.sqrt(2 * np.pi))
        assert np.abs(np.array([r[name] for r in got]) - want).max() < 6e-9 * top


@pytest.mark.parametrize("margin", [0.003, 0.0, -0.2, 0.5])
def test_quantiles_are_exact_whatever_the_sketch_says(spark, monkeypatch, margin):
    """Narrow, missing and wide brackets; ties, infinite values, NaN and nulls."""
    monkeypatch.setattr(profile, "MARGIN", margin)
    monkeypatch.setattr(profile, "SKETCH", 8)
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=3000), np.round(rng.exponential(3, 3000))
    a[:3], b[:40] = [np.inf, -np.inf, np.nan], 7.0
    rows = [(float(x), None if i % 5 == 0 else float(y), 2.0) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(6)
    got = profile.quantiles(df, ["a", "b", "c"], (0.0, 0.01, 0.25, 0.5, 0.9, 1.0))
    whole = np.sort(a)  # NaN last
    kept = b[np.arange(3000) % 5 != 0]
    for values, found in ((whole, got["a"]), (kept, got["b"]), (np.full(9, 2.0), got["c"])):
        at = np.array([0.0, 0.01, 0.25, 0.5, 0.9, 1.0]) * (len(values) - 1)
        values = np.sort(values)
        low, high = values[np.floor(at).astype(int)], values[np.ceil(at).astype(int)]
        with np.errstate(invalid="ignore"):
            want = np.where(low == high, low, low + (high - low) * (at - np.floor(at)))
        assert np.allclose(found, want, rtol=1e-12, equal_nan=True)
