import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidebars.operators import features as X
from tidebars.operators import moments as M
from tidebars.operators import profile
from tidebars.operators.layout import lay_out
from tidebars.plans import autoregression as A
from tidebars.plans import models as P


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(240, 4)) * [1, 10, 0.1, 3] + [5, 0, 1, -2]
    y = 50 + x @ [2.0, 0.3, 0.0, -1.0] + rng.normal(0, 0.5, 240)
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, "row int, a double, b double, c double, d double, y double").cache()


NAMES = ["a", "b", "c", "d"]


def gram(df):
    stats = M.moments(df.withColumn("block", F.lit(0)), [*NAMES, "y"], "block")
    return stats, stats.blocks[0]


def scaled(x):
    return (x - x.mean(0)) / x.std(0)


def test_linear_ridge_lasso_and_components(data):
    x, y, df = data
    stats, g = gram(df)
    ones = np.c_[np.ones(len(y)), x]
    beta = np.linalg.lstsq(ones, y, rcond=None)[0]
    got = P._in_data_units(M.solve_linear(g, [1, 2, 3, 4]), stats, NAMES)
    assert [got["intercept"], *got["coefficients"].values()] == pytest.approx(list(beta))

    z, t = scaled(x), y - y.mean()
    ridge = np.linalg.solve(z.T @ z + 30 * np.eye(4), z.T @ t)
    got = P._in_data_units(M.solve_ridge(g, [1, 2, 3, 4], 30.0), stats, NAMES)
    assert list(got["coefficients"].values()) == pytest.approx(list(ridge / x.std(0)))

    # the penalty is in units of the scaled target
    fit = M.solve_lasso(g, [1, 2, 3, 4], 0.1)
    w = fit.weights[1:]
    zt = t / y.std()
    grad = z.T @ (zt - z @ w) / len(y)
    for j in range(4):
        assert abs(grad[j]) <= 0.1 + 1e-6
        if abs(w[j]) > 1e-9:
            assert grad[j] == pytest.approx(0.1 * np.sign(w[j]), abs=1e-5)

    values, vectors = np.linalg.eigh(z.T @ z / len(y))
    top = vectors[:, np.argsort(values)[::-1][:2]]
    comp = np.linalg.lstsq(z @ top, t, rcond=None)[0]
    got = P._in_data_units(M.solve_pca(g, [1, 2, 3, 4], 2), stats, NAMES)
    assert list(got["coefficients"].values()) == pytest.approx(list(top @ comp / x.std(0)))


def test_residuals_and_no_intercept(data):
    x, y, df = data
    stats, g = gram(df)
    fit = M.solve_linear(g, [1, 2, 3, 4], stats.target_zero)
    model = P._in_data_units(fit, stats, NAMES)
    z = scaled(x)
    beta = np.linalg.lstsq(z, y, rcond=None)[0]
    rss = ((y - z @ beta) ** 2).sum()
    assert M.residual_squares(g, fit) * stats.scale[-1] ** 2 == pytest.approx(rss)
    got = [r[0] for r in df.orderBy("row").select(P.linear_prediction(model)).collect()]
    assert got == pytest.approx(list(z @ beta))


def test_elimination_drops_the_idle_column_first(data):
    _, _, df = data
    rows = {r["feature"]: (r["rank"], r["kept"]) for r in P.rfe(df, NAMES, "y", 3).collect()}
    assert rows["c"] == (2, False) and all(rows[n] == (1, True) for n in "abd")


def test_grid_equals_fitting_every_fold(data):
    x, y, df = data
    best = P.linear_grid_search(df, NAMES, "y", ["ridge", "linear"], 240, 5)
    starts = X.fold_starts(240, 5)
    assert starts == [40, 80, 120, 160, 200]

    def score(alpha):
        out = []
        for s in starts:
            mean, sd = x[:s].mean(0), x[:s].std(0)
            z = (x[:s] - mean) / sd
            w = np.linalg.solve(z.T @ z + alpha * np.eye(4), z.T @ (y[:s] - y[:s].mean()))
            e = y[s : s + 40] - y[:s].mean() - (x[s : s + 40] - mean) / sd @ w
            out.append(-(40 * math.log((e**2).mean()) + 5 * math.log(40)))
        return np.mean(out)

    scores = [score(a) for a in P.ALPHAS]
    assert best["ridge"]["params"]["alpha"] == P.ALPHAS[int(np.argmax(scores))]
    assert best["ridge"]["score"] == pytest.approx(max(scores))
    assert best["linear"]["params"] == {"intercept": True}


def test_splits():
    assert X.split_sizes(1000) == (897, 950)
    assert X.cut_at(999, 0.85) == 849
    for n, k in ((100, 5), (11, 3), (6, 5)):
        starts = X.fold_starts(n, k)
        size = n // (k + 1)
        assert starts[-1] + size == n and all(b - a == size for a, b in zip(starts, starts[1:])) and starts[0] >= size


def test_rows_and_folds_keep_time_order(walk):
    df = X.with_fold(X.with_row(walk(120, ("a", "b"))), 240, 5)
    spans = df.groupBy("block").agg(F.min("date_time").alias("a"), F.max("date_time").alias("z"), F.count("*").alias("n")).orderBy("block").collect()
    assert [s["n"] for s in spans] == [40] * 6
    assert all(p["z"] <= q["a"] for p, q in zip(spans, spans[1:]))


def test_pipeline_round_trip_and_scores(data, tmp_path):
    _, _, df = data
    split = X.time_split(df, 240)
    model = P.linear_pipeline(NAMES, "y").fit(split.filter("slice = 'train'"))
    P.save_model(model, str(tmp_path / "m"))
    again = P.load_model(str(tmp_path / "m"))
    a = {r["slice"]: r["rmse"] for r in P.evaluate_slices(model, split, "y").collect()}
    b = {r["slice"]: r["rmse"] for r in P.evaluate_slices(again, split, "y").collect()}
    assert a == pytest.approx(b) and set(a) == {"val", "test"} and max(a.values()) < 1
    assert "row" in P.predict(model, df).columns


def test_bic_evaluator_and_p_values(data):
    x, y, df = data
    summary = {r["feature"]: r for r in P.ols_summary(df, NAMES, "y").collect()}
    ones = np.c_[x, np.ones(len(y))]
    beta = np.linalg.lstsq(ones, y, rcond=None)[0]
    s2 = ((y - ones @ beta) ** 2).sum() / (len(y) - 5)
    se = np.sqrt(np.diag(np.linalg.inv(ones.T @ ones)) * s2)
    assert [summary[n]["std_err"] for n in [*NAMES, "const"]] == pytest.approx(list(se), rel=1e-6)
    assert P.pvalue_select(df, NAMES, "y") == ["a", "b", "d"]


def test_orders_are_found(make_bars):
    rng = np.random.default_rng(11)
    y, rows = [0.0, 0.0], []
    for _ in range(1500):
        y.append(0.6 * y[-1] - 0.5 * y[-2] + rng.normal())
    walk = np.cumsum(y)
    rows = [("a", h, v, v, v, v, 1) for h, v in enumerate(y)] + [("b", h, v, v, v, v, 1) for h, v in enumerate(walk)]
    got = {r["symbol"]: (r["p"], r["d"], r["q"]) for r in A.ar_grid(lay_out(make_bars(rows)), p_values=range(4), q_values=range(2)).collect()}
    # one unit root, found as a difference or as a third lag
    assert got["a"] == (2, 0, 0) and got["b"][0] + got["b"][1] == 3


def test_mean_forecast_is_the_training_mean(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(20)], "symbol string, position int, close double")
    sizes = df.groupBy("symbol").agg(F.count("*").alias("n"))
    row = P.mean_forecast(df, sizes).first()
    assert row["forecast"] == 8.0 and row["n_test"] == 3
    assert row["mse"] == pytest.approx(np.mean([(v - 8.0) ** 2 for v in (17, 18, 19)]))


@pytest.mark.parametrize("alpha", [0.05, 0.5, 5.0])
def test_lasso_of_the_grid_is_that_of_the_pipeline(data, monkeypatch, alpha):
    x, y, df = data
    monkeypatch.setattr(P, "ALPHAS", [alpha])
    best = P.linear_grid_search(df, NAMES, "y", ["lasso"], 240, 5)["lasso"]
    model = P.lasso_pipeline(NAMES, "y", alpha).fit(df)
    slopes = model.stages[-1].coefficients.toArray() / x.std(0, ddof=1)
    # the pipeline scales by the sample deviation, the grid by that of the population
    assert [best["coefficients"][n] for n in NAMES] == pytest.approx(list(slopes), rel=0.02, abs=0.02 * max(abs(slopes)))


def test_scores_of_the_grids_compare(data):
    _, _, df = data
    stats, g = gram(df)
    fit = M.solve_linear(g, [1, 2, 3, 4])
    line = P._in_data_units(fit, stats, NAMES)
    scored = df.withColumn("prediction", P.linear_prediction(line))
    assert M.bic_score(g, fit, 4, stats.scale[-1]) == pytest.approx(P.BicEvaluator("y", 4).evaluate(scored))


def test_least_squares_of_collinear_inputs(data):
    _, _, df = data
    wide = df.withColumn("same", F.col("a") + F.col("b")).withColumn("one", F.lit(3.0))
    got = {r["feature"]: r for r in P.ols_summary(wide, [*NAMES, "same", "one"], "y").collect()}
    want = {r["feature"]: r for r in P.ols_summary(df, NAMES, "y").collect()}
    assert got["same"]["coef"] is None and got["one"]["p"] is None
    for name in [*NAMES, "const"]:
        assert [got[name][c] for c in ("coef", "std_err", "t", "p")] == pytest.approx([want[name][c] for c in ("coef", "std_err", "t", "p")])
    assert P.pvalue_select(wide, [*NAMES, "same", "one"], "y") == P.pvalue_select(df, NAMES, "y")


def _arma(n, ar, ma, d, seed):
    rng = np.random.default_rng(seed)
    e, w = rng.normal(0, 1, n + 50), np.zeros(n + 50)
    for t in range(len(w)):
        w[t] = 0.3 + sum(a * w[t - 1 - i] for i, a in enumerate(ar) if t > i) + sum(m * e[t - 1 - j] for j, m in enumerate(ma) if t > j) + e[t]
    y = w[50:]
    for _ in range(d):
        y = np.cumsum(y)
    return 100.0 + y


@pytest.mark.parametrize("order", [(1, 0, 0), (2, 1, 0), (0, 0, 1), (1, 1, 1), (0, 2, 0), (3, 2, 2), (0, 0, 0), (0, 1, 2)])
def test_forecast_equals_a_walk_from_the_end_of_training(make_bars, small_chunks, order):
    p, d, q = order
    values = {"a": _arma(900, [0.5, -0.2, 0.1][:p], [0.6, 0.2][:q], d, 1), "b": _arma(300, [0.5, -0.2, 0.1][:p], [0.6, 0.2][:q], d, 2)}
    bars = make_bars([(s, h, v, v, v, v, 1) for s, y in values.items() for h, v in enumerate(y)])
    args = dict(p_values=(p,), d_values=(d,), q_values=(q,), train=0.7)
    fitted = {r["symbol"]: r for r in A.ar_grid(lay_out(bars), **args).collect()}
    got = A.ar_forecast(lay_out(bars), **args).orderBy("symbol", "date_time").collect()
    for s, y in values.items():
        cut, end = int(len(y) * 0.7), int(len(y) * 0.85)
        one, shift = fitted[s], y[:cut].mean()
        w = np.diff(y[:cut] - shift, d) if d else y[:cut] - shift
        ar, ma = np.array(one["ar"]), np.array(one["ma"])
        assert len(ar) == p and len(ma) == q
        e = np.zeros(len(w))
        for t in range(max(p, q), len(w)):
            e[t] = w[t] - one["start"] - ar @ w[t - p:t][::-1] - ma @ e[t - q:t][::-1]
        w, e = list(w), list(e)
        for _ in range(end - cut):
            w.append(one["start"] + sum(a * w[-1 - i] for i, a in enumerate(ar)) + sum(m * e[-1 - j] for j, m in enumerate(ma)))
            e.append(0.0)
        ahead = np.array(w[-(end - cut):])
        for k in range(d - 1, -1, -1):
            last = np.diff(y[:cut] - shift, k)[-1]
            ahead = last + np.cumsum(ahead)
        mine = np.array([r["forecast"] for r in got if r["symbol"] == s])
        assert np.allclose(mine, ahead + shift, rtol=1e-6, atol=1e-6), (s, order)
    assert {r["symbol"]: r["n"] for r in A.forecast_error(A.ar_forecast(lay_out(bars), **args)).collect()} == {"a": 135, "b": 45}


def test_weights_are_those_of_least_squares(make_bars, small_chunks):
    y = _arma(800, [0.5, -0.3], [], 1, 7)
    bars = make_bars([("a", h, v, v, v, v, 1) for h, v in enumerate(y)])
    one = A.ar_grid(lay_out(bars), p_values=(2,), d_values=(1,), q_values=(0,)).first()
    w = np.diff(y)
    x = np.column_stack([np.ones(len(w) - 2), w[1:-1], w[:-2]])
    beta, rest = np.linalg.lstsq(x, w[2:], rcond=None)[:2]
    assert [one["start"], *one["ar"]] == pytest.approx(beta) and one["n"] == len(w) - 2
    assert one["bic"] == pytest.approx(len(x) * np.log(rest[0] / len(x)) + 3 * np.log(len(x)))


def test_short_and_flat_series_have_no_crash(make_bars):
    bars = make_bars([("short", h, 1, 1, 1, h, 1) for h in range(3)] + [("flat", h, 5, 5, 5, 5, 1) for h in range(80)])
    done = A.ar_forecast(lay_out(bars), p_values=range(3), d_values=range(2), q_values=range(2)).collect()
    assert {r["symbol"] for r in done} == {"flat"} and all(r["forecast"] == pytest.approx(5.0) for r in done)


def test_near_collinear_features_keep_their_digits(spark):
    """Condition 1e8: cross products have no digits left, the triangular factor has eight."""
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(2, 500))
    near = a + 1e-8 * b
    y = 1.0 + 2.0 * a + 3.0 * near
    rows = [tuple(map(float, r)) for r in zip(a, near, b, a + b, np.ones(500) * 4, y)]
    df = spark.createDataFrame(rows, "a double, near double, b double, both double, flat double, y double").repartition(6)
    got = {r["feature"]: r for r in P.ols_summary(df, ["a", "near"], "y").collect()}
    assert got["a"]["coef"] + got["near"]["coef"] == pytest.approx(5.0, rel=1e-10)
    assert got["near"]["coef"] == pytest.approx(3.0, rel=1e-6) and got["const"]["coef"] == pytest.approx(1.0, rel=1e-8)
    got = {r["feature"]: r["coef"] for r in P.ols_summary(df, ["a", "b", "both", "flat"], "y").collect()}
    assert got["both"] is None and got["flat"] is None and got["a"] == pytest.approx(5.0, rel=1e-6)
    v = {r["feature"]: r["vif"] for r in profile.vif(df, ["a", "near"]).collect()}
    assert 1e15 < v["a"] < 1e17
    v = {r["feature"]: r["vif"] for r in profile.vif(df, ["a", "b", "both"]).collect()}
    assert set(v.values()) == {math.inf}


def test_lassos_together_are_those_alone(data):
    x, y, df = data
    stats = M.moments(df.withColumn("block", F.lit(0)), [*NAMES, "y"], "block")
    gram, index = stats.blocks[0], list(range(1, len(NAMES) + 1))
    for alpha, fit in zip([0.001, 0.1, 0.5], M.solve_lassos(gram, index, [0.001, 0.1, 0.5])):
        assert fit.weights == pytest.approx(M.solve_lasso(gram, index, alpha).weights, abs=1e-6)


def test_first_trees_of_a_forest_are_scored(data, spark):
    x, y, df = data
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

    rows = VectorAssembler(inputCols=NAMES, outputCol="features").transform(df).select("row", "y", "features")
    forest = RandomForestRegressor(labelCol="y", numTrees=8, maxDepth=4, seed=1).fit(rows)
    alone = [np.array([r["prediction"] for r in t.transform(rows).orderBy("row").collect()]) for t in forest.trees]
    truth = np.array([r["y"] for r in rows.orderBy("row").collect()])
    want = [float(((np.mean(alone[:k], axis=0) - truth) ** 2).mean()) for k in (1, 3, 8)]
    assert P._prefix_errors(forest, rows, "y", [1, 3, 8]) == pytest.approx(want)
    boost = GBTRegressor(labelCol="y", maxIter=5, maxDepth=2, seed=1).fit(rows)
    whole = GBTRegressor(labelCol="y", maxIter=3, maxDepth=2, seed=1).fit(rows).transform(rows).orderBy("row").collect()
    want = float(((np.array([r["prediction"] for r in whole]) - truth) ** 2).mean())
    assert P._prefix_errors(boost, rows, "y", [3, 5])[0] == pytest.approx(want)
    best = P.prefix_grid_search(df, NAMES, "y", "boost", {"maxIter": [1, 4], "maxDepth": [2], "stepSize": [0.3]}, 240, 2)
    assert best["params"] == {"maxDepth": 2, "stepSize": 0.3, "maxIter": 4}


def test_boosting_jobs_have_as_many_tasks_as_rows_ask_for(data, monkeypatch):
    """However many partitions the rows come in, each of the many small jobs has those its rows need; scores are those of plain fits."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    _, _, df = data
    fit, parts = GBTRegressor.fit, []
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, train, *a: (parts.append(train.rdd.getNumPartitions()), fit(self, train, *a))[1])
    grid = {"maxIter": [2, 3], "maxDepth": [2], "stepSize": [0.1, 0.3]}
    best = P.prefix_grid_search(df.repartition(40, "row"), NAMES, "y", "boost", grid, 240, 2)
    assert parts == [1] * 4
    rows = VectorAssembler(inputCols=NAMES, outputCol="features").transform(df).coalesce(1).persist()
    want = {}
    for step in grid["stepSize"]:
        for k in grid["maxIter"]:
            for start in (80, 160):
                model = fit(GBTRegressor(labelCol="y", maxIter=k, maxDepth=2, stepSize=step, seed=42), rows.filter(F.col("row") < start))
                held = model.transform(rows.filter(F.col("row").between(start, start + 79)))
                want[step, k] = want.get((step, k), 0.0) + P.BicEvaluator("y", len(NAMES))._evaluate(held) / 2
    rows.unpersist()
    assert (best["params"]["stepSize"], best["params"]["maxIter"]) == max(want, key=want.get)
    assert best["score"] == pytest.approx(max(want.values()))
