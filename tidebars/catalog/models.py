"""Regression, selection and time-series models."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidebars.catalog.common import FINANCIAL, NUM, across_chunks, across_chunks_sql, bars, financial, r, rounded, series, table
from tidebars.functions.schemas import CYCLICAL_COLUMNS
from tidebars.operators.indicators import TECHNICAL_COLUMNS
from tidebars.operators import features as X
from tidebars.operators import moments as Z
from tidebars.operators.monitor import rmse
from tidebars.plans import autoregression as A
from tidebars.plans import models as P
from tidebars.plans.history import feature_table
from tidebars.session import shared_dir, stage


FEATURES = ["open", "hist_close", "tick_vol", *TECHNICAL_COLUMNS, *CYCLICAL_COLUMNS]


def _features(spark, sf_dir):
    """Model inputs, complete rows in time order with ``row``."""
    wide = feature_table(bars(spark, sf_dir))
    complete = stage(wide.select("symbol", "date_time", "close", *FEATURES).na.drop())
    n = complete.count()
    return X.time_split(X.with_row(complete), n), X.split_sizes(n)[0]


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_extendedprice", "l_quantity", "l_discount")


def _coefficients(model, features):
    """Slopes and intercept in data units from a scaled linear pipeline."""
    scaler, linear = model.stages[1], model.stages[-1]
    slopes = [w / s for w, s in zip(linear.coefficients.toArray().tolist(), scaler.std.toArray().tolist())]
    start = linear.intercept - sum(b * m for b, m in zip(slopes, scaler.mean.toArray().tolist()))
    return start, dict(zip(features, slopes))


def _line(spark, start, slopes):
    return spark.createDataFrame([("const", start), *slopes.items()], "feature string, coef double")


def _ols(features):
    def run(spark, sf_dir):
        model = P.linear_pipeline(features, "l_extendedprice").fit(_lines(spark, sf_dir))
        return rounded(_line(spark, *_coefficients(model, features)), 4)

    return run


def _ols_moments(spark, sf_dir):
    """The same regression from cross products."""
    features = ["l_quantity", "l_discount"]
    stats = Z.moments(_lines(spark, sf_dir).withColumn("block", F.lit(0)), [*features, "l_extendedprice"], "block")
    fit = P._in_data_units(Z.solve_linear(stats.blocks[0], [1, 2]), stats, features)
    return rounded(_line(spark, fit["intercept"], fit["coefficients"]), 4)


def _ridge(spark, sf_dir):
    """One scaled predictor, penalty 1000."""
    lines = _lines(spark, sf_dir)
    n, sd = lines.agg(F.count("l_extendedprice"), F.stddev_pop("l_extendedprice")).first()
    model = P.ridge_pipeline(["l_quantity"], "l_extendedprice", 1000.0, n, sd).fit(lines)
    return rounded(_line(spark, *_coefficients(model, ["l_quantity"])), 3)


def _lasso(spark, sf_dir):
    """One scaled predictor, penalty 100."""
    model = P.lasso_pipeline(["l_quantity"], "l_extendedprice", 100.0).fit(_lines(spark, sf_dir))
    return rounded(_line(spark, *_coefficients(model, ["l_quantity"])), 3)


def _grid(kinds):
    def run(spark, sf_dir):
        df, n = _features(spark, sf_dir)
        train = df.filter(F.col("slice") == "train")
        best = P.linear_grid_search(train, FEATURES, "close", kinds, n)
        rows = [(k, str(m["params"]), m["score"]) for k, m in best.items()]
        held = df.filter(F.col("slice") == "val")
        scores = held.agg(*[
            F.sqrt(F.avg((F.col("close") - P.linear_prediction(m)) ** 2)).alias(k) for k, m in best.items()
        ]).unpivot([], list(best), "kind", "val_rmse")
        return spark.createDataFrame(rows, "kind string, params string, score double").join(scores, "kind")

    return run


def _tree(kind, make, grid, splits):
    def run(spark, sf_dir):
        df, n = _features(spark, sf_dir)
        if kind == "boost":  # numbered and shuffled once, not for every read; a file has more than a few rows
            df = stage(df)
        train = df.filter(F.col("slice") == "train")
        best = P.prefix_grid_search(X.train_subset(train, n), FEATURES, "close", kind, grid, X.cut_at(n, 0.1), splits)
        model = make(FEATURES, "close", **best["params"]).fit(train)
        return P.evaluate_slices(model, df, "close").withColumn("params", F.lit(str(best["params"])))

    return run


def _pca(spark, sf_dir):
    df, _ = _features(spark, sf_dir)
    model = P.pca_pipeline(FEATURES, "close", 30).fit(df.filter(F.col("slice") == "train"))
    return P.evaluate_slices(model, df, "close")


def _drop_feature(spark, sf_dir):
    df, _ = _features(spark, sf_dir)
    features = [f for f in FEATURES if f != "hist_close"]
    model = P.linear_pipeline(features, "close").fit(df.filter(F.col("slice") == "train"))
    return P.evaluate_slices(model, df, "close")


def _pvalues(spark, sf_dir):
    return P.ols_summary(_lines(spark, sf_dir), ["l_quantity", "l_discount"], "l_extendedprice")


def _ols_summary(spark, sf_dir):
    summary = P.ols_summary(_lines(spark, sf_dir), ["l_quantity"], "l_extendedprice")
    return rounded(summary.drop("p"), 4)


def _pvalue_select(spark, sf_dir):
    """Keep the significant inputs, refit, save, load, score the held-out slices."""
    df, _ = _features(spark, sf_dir)
    train = df.filter(F.col("slice") == "train")
    kept = P.pvalue_select(train, FEATURES, "close") or FEATURES
    path = f"{shared_dir(spark)}/model-{uuid.uuid4().hex}"
    P.save_model(P.linear_pipeline(kept, "close").fit(train), path)
    return P.evaluate_slices(P.load_model(path), df, "close").withColumn("kept", F.lit(",".join(kept)))


def _predict(spark, sf_dir):
    """Scored rows keep their keys: RMSE by symbol of a one-input model."""
    s = series(spark, sf_dir)
    rows = s.add(prev=s.lag("close")).result("close", "prev").na.drop()
    model = P.linear_pipeline(["prev"], "close").fit(rows)
    return rounded(rmse(P.predict(model, rows), "close", "prediction", "symbol"))


def _split_rows(spark, sf_dir):
    """Bars with the close before, in time order, by slice."""
    rows = stage(financial(spark, sf_dir).filter(F.col("pos") > 0).select("symbol", "date_time", "close", "hist_close", "open", "tick_vol"))
    return X.time_split(X.with_row(rows), rows.count())


def _saved_slices(spark, sf_dir):
    """A model fitted on the training slice, saved, loaded, and scored on the held-out slices."""
    df = _split_rows(spark, sf_dir)
    path = f"{shared_dir(spark)}/model-{uuid.uuid4().hex}"
    P.save_model(P.linear_pipeline(["hist_close"], "close").fit(df.filter(F.col("slice") == "train")), path)
    return rounded(P.evaluate_slices(P.load_model(path), df, "close"))


def _dropped_slices(spark, sf_dir):
    """The same of a model of three features, one of them dropped."""
    df = _split_rows(spark, sf_dir)
    features = [f for f in ["hist_close", "open", "tick_vol"] if f != "open"]
    return rounded(P.evaluate_slices(P.linear_pipeline(features, "close").fit(df.filter(F.col("slice") == "train")), df, "close"))


def _significant(spark, sf_dir):
    """The features whose p-value is under 0.05: the price's ten thousands are, the order key has no part in it."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_extendedprice", F.floor(F.col("l_extendedprice") / 10_000).alias("thousands"), (F.col("l_orderkey") % 7).alias("chance"))
    kept = P.pvalue_select(lines, ["thousands", "chance"], "l_extendedprice")
    return spark.createDataFrame([(f,) for f in kept], "feature string")


def _rfe(spark, sf_dir):
    df, _ = _features(spark, sf_dir)
    return P.rfe(df.filter(F.col("slice") == "train"), FEATURES, "close", 16)


def _ar(spark, sf_dir):
    return A.ar_grid(series(spark, sf_dir)).select("symbol", "p", "d", "q", "n", "bic")


def _ar_orders(spark, sf_dir):
    """The search over orders that SQL can express."""
    return rounded(A.ar_grid(series(spark, sf_dir), p_values=(0, 1), q_values=(0,)).select("symbol", "p", "d", "n", "bic"), 4)


def _ar_forecast(spark, sf_dir):
    """The chosen order of all 108, forecast over the validation part."""
    return A.forecast_error(A.ar_forecast(series(spark, sf_dir)))


def _ar1_forecast(spark, sf_dir):
    """One autoregressive term: every forecast in closed form."""
    done = A.ar_forecast(series(spark, sf_dir), p_values=(1,), d_values=(0,), q_values=(0,))
    return rounded(done.select("symbol", "date_time", "value", "forecast"))


def _ar1_error(spark, sf_dir):
    done = A.ar_forecast(series(spark, sf_dir), p_values=(1,), d_values=(0,), q_values=(0,))
    return rounded(A.forecast_error(done).select("symbol", "n", "rmse"))


QUERIES = {
    "ols_1": _ols(["l_quantity"]),
    "ols_2": _ols(["l_quantity", "l_discount"]),
    "ols_moments": _ols_moments,
    "ols_summary": _ols_summary,
    "ols_pvalues": _pvalues,
    "ridge": _ridge,
    "lasso": _lasso,
    "predict": _predict,
    "grid_bic": _grid(["linear", "lasso", "ridge"]),
    "pca_grid": _grid(["pca_linear", "pca_lasso", "pca_ridge"]),
    "rfe_grid": _grid(["rfe"]),
    "pca_reg": _pca,
    "linreg_drop_feature": _drop_feature,
    "pvalue_select": _pvalue_select,
    "rfe": _rfe,
    "saved_slices": _saved_slices,
    "dropped_slices": _dropped_slices,
    "significant": _significant,
    # small parts of the full grids: README has the measured seconds of the rest
    "forest": _tree("forest", P.forest_pipeline, {"numTrees": [50, 100], "maxDepth": [10], "minInstancesPerNode": [1]}, 3),
    "gbt": _tree("boost", P.boost_pipeline, {"maxIter": [5, 10, 20], "maxDepth": [3], "stepSize": [0.1, 0.3]}, 5),
    "ar_grid": _ar,
    "ar_orders": _ar_orders,
    "ar_orders_long": across_chunks(_ar_orders),
    "ar_forecast": _ar_forecast,
    "ar1_forecast": _ar1_forecast,
    "ar1_forecast_long": across_chunks(_ar1_forecast),
    "ar1_error": _ar1_error,
}

_LINE = "SELECT 'const' AS feature, {c} AS coef FROM {t} UNION ALL SELECT 'l_quantity', {b} FROM {t}"
_ONE = """WITH m AS (SELECT count(*) AS n, avg(l_quantity) AS mx, stddev_samp(l_quantity) AS sx, avg(l_extendedprice) AS my,
  covar_pop(l_quantity, l_extendedprice) AS cxy, var_pop(l_quantity) AS vx FROM lineitem), """
ORACLES = {
    "ols_1": _LINE.format(
        c=r("regr_intercept(l_extendedprice, l_quantity)", 4), b=r("regr_slope(l_extendedprice, l_quantity)", 4), t="lineitem"),
    "ols_2": f"""WITH m AS (SELECT covar_pop(l_quantity, l_extendedprice) AS a, covar_pop(l_discount, l_extendedprice) AS b,
          var_pop(l_quantity) AS p, var_pop(l_discount) AS q, covar_pop(l_quantity, l_discount) AS c,
          avg(l_quantity) AS mx, avg(l_discount) AS mz, avg(l_extendedprice) AS my FROM lineitem),
        w AS (SELECT *, (a * q - b * c) / (p * q - c * c) AS w1, (b * p - a * c) / (p * q - c * c) AS w2 FROM m)
        SELECT 'const' AS feature, {r('my - w1 * mx - w2 * mz', 4)} AS coef FROM w
        UNION ALL SELECT 'l_quantity', {r('w1', 4)} FROM w UNION ALL SELECT 'l_discount', {r('w2', 4)} FROM w""",
    # standard error of a simple regression in closed form
    "ols_summary": f"""WITH m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a,
          regr_sxx(l_extendedprice, l_quantity) AS sxx, regr_syy(l_extendedprice, l_quantity) AS syy,
          regr_sxy(l_extendedprice, l_quantity) AS sxy, count(*) AS n, avg(l_quantity) AS mx FROM lineitem),
        s AS (SELECT *, sqrt((syy - sxy * sxy / sxx) / (n - 2)) AS s FROM m),
        e AS (SELECT *, s / sqrt(sxx) AS se_b, s * sqrt(1.0 / n + mx * mx / sxx) AS se_a FROM s)
        SELECT 'l_quantity' AS feature, {r('b', 4)} AS coef, {r('se_b', 4)} AS std_err, {r('b / se_b', 4)} AS t FROM e
        UNION ALL SELECT 'const', {r('a', 4)}, {r('se_a', 4)}, {r('a / se_a', 4)} FROM e""",
    # scaled predictor z = (x - mx) / sx
    "ridge": _ONE + "w AS (SELECT *, (n * cxy / sx) / (n * vx / (sx * sx) + 1000.0) / sx AS b FROM m) " + _LINE.format(
        c=r("my - b * mx", 3), b=r("b", 3), t="w"),
    "lasso": _ONE + "w AS (SELECT *, sign(cxy) * greatest(abs(cxy) / sx - 100.0, 0) / (vx / (sx * sx)) / sx AS b FROM m) " + _LINE.format(
        c=r("my - b * mx", 3), b=r("b", 3), t="w"),
    "predict": f"""WITH {FINANCIAL}, t AS (SELECT symbol, close, c1 FROM num WHERE c1 IS NOT NULL),
        f AS (SELECT regr_slope(close, c1) AS b, regr_intercept(close, c1) AS a FROM t)
        SELECT symbol, {r('sqrt(avg(power(close - a - b * c1, 2)))')} AS rmse FROM t, f GROUP BY symbol""",
}
ORACLES["ols_moments"] = ORACLES["ols_2"]

_AR_ORDERS = f"""WITH {NUM}, w AS (
      SELECT symbol, pos, 0 AS d, close AS y FROM num UNION ALL SELECT symbol, pos, 1, close - c1 FROM num
      UNION ALL SELECT symbol, pos, 2, close - 2 * c1 + lag(close, 2) OVER (PARTITION BY symbol ORDER BY pos) FROM num),
    l AS (SELECT symbol, d, y, lag(y) OVER (PARTITION BY symbol, d ORDER BY pos) AS x FROM w),
    m AS (SELECT symbol, d, count(*) AS n, var_pop(y) AS vy, var_pop(x) AS vx, covar_pop(x, y) AS c
      FROM l WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY ALL),
    s AS (SELECT symbol, p, d, n, n * ln(CASE WHEN p = 0 THEN vy ELSE vy - c * c / vx END) + (p + 1) * ln(n) AS bic
      FROM m, (VALUES (0), (1)) AS t(p) WHERE n > p + 1)
    SELECT symbol, p, d, n, {r('bic', 4)} AS bic FROM s QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY bic, p, d) = 1"""
_AR1 = f"""WITH {NUM}, sized AS (SELECT *, count(*) OVER (PARTITION BY symbol) AS rows FROM num),
    parts AS (SELECT *, floor(rows * 0.7::DOUBLE) AS cut, floor(rows * 0.85::DOUBLE) AS until FROM sized),
    fit AS (SELECT symbol, regr_slope(close, c1) AS b, regr_intercept(close, c1) AS a, arg_max(close, pos) AS y
      FROM parts WHERE pos < cut GROUP BY symbol),
    f AS (SELECT p.symbol, date_time, close AS value, a * (1 - power(b, pos - cut + 1)) / (1 - b) + power(b, pos - cut + 1) * y AS forecast
      FROM parts p JOIN fit ON fit.symbol = p.symbol WHERE pos >= cut AND pos < until)"""
_AR1_ROWS = f"{_AR1} SELECT symbol, date_time, {r('value')} AS value, {r('forecast')} AS forecast FROM f"
ORACLES |= {
    "ar_orders": _AR_ORDERS,
    "ar_orders_long": across_chunks_sql(_AR_ORDERS),
    "ar1_forecast": _AR1_ROWS,
    "ar1_forecast_long": across_chunks_sql(_AR1_ROWS),
    "ar1_error": f"{_AR1} SELECT symbol, count(*) AS n, {r('sqrt(avg((value - forecast) * (value - forecast)))')} AS rmse FROM f GROUP BY symbol",
}

_SPLIT = f"""WITH {FINANCIAL}, z AS (SELECT *, row_number() OVER (ORDER BY date_time, symbol) - 1 AS position, count(*) OVER () AS n FROM financial WHERE pos > 0),
    split AS (SELECT *, CASE WHEN position < n - ceil(n * 0.05::DOUBLE) - ceil((n - ceil(n * 0.05::DOUBLE)) * 0.055::DOUBLE) THEN 'train'
      WHEN position < n - ceil(n * 0.05::DOUBLE) THEN 'val' ELSE 'test' END AS slice FROM z)"""
_TWO = """covar_pop(x, y) AS a, covar_pop(z, y) AS b, var_pop(x) AS p, var_pop(z) AS q, covar_pop(x, z) AS c, avg(x) AS mx, avg(z) AS mz, avg(y) AS my"""
_HELD = "SELECT slice, {x} AS rmse FROM split, f WHERE slice <> 'train' GROUP BY slice"
ORACLES |= {
    "saved_slices": f"""{_SPLIT}, f AS (SELECT regr_slope(close, hist_close) AS b, regr_intercept(close, hist_close) AS a FROM split WHERE slice = 'train')
        {_HELD.format(x=r('sqrt(avg(power(close - a - b * hist_close, 2)))'))}""",
    "dropped_slices": f"""{_SPLIT}, m AS (SELECT {_TWO} FROM (SELECT hist_close AS x, tick_vol AS z, close AS y FROM split WHERE slice = 'train')),
        f AS (SELECT (a * q - b * c) / (p * q - c * c) AS w1, (b * p - a * c) / (p * q - c * c) AS w2, mx, mz, my FROM m)
        {_HELD.format(x=r('sqrt(avg(power(close - my - w1 * (hist_close - mx) - w2 * (tick_vol - mz), 2)))'))}""",
    # t beyond 1.96 is p under 0.05 on so many rows
    "significant": f"""WITH d AS (SELECT floor(l_extendedprice / 10000)::DOUBLE AS x, (l_orderkey % 7)::DOUBLE AS z, l_extendedprice::DOUBLE AS y FROM lineitem),
        m AS (SELECT {_TWO}, var_pop(y) AS vy, count(*) AS n FROM d),
        w AS (SELECT *, (a * q - b * c) / (p * q - c * c) AS w1, (b * p - a * c) / (p * q - c * c) AS w2 FROM m),
        s AS (SELECT *, (vy - w1 * a - w2 * b) * n / (n - 3) AS s2 FROM w)
        SELECT 'thousands' AS feature FROM s WHERE abs(w1) / sqrt(s2 * q / (n * (p * q - c * c))) > 1.96
        UNION ALL SELECT 'chance' FROM s WHERE abs(w2) / sqrt(s2 * p / (n * (p * q - c * c))) > 1.96""",
}
