"""Model selection: parameter grids over time-ordered folds, scored by BIC."""

from __future__ import annotations

import itertools
import math
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidebars.operators import moments as M
from tidebars.operators.features import ROW, fold_starts, scale_moments, with_fold
from tidebars.operators.monitor import bic, rmse, squared_error
from tidebars.session import only_row, shared_dir

# Parameter grids.
ALPHAS = np.logspace(-4, 4, 50).tolist()
FOREST_GRID = {"numTrees": [100, 200, 500], "maxDepth": [10, 20, 30], "minInstancesPerNode": [1, 2, 4]}
BOOST_GRID = {"maxIter": [100, 200, 500], "maxDepth": [3, 5, 7], "stepSize": [0.01, 0.1, 0.3], "subsamplingRate": [0.7, 0.8, 1.0]}
BOOST_LEAF_GRID = {"maxIter": [100, 200, 500], "stepSize": [0.01, 0.1, 0.3], "maxDepth": [5, 10], "minInstancesPerNode": [10, 20, 30]}


# --- linear family: one pass over the data, then small solves -----------------


def _grid(kind: str, n_features: int, zero: float, unit: float = 1.0) -> list[tuple[dict, Callable]]:
    """Parameter sets of a model kind, each with its solver.  ``zero`` is the level
    of models without an intercept, ``unit`` the target's unit: a lasso penalty is
    in the units of the data."""
    levels = ((True, None), (False, zero))
    if kind == "linear":
        return [({"intercept": i}, lambda g, f, v=v: M.solve_linear(g, f, v)) for i, v in levels]
    if kind == "lasso":
        path = M.OncePerBlock(lambda g, f: M.solve_lassos(g, f, [a / unit for a in ALPHAS]))
        return [({"alpha": a}, lambda g, f, i=i: path(g, f)[i]) for i, a in enumerate(ALPHAS)]
    if kind == "ridge":
        return [({"alpha": a}, lambda g, f, a=a: M.solve_ridge(g, f, a)) for a in ALPHAS]
    axes = M.OncePerBlock(M._principal)
    if kind == "pca_linear":
        return [
            ({"components": k, "intercept": i}, lambda g, f, k=k, v=v: M.solve_pca(g, f, k, "linear", 0.0, v, axes))
            for k in range(1, min(34, n_features) + 1) for i, v in levels
        ]
    if kind in ("pca_lasso", "pca_ridge"):
        solver = kind.removeprefix("pca_")
        return [
            ({"components": k, "alpha": a}, lambda g, f, k=k, a=a: M.solve_pca(g, f, k, solver, a / (unit if solver == "lasso" else 1.0), None, axes))
            for k in range(1, min(30, n_features) + 1) for a in ALPHAS
        ]
    if kind == "rfe":
        sizes = [k for k in range(16, 21) if k <= n_features] or [max(1, n_features // 2)]
        left = {k: M.OncePerBlock(lambda g, f, k=k: M.eliminate(g, f, k)[0]) for k in sizes}
        return [
            ({"keep": k, "intercept": i}, lambda g, f, k=k, v=v: M.solve_linear(g, left[k](g, f), v))
            for k in sizes for i, v in levels
        ]
    raise ValueError(f"unknown model kind {kind!r}")


def linear_grid_search(
    df: DataFrame, features: list[str], label: str, kinds: list[str], n: int, splits: int = 5, parity: bool = False
) -> dict[str, dict]:
    """Best parameters per model kind by mean BIC over expanding folds.

    ``df`` has the position column ``row`` and ``n`` rows.  One pass makes the
    cross products of every fold block; training sets are their running sums.
    ``parity`` counts all input columns in the BIC even where fewer are used.
    """
    stats = M.moments(with_fold(df, n, splits), [*features, label], "block")
    index = list(range(1, len(features) + 1))
    order = range(splits + 1)
    zero = np.zeros((len(features) + 2,) * 2)
    blocks = [stats.blocks.get(b, zero) for b in order]
    train = np.cumsum(blocks, axis=0)
    out = {}
    for kind in kinds:
        best = None
        for params, solve in _grid(kind, len(features), stats.target_zero, stats.scale[-1]):
            scores = []
            for fold in range(1, splits + 1):
                fit = solve(train[fold - 1], index)
                used = len(features) if parity else fit.n_used
                scores.append(M.bic_score(blocks[fold], fit, used, stats.scale[-1]))
            score = float(np.mean(scores))
            if best is None or score > best["score"]:
                best = {"params": params, "score": score, "solve": solve}
        fit = best.pop("solve")(train[-1], index)
        out[kind] = {**best, **_in_data_units(fit, stats, features)}
    return out


def _in_data_units(fit: M.Fit, stats: M.Moments, features: list[str]) -> dict:
    y_shift, y_scale = stats.shift[-1], stats.scale[-1]
    slopes = fit.weights[1:] * y_scale / stats.scale[:-1]
    start = y_shift + fit.weights[0] * y_scale - float(slopes @ stats.shift[:-1])
    return {"intercept": float(start), "coefficients": dict(zip(features, map(float, slopes)))}


def linear_prediction(model: dict):
    """The prediction of a fitted linear model as one column expression."""
    out = F.lit(model["intercept"])
    for name, weight in model["coefficients"].items():
        if weight:
            out = out + F.col(name) * F.lit(weight)
    return out


def rfe(df: DataFrame, features: list[str], label: str, keep: int) -> DataFrame:
    """Backward elimination: rank of every feature and whether it stays."""
    stats = M.moments(df.withColumn("block", F.lit(0)), [*features, label], "block")
    left, ranks = M.eliminate(stats.blocks[0], list(range(1, len(features) + 1)), keep)
    rows = [(name, ranks[i], i in left) for i, name in enumerate(features, 1)]
    return df.sparkSession.createDataFrame(rows, "feature string, rank int, kept boolean")


# --- Spark ML pipelines --------------------------------------------------------


def assemble(features: list[str], scale: bool = True) -> list:
    """Stages from columns to a scaled vector; fitted together with the model, so
    that scoring uses the scale of the training slice."""
    if not scale:
        return [VectorAssembler(inputCols=features, outputCol="features")]
    return [
        VectorAssembler(inputCols=features, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True),
    ]


def linear_pipeline(features: list[str], label: str, intercept: bool = True) -> Pipeline:
    model = LinearRegression(labelCol=label, fitIntercept=intercept, solver="normal", standardization=False)
    return Pipeline(stages=[*assemble(features), model])


def lasso_pipeline(features: list[str], label: str, alpha: float) -> Pipeline:
    """``regParam`` is the penalty weight itself, the features being scaled."""
    model = LinearRegression(labelCol=label, elasticNetParam=1.0, regParam=alpha, standardization=False, maxIter=500, tol=1e-9)
    return Pipeline(stages=[*assemble(features), model])


def ridge_pipeline(features: list[str], label: str, alpha: float, n: int, label_std: float) -> Pipeline:
    """|y - Xw|^2 + alpha |w|^2; the normal solver divides its penalty by the
    population deviation of the label and by the row count."""
    model = LinearRegression(
        labelCol=label, elasticNetParam=0.0, regParam=alpha * label_std / n, solver="normal", standardization=False
    )
    return Pipeline(stages=[*assemble(features), model])


def pca_pipeline(features: list[str], label: str, components: int) -> Pipeline:
    scaled = assemble(features)
    scaled[-1].setOutputCol("scaled")
    pca = PCA(k=components, inputCol="scaled", outputCol="features")
    return Pipeline(stages=[*scaled, pca, LinearRegression(labelCol=label, solver="normal", standardization=False)])


def forest_pipeline(features: list[str], label: str, **params) -> Pipeline:
    return Pipeline(stages=[*assemble(features, False), RandomForestRegressor(labelCol=label, seed=42, **params)])


def boost_pipeline(features: list[str], label: str, **params) -> Pipeline:
    return Pipeline(stages=[*assemble(features, False), GBTRegressor(labelCol=label, seed=42, **params)])


class BicEvaluator(Evaluator):
    """Negated BIC of a scored frame."""

    def __init__(self, label: str, n_columns: int) -> None:
        super().__init__()
        self.label, self.n_columns = label, n_columns

    def _evaluate(self, dataset: DataFrame) -> float:
        return -only_row(bic(dataset, self.label, "prediction", self.n_columns))[0]

    def isLargerBetter(self) -> bool:
        return True


def tree_grid_search(
    df: DataFrame, pipeline: Pipeline, grid: dict[str, list], label: str, n_columns: int, n: int,
    splits: int = 3, threads: int = 4,
) -> dict:
    """Best parameters of an ML pipeline over expanding folds (``df`` has ``row``).

    All parameter sets of a fold are fitted from a few driver threads on the
    cached training rows.
    """
    estimator = pipeline.getStages()[-1]
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    maps = builder.build()
    evaluator = BicEvaluator(label, n_columns)
    totals = [0.0] * len(maps)
    size = n // (splits + 1)
    for start in fold_starts(n, splits):
        train = df.filter(F.col(ROW) < start).persist()
        test = df.filter(F.col(ROW).between(start, start + size - 1)).persist()
        try:
            with ThreadPoolExecutor(threads) as pool:
                models = pipeline.fitMultiple(train, maps)
                results = pool.map(lambda _: _score_next(models, test, evaluator), maps)
                for i, score in results:
                    totals[i] += score / splits
        finally:
            train.unpersist()
            test.unpersist()
    best = max(range(len(maps)), key=totals.__getitem__)
    return {"params": {p.name: v for p, v in maps[best].items()}, "score": totals[best]}


def _score_next(models, test: DataFrame, evaluator: BicEvaluator) -> tuple[int, float]:
    index, model = next(models)
    return index, evaluator.evaluate(model.transform(test))


ROWS_A_TASK = 5_000  # of boosting
PREFIX = {"forest": "numTrees", "boost": "maxIter"}  # grown tree by tree: the first k trees of a larger model are a model of k trees


def prefix_grid_search(
    df: DataFrame, features: list[str], label: str, kind: str, grid: dict[str, list], n: int, splits: int = 5, threads: int = 4,
) -> dict:
    """Best parameters of a forest or a boosted model over expanding folds (``df`` has ``row``), by mean BIC.

    Only the largest number of trees is fitted; smaller numbers are scored from its first trees.  A grid of three numbers of trees
    takes a third of the fits.  The fits share the assembled and persisted rows; those of all folds are started from a few driver threads.

    Boosting has a job for every level of every round, so its rows are dealt to as many partitions as their number asks for: a job
    then takes the time of its rows, not of tasks without any.  A forest has few jobs, and its draws hang on its partitions, which stay.
    """
    sizes = sorted(grid[PREFIX[kind]])
    names = [k for k in grid if k != PREFIX[kind]]
    points = [dict(zip(names, values)) for values in itertools.product(*[grid[k] for k in names])]
    estimator = RandomForestRegressor if kind == "forest" else GBTRegressor
    rows = VectorAssembler(inputCols=features, outputCol="features").transform(df).select(ROW, label, "features")
    if kind == "boost":
        rows = rows.repartition(max(1, math.ceil(n / ROWS_A_TASK)), ROW)
    rows = rows.persist()
    part = n // (splits + 1)

    def fitted(fold: tuple[int, dict]) -> list[float]:
        start, params = fold
        train, test = rows.filter(F.col(ROW) < start), rows.filter(F.col(ROW).between(start, start + part - 1))
        model = estimator(labelCol=label, featuresCol="features", seed=42, **{PREFIX[kind]: sizes[-1]}, **params).fit(train)
        n_test, errors = test.count(), _prefix_errors(model, test, label, sizes)
        return [-(n_test * math.log(max(mse, 1e-300)) + (len(features) + 1) * math.log(n_test)) for mse in errors]

    totals = {(i, k): 0.0 for i in range(len(points)) for k in sizes}
    try:
        folds = [(start, i) for start in fold_starts(n, splits) for i in range(len(points))]
        with ThreadPoolExecutor(threads) as pool:
            for (_, i), scores in zip(folds, pool.map(fitted, [(start, points[i]) for start, i in folds])):
                for k, score in zip(sizes, scores):
                    totals[i, k] += score / splits
    finally:
        rows.unpersist()
    i, k = max(totals, key=totals.__getitem__)
    return {"params": {**points[i], PREFIX[kind]: k}, "score": totals[i, k]}


def _prefix_errors(model, test: DataFrame, label: str, sizes: list[int]) -> list[float]:
    """Mean squared error of the first ``sizes`` trees of a model."""
    if isinstance(model, GBTRegressionModel):
        errors = model.evaluateEachIteration(test, "squared")
        return [errors[min(k, len(errors)) - 1] for k in sizes]
    values = leaf_values(test.sparkSession, model)
    leaves = model.setLeafCol("_leaf").transform(test).select(F.col(label).cast("double").alias("y"), vector_to_array("_leaf").alias("leaf"))

    def errors_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, n = np.zeros(len(sizes)), 0
        for batch in batches:
            leaf = np.stack(batch["leaf"].to_numpy()).astype(int)
            running = np.cumsum([values[t][leaf[:, t]] for t in range(leaf.shape[1])], axis=0)
            sums += [float((((running[k - 1] / k) - batch["y"].to_numpy()) ** 2).sum()) for k in sizes]
            n += len(batch)
        yield pd.DataFrame({"k": range(len(sizes)), "part": sums, "n": n})

    parts = leaves.mapInPandas(errors_of, "k int, part double, n long")
    return [r[0] for r in parts.groupBy("k").agg((F.sum("part") / F.sum("n")).alias("mse")).orderBy("k").select("mse").collect()]


def leaf_values(spark: SparkSession, model) -> list[np.ndarray]:
    """The prediction of every leaf of a forest, tree by tree, in the order of the leaf indices.

    They come from the model's own saved table of nodes; like the model itself they are kept on the driver.
    """
    path = f"{shared_dir(spark)}/forest-{uuid.uuid4().hex}"
    save_model(model, path)
    nodes = spark.read.parquet(f"{path}/data")
    leaves = nodes.filter("nodeData.leftChild < 0").groupBy("treeID").agg(
        F.sort_array(F.collect_list(F.struct("nodeData.id", "nodeData.prediction"))).alias("leaves"))
    found = {r["treeID"]: np.array([leaf["prediction"] for leaf in r["leaves"]]) for r in leaves.collect()}
    return [found[t] for t in range(len(found))]


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Scored rows with all their columns, so nothing is matched by position."""
    return model.transform(df).drop("raw_features", "scaled", "features")


def evaluate_slices(model: PipelineModel, df: DataFrame, label: str) -> DataFrame:
    """RMSE of the validation and the test slice."""
    held_out = df.filter(F.col("slice").isin("val", "test"))
    return rmse(predict(model, held_out), label, "prediction", "slice")


# --- least squares with statistics ---------------------------------------------


def ols_summary(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Coefficient, standard error, t and p of every feature and the constant.

    Solved from a triangular factor that the tasks make together, so near-collinear features keep their digits.  A feature that is constant or
    given exactly by those before it is left out of the fit and has NULL in all columns.
    """
    spark = df.sparkSession
    schema = "feature string, coef double, std_err double, t double, p double"
    complete = df.select(*[F.col(c).cast("double") for c in dict.fromkeys([*features, label])]).na.drop()
    known = scale_moments(complete, [*features, label])
    n = complete.count()
    if not n:
        return spark.createDataFrame([(m, None, None, None, None) for m in [*features, "const"]], schema)
    shift = np.array([known[c][0] or 0.0 for c in (*features, label)])
    scale = np.array([known[c][1] or 1.0 for c in (*features, label)])
    r = M.triangle(complete, [*features, label], shift, scale)
    kept = M.independent(r, list(range(1, len(features) + 1)))
    used = [0, *kept]
    small = np.linalg.qr(r[:, [*used, len(features) + 1]], mode="r")
    top, right = small[:len(used), :len(used)], small[:len(used), -1]
    weights = np.linalg.solve(top, right)
    rest = float(small[len(used), -1] ** 2) if len(small) > len(used) else 0.0
    free = n - len(used)
    spread = rest / free if free > 0 else math.nan
    # to data units: slopes by the scales, the constant by all shifts
    unit = scale[-1]
    turn = np.diag([unit, *(unit / scale[k - 1] for k in kept)])
    turn[0, 1:] = [-unit * shift[k - 1] / scale[k - 1] for k in kept]
    coef = turn @ weights
    coef[0] += shift[-1]
    errors = np.linalg.norm(turn @ np.linalg.inv(top), axis=1) * math.sqrt(spread) if spread == spread else np.full(len(used), math.nan)
    student = spark._jvm.org.apache.commons.math3.distribution.TDistribution(float(free)) if free > 0 else None
    found = {}
    for name, c, e in zip(["const", *(features[k - 1] for k in kept)], coef.tolist(), errors.tolist()):
        t = c / e if e else math.nan
        p = 2.0 * student.cumulativeProbability(-abs(t)) if student is not None and not math.isnan(t) else math.nan
        found[name] = (c, e, t, p)
    return spark.createDataFrame([(m, *found.get(m, (None,) * 4)) for m in [*features, "const"]], schema)


def pvalue_select(df: DataFrame, features: list[str], label: str, below: float = 0.05) -> list[str]:
    """Features whose p-value is below the limit, the constant not counted."""
    kept = ols_summary(df, features, label).filter((F.col("p") < below) & (F.col("feature") != "const"))
    names = {r[0] for r in kept.select("feature").collect()}
    return [f for f in features if f in names]


# --- baselines and time-series models ------------------------------------------


def mean_forecast(df: DataFrame, n_rows: DataFrame, value: str = "close", share: float = 0.85) -> DataFrame:
    """Forecast of the test part by the mean of the training part, per symbol.

    ``df`` has ``position``; ``n_rows`` has one row per symbol with its count.
    The grouping is by symbol and side only, so both passes combine in the map tasks.
    """
    sized = df.join(n_rows, "symbol").withColumn("_test", F.col("position") >= F.floor(F.col("n") * F.lit(share)))
    means = sized.filter(~F.col("_test")).groupBy("symbol").agg(F.avg(value).alias("forecast"))
    test = sized.filter("_test").join(means, "symbol")
    return test.groupBy("symbol", "forecast").agg(
        F.count(value).alias("n_test"),
        F.avg(squared_error(value, "forecast")).alias("mse"),
        F.sqrt(F.avg(squared_error(value, "forecast"))).alias("rmse"),
    )


def model_ranking(scores: DataFrame) -> DataFrame:
    """Models by error, best first, with the inverse score used for the bars."""
    return scores.select(
        "model", "score", (F.lit(1.0) / F.col("score")).alias("inverse"),
        F.rank().over(Window.orderBy("score")).alias("place"),
    )


