"""Monitoring: error measures, population stability, density curves."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebars.functions.scalar import replace_zero
from tidebars.operators.profile import bin_of
from tidebars.operators.relational import pool
from tidebars.session import only_row, stage

PSI_LIMIT = 0.25  # fixed value: drift limit


def squared_error(actual: str, predicted: str) -> Column:
    return (F.col(actual) - F.col(predicted)) * (F.col(actual) - F.col(predicted))


def mse(df: DataFrame, actual: str, predicted: str, *by) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(squared_error(actual, predicted)).alias("mse"))


def rmse(df: DataFrame, actual: str, predicted: str, *by) -> DataFrame:
    return df.groupBy(*by).agg(F.sqrt(F.avg(squared_error(actual, predicted))).alias("rmse"))


def bic(df: DataFrame, actual: str, predicted: str, n_columns: int) -> DataFrame:
    """n ln(RSS/n) + k ln n with k = columns + 1."""
    n, rss = F.count(predicted).cast("double"), F.sum(squared_error(actual, predicted))
    return df.agg((n * F.ln(rss / n) + F.lit(float(n_columns + 1)) * F.ln(n)).alias("bic"))


def _doane(n: int, skew: float) -> int:
    if n <= 2:
        return 1
    sigma = math.sqrt(6.0 * (n - 2) / ((n + 1.0) * (n + 3.0)))
    return max(1, math.ceil(1.0 + math.log2(n) + math.log2(1.0 + abs(skew) / sigma)))


def psi(first: DataFrame, second: DataFrame, column: str, other: str | None = None, bins: int | None = None) -> DataFrame:
    """Population stability index of the second sample against the first.

    Common bins over both samples, their number given or by Doane's rule; empty
    shares count as 1e-6.  Only the bin counts are shuffled.
    """
    pooled = pool(first, second, column, other or column).filter(F.col("value").isNotNull())
    stats = only_row(
        pooled.agg(F.min("value").alias("low"), F.max("value").alias("high"),
                   F.count("value").alias("n"), F.skewness("value").alias("skew"))
    )
    spark = first.sparkSession
    if stats["low"] is None:
        return spark.createDataFrame([(None, None)], "bins int, psi double")
    if stats["low"] == stats["high"]:
        bins = bins or 1
    bins = bins or _doane(stats["n"], stats["skew"])
    counts = pooled.groupBy(bin_of(F.col("value"), stats["low"], stats["high"], bins).alias("bin")).agg(
        F.count_if(F.col("side") == 0).alias("n0"), F.count_if(F.col("side") == 1).alias("n1")
    )
    return _stability(spark.range(bins).select(F.col("id").cast("int").alias("bin")), counts, bins)


def _stability(grid: DataFrame, counts: DataFrame, bins: int) -> DataFrame:
    filled = grid.join(counts, "bin", "left").na.fill(0, ["n0", "n1"])
    shares = filled.agg(
        F.collect_list(F.struct("n0", "n1")).alias("_bins"),  # `bins` entries
        F.sum("n0").alias("_t0"), F.sum("n1").alias("_t1"),
    )

    def term(x: Column) -> Column:
        a = replace_zero(F.try_divide(x["n0"].cast("double"), F.col("_t0")))
        b = replace_zero(F.try_divide(x["n1"].cast("double"), F.col("_t1")))
        return (b - a) * F.ln(b / a)

    total = F.aggregate("_bins", F.lit(0.0), lambda acc, x: acc + term(x))
    return shares.select(F.lit(bins).alias("bins"), total.alias("psi"))


def psi_status(df: DataFrame, limit: float = PSI_LIMIT) -> DataFrame:
    return df.withColumn("status", F.when(F.col("psi") > limit, "red").otherwise("green"))


_REACH = 9.0


def _kernel_sums(grid: np.ndarray, widths: dict[int, float]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {side: np.zeros(len(grid)) for side in widths}
        for batch in batches:
            for side, width in widths.items():
                part = batch[batch["side"] == side]
                values, weights = part["value"].to_numpy(), part["n"].to_numpy(dtype=float)
                order = np.argsort(values)
                values, weights = values[order], weights[order]
                for at in range(0, len(values), 512):
                    own = values[at : at + 512]
                    # beyond _REACH widths the kernel is under half a unit in the last place of its top
                    near = slice(*np.searchsorted(grid, (own[0] - _REACH * width, own[-1] + _REACH * width)))
                    u = (grid[near, None] - own[None, :]) / width
                    sums[side][near] += np.exp(-0.5 * u * u) @ weights[at : at + 512]
        index = np.arange(len(grid))
        for side, total in sums.items():
            yield pd.DataFrame({"side": side, "point": index, "part": total})

    return run


NODES = 1 << 20  # of the fine grid, at most
PER_WIDTH = 64  # nodes a bandwidth, unless the grid is at its most


def _on_nodes(pooled: DataFrame, low: float, step: float) -> DataFrame:
    """``side, value, n``: values as weights of the four nodes around each, which keep its first three moments.

    Nothing is larger than the grid, however many rows and values there are: the sums are made in the map tasks.
    """
    place = (F.col("value") - F.lit(low)) / F.lit(step)
    rows = pooled.select("side", F.floor(place).alias("_node"), (place - F.floor(place)).alias("_f"))
    f = F.col("_f")
    weights = [-f * (f - 1) * (f - 2) / 6, (f + 1) * (f - 1) * (f - 2) / 2, -(f + 1) * f * (f - 2) / 2, (f + 1) * f * (f - 1) / 6]
    parts = F.explode(F.array(*[F.struct((F.col("_node") + (i - 1)).alias("node"), w.alias("n")) for i, w in enumerate(weights)]))
    sums = rows.select("side", parts.alias("_p")).groupBy("side", "_p.node").agg(F.sum("_p.n").alias("n"))
    return sums.select("side", (F.lit(low) + F.col("node") * F.lit(step)).alias("value"), "n")


def kde_grid(df: DataFrame, a: str, b: str, points: int = 1000, per_width: int = PER_WIDTH) -> DataFrame:
    """Gaussian density of two columns on one grid between their pooled ends.

    Bandwidth by Scott's rule.  Values are first dealt to a fine grid of ``per_width`` nodes a bandwidth, by weights that are exact for
    cubics: the density is off by less than ``0.1 / per_width ** 4`` of a single kernel's top, 6e-9 as it is.  On a range of over
    ``NODES / per_width`` bandwidths the nodes are ``NODES`` and farther apart.  Each task then sends one partial sum per grid point within reach of its
    nodes.  A side without values or without spread has no density (NULL); without any values there are no points.
    """
    pooled = pool(df, df, a, b).filter(F.col("value").isNotNull())
    rows = pooled.groupBy("side").agg(
        F.min("value").alias("low"), F.max("value").alias("high"),
        F.count("value").alias("n"), F.stddev("value").alias("s"),
    ).collect()
    names = {0: "density_a", 1: "density_b"}
    stats = {r["side"]: r for r in rows if r["s"]}
    if not stats:
        return df.sparkSession.createDataFrame([], "point int, x double, density_a double, density_b double")
    low, high = min(r["low"] for r in rows), max(r["high"] for r in rows)
    grid = low + (high - low) / (points - 1) * np.arange(points)
    widths = {side: r["n"] ** -0.2 * r["s"] for side, r in stats.items()}
    step = max(min(widths.values()) / per_width, (high - low) / NODES)
    parts = _on_nodes(pooled, float(low), float(step)).mapInPandas(_kernel_sums(grid, widths), "side int, point int, part double")
    sums = parts.groupBy("point").agg(
        *[
            (F.sum(F.when(F.col("side") == side, F.col("part"))) / F.lit(r["n"] * widths[side] * math.sqrt(2 * math.pi)))
            .alias(names[side])
            for side, r in stats.items()
        ],
        *[F.lit(None).cast("double").alias(names[side]) for side in names if side not in stats],
    )
    return sums.select("point", (F.lit(float(low)) + F.col("point") * ((high - low) / (points - 1))).alias("x"), *names.values())


def _slices(width: str, slide: str | None) -> tuple[str, Column]:
    """The length of the slices that make up all windows, and the starts of the windows that hold the slice ``_s`` (its start)."""
    wide, step = (int(pd.Timedelta(x).value // 1000) for x in (width, slide or width))
    piece = math.gcd(wide, step)
    at = F.unix_micros(F.col("_s").cast("timestamp"))
    last = at - F.pmod(at, F.lit(step))
    starts = F.sequence(last, at - F.lit(wide - piece), F.lit(-step)) if wide > piece else F.array(last)
    starts = F.when(last >= at - (wide - piece), starts).otherwise(F.array().cast("array<bigint>"))
    return f"{piece} microseconds", F.transform(starts, F.timestamp_micros)


def monitor_window(
    scored: DataFrame, actual: str, predicted: str, width: str = "1 day", slide: str | None = None,
    bins: int = 10, ts: str = "date_time",
) -> DataFrame:
    """RMSE and PSI (actual against predicted) per time window, sliding or not.

    Rows without a value are in no bin, and each side's shares are of its own values.  Windows are made of slices: counts,
    squares and ends are taken per slice and merged into the windows that hold it; then each row is counted, in its task, in the bins of the windows of
    its slice.  No row is copied over the network, however many windows it is in.
    """
    piece, starts = _slices(width, slide)
    rows = scored.select(F.window(ts, piece)["start"].alias("_s"), F.col(actual).alias("_a"), F.col(predicted).alias("_b")).filter("_s IS NOT NULL")
    miss = squared_error("_a", "_b")
    slices = rows.groupBy("_s").agg(
        F.count("_b").alias("n"), F.count("_a").alias("n0"), F.count(miss).alias("m"), F.sum(miss).alias("miss"),
        F.least(F.min("_a"), F.min("_b")).alias("low"), F.greatest(F.max("_a"), F.max("_b")).alias("high"),
    ).withColumn("_w", F.explode(starts))
    slices = stage(slices)
    totals = slices.groupBy("_w").agg(
        F.sum("n").alias("n"), F.sum("n0").alias("_n0"), F.sqrt(F.try_divide(F.sum("miss"), F.sum("m"))).alias("rmse"),
        F.min("low").alias("_low"), F.max("high").alias("_high"))
    totals = stage(totals)
    held = slices.select("_s", "_w").join(totals.select("_w", "_low", "_high"), "_w").groupBy("_s").agg(
        F.collect_list(F.struct("_w", "_low", "_high")).alias("_windows"))  # width over slide of them
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("_a").cast("double").alias("value")),
                              F.struct(F.lit(1).alias("side"), F.col("_b").cast("double").alias("value"))))
    values = rows.join(held, "_s").select("_windows", sides.alias("_p")).filter(F.col("_p.value").isNotNull())
    values = values.select(F.explode("_windows").alias("_in"), "_p.*").select("_in.*", "side", "value")
    step = (F.col("_high") - F.col("_low")) / float(bins)
    place = F.least(F.floor(F.try_divide(F.col("value") - F.col("_low"), step)), F.lit(bins - 1))
    counts = values.groupBy("_w", F.coalesce(place, F.lit(0)).alias("_bin")).agg(
        F.count_if(F.col("side") == 0).alias("n0"), F.count_if(F.col("side") == 1).alias("n1"))
    share0 = replace_zero(F.coalesce(F.try_divide(F.col("n0"), F.col("_n0")), F.lit(0.0)))
    share1 = replace_zero(F.coalesce(F.try_divide(F.col("n1"), F.col("n")), F.lit(0.0)))
    # bins empty on both sides contribute (1e-6 - 1e-6) * ln 1 = 0 and may stay away
    scores = counts.join(totals.select("_w", "n", "_n0", "rmse"), "_w").groupBy("_w", "n", "rmse").agg(
        F.sum((share1 - share0) * F.ln(share1 / share0)).alias("psi")
    )
    return psi_status(
        scores.select(F.col("_w").cast("timestamp_ntz").alias("window_start"), "n", "rmse", "psi")
    )
