"""Profiling: summaries, correlation, histograms, outliers, collinearity."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

from tidebars.operators.features import scale_moments
from tidebars.operators.moments import triangle
from tidebars.session import only_row, stage

_BINS = 2048
EXACT_QR = 1e-12  # of a column's length, left by the others: rounding
WIDE = 12  # columns up to which pairs are built-in aggregates
EXACT = 1e-9  # unexplained share of a column's variance under which it counts as given by the others


def numeric_columns(df: DataFrame) -> list[str]:
    kinds = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    return [name for name, kind in df.dtypes if kind in kinds or kind.startswith("decimal")]


def long_form(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per value: ``feature`` and ``value``."""
    return df.select(*[F.col(c).cast("double") for c in columns]).unpivot([], columns, "feature", "value")


def schema_info(df: DataFrame) -> DataFrame:
    """Type and number of values of each column (one aggregate)."""
    kinds = dict(df.dtypes)
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns], F.count(F.lit(1)).alias("_all"))
    entries = [
        F.struct(
            F.lit(c).alias("feature"), F.lit(kinds[c]).alias("type"),
            F.col(c).alias("n_values"), (F.col("_all") - F.col(c)).alias("n_null"),
        )
        for c in df.columns
    ]
    return counts.select(F.inline(F.array(*entries)))


def zeros_per_column(df: DataFrame, columns: list[str]) -> DataFrame:
    return _per_column(df, columns, "n_zero", lambda c: F.count_if(F.col(c).isin(0)))


def _per_column(df: DataFrame, columns: list[str], name: str, aggregate) -> DataFrame:
    row = df.agg(*[aggregate(c).alias(c) for c in columns])
    return row.unpivot([], columns, "feature", name)


def count_rows(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count(key).alias("n"))


# --- quantiles ---------------------------------------------------------------


SKETCH = 4000  # size of a quantile sketch: its ranks are off by a thousandth at most, but for a chance of one in a hundred
MARGIN = 0.003  # of all values, on either side of a wanted rank


def quantiles(df: DataFrame, columns: list[str], probs: tuple[float, ...]) -> dict[str, list[float | None]]:
    """Exact, linearly interpolated quantiles; NaN is the greatest value, nulls don't count."""
    return _quantiles(df, columns, probs, [])[0]


def _quantiles(df: DataFrame, columns: list[str], probs: tuple[float, ...], more: list[Column]) -> tuple[dict[str, list[float | None]], Row]:
    """:func:`quantiles`, and the values of other aggregates ``more``, in two scans.

    The first makes a mergeable sketch of each column, which brackets every wanted rank. The second counts what lies below the
    brackets and sets the few values inside apart, a table on which the exact ranks are narrowed down (:func:`_order_statistics`). If a sketch has
    missed, all values are set apart: what is exact never rests on the sketch.
    """
    kinds = {}
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        kinds[c] = (v, (~F.isnan(v)) & (F.abs(v) < float("inf")))
    first = []
    for i, (v, finite) in enumerate(kinds.values()):
        inside = F.when(finite, v)
        first.append(F.struct(
            F.count(F.when(v == float("-inf"), 1)).alias("n_low"), F.count(inside).alias("n"), F.count(F.when(v == float("inf"), 1)).alias("n_high"),
            F.count(v).alias("n_all"), F.min(inside).alias("low"), F.max(inside).alias("high"),
            F.kll_sketch_agg_double(inside, F.lit(SKETCH)).alias("sketch")).alias(f"_q{i}"))
    row = only_row(df.agg(*first, *more))
    places, ends, brackets = {}, {}, []  # a bracket: column, its first finite rank wanted, low, high
    for i, c in enumerate(columns):
        own = row[f"_q{i}"]
        places[c] = [p * (own["n_all"] - 1) for p in probs] if own["n_all"] else []
        ranks = sorted({f(h) for h in places[c] for f in (math.floor, math.ceil)})
        ends[c] = {k: -math.inf if k < own["n_low"] else math.inf if k < own["n_low"] + own["n"] + own["n_high"] else math.nan for k in ranks}
        brackets += [(c, k - own["n_low"], own) for k in ranks if own["n_low"] <= k < own["n_low"] + own["n"]]
    for (c, k, _), value in zip(brackets, _ranked(df, kinds, brackets)):
        ends[c][k + row[f"_q{columns.index(c)}"]["n_low"]] = value
    out = {}
    for c in columns:
        values = []
        for h in places[c]:
            a, b = ends[c][math.floor(h)], ends[c][math.ceil(h)]
            values.append(a if a == b else a + (b - a) * (h - math.floor(h)))
        out[c] = values or [None] * len(probs)
    return out, row


def _ranked(df: DataFrame, kinds: dict, wanted: list[tuple]) -> list[float]:
    """The values at ranks among the finite values of columns: ``wanted`` has column, rank and what the first scan knows of the column."""
    if not wanted:
        return []
    spark = df.sparkSession
    asked = [F.array(*[F.kll_sketch_get_quantile_double(F.lit(bytes(own["sketch"])), F.lit(min(1.0, max(0.0, (k + s) / max(1, own["n"] - 1) + s * MARGIN))))
                       for s in (-1, 1)]).alias(f"b{i}") for i, (_, k, own) in enumerate(wanted)]
    found = only_row(spark.range(1).select(*asked))
    ranges = {}
    for i, (c, k, own) in enumerate(wanted):
        low, high = found[f"b{i}"]
        # the ends of all values are no guess
        ranges.setdefault((c, own["low"] if k <= own["n"] * MARGIN + 1 else low, own["high"] if k >= own["n"] * (1 - MARGIN) - 2 else high), []).append(k)
    listed = list(ranges)
    watch = Observation()
    below = [F.count(F.when(kinds[c][1] & (kinds[c][0] < low), 1)).alias(f"n{i}") for i, (c, low, _) in enumerate(listed)]
    parts = F.explode(F.array(*[F.struct(F.lit(str(i)).alias("feature"), F.when(kinds[c][1] & kinds[c][0].between(low, high), kinds[c][0]).alias("value"))
                                for i, (c, low, high) in enumerate(listed)]))
    near = stage(df.observe(watch, *below).select(parts.alias("_p")).select("_p.*").where("value IS NOT NULL"))
    under = watch.get
    sizes = {r["feature"]: r for r in near.groupBy("feature").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).collect()}
    inside = {}
    for i, key in enumerate(listed):
        own, ranks = sizes.get(str(i)), [k - under[f"n{i}"] for k in ranges[key]]
        if own is None or min(ranks) < 0 or max(ranks) >= own["n"]:
            return _all_ranked(df, kinds, wanted)
        inside[str(i)] = (own["low"], own["high"], 0, ranks)
    values = _order_statistics(near, inside)
    return [values[str(i)][k - under[f"n{i}"]] for c, k, _ in wanted for i, key in enumerate(listed) if key[0] == c and k in ranges[key]]


def _all_ranked(df: DataFrame, kinds: dict, wanted: list[tuple]) -> list[float]:
    """:func:`_ranked` with every value in the brackets."""
    long = long_form(df, list(kinds)).where((~F.isnan("value")) & (F.abs("value") < float("inf")))
    asked: dict[str, tuple] = {}
    for c, k, own in wanted:
        asked.setdefault(c, (own["low"], own["high"], 0, []))[3].append(k)
    values = _order_statistics(long, asked)
    return [values[c][k] for c, k, _ in wanted]


def _order_statistics(long: DataFrame, wanted: dict[str, tuple]) -> dict[str, dict[int, float]]:
    """Per feature the values at 0-based ranks.  Every round splits each open range into bins in one job and keeps
    the bins with a rank; only their counts, a fixed number for each rank, reach the driver."""
    spark = long.sparkSession
    found: dict[str, dict[int, float]] = {c: {} for c in wanted}
    # (feature, low, high) -> (values below it, ranks inside it)
    open_ranges = {(c, low, high): (0, ranks) for c, (low, high, _, ranks) in wanted.items()}
    while open_ranges:
        for key in [k for k in open_ranges if k[1] == k[2]]:
            found[key[0]].update(dict.fromkeys(open_ranges.pop(key)[1], key[1]))
        if not open_ranges:
            break
        listed = [(i, c, lo, hi) for i, (c, lo, hi) in enumerate(open_ranges)]
        ranges = spark.createDataFrame(listed, "i int, feature string, lo double, hi double")
        # halves keep the width finite; a bin may end up anywhere in the order of rounding, as bins only need be monotone
        share = (F.col("value") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        place = F.least(F.floor(share * _BINS), F.lit(_BINS - 1)).cast("int")
        counted = (
            long.join(F.broadcast(ranges), "feature").where("value BETWEEN lo AND hi")  # a row per open range
            .groupBy("i", place.alias("bin")).agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
            .orderBy("i", "bin").collect()
        )
        below = [b for b, _ in open_ranges.values()]
        following = {}
        keys = list(open_ranges)
        for row in counted:
            i = row["i"]
            here = [r for r in open_ranges[keys[i]][1] if below[i] <= r < below[i] + row["n"]]
            if here:
                following[(keys[i][0], row["low"], row["high"])] = (below[i], here)
            below[i] += row["n"]
        open_ranges = following
    return found


def describe_t(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, std, min, quartiles, max; one row per column."""
    stats = [
        F.struct(F.count(c).alias("count"), F.avg(c).cast("double").alias("mean"), F.stddev(c).alias("std"), F.min(c).cast("double").alias("min"),
                 F.max(c).cast("double").alias("max")).alias(f"_s{i}")
        for i, c in enumerate(columns)
    ]
    quartiles, row = _quantiles(df, columns, (0.25, 0.5, 0.75), stats)
    rows = []
    for i, c in enumerate(columns):
        own = row[f"_s{i}"]
        rows.append((c, own["count"], own["mean"], own["std"], own["min"], *quartiles[c], own["max"]))
    return df.sparkSession.createDataFrame(
        rows, "feature string, count bigint, mean double, std double, min double, q25 double, q50 double, q75 double, max double")


def boxplot_stats(df: DataFrame, columns: list[str], reach: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends (last values within ``reach`` IQR) and outlier count."""
    quartiles = quantiles(df, columns, (0.25, 0.5, 0.75))
    entries = []
    for c in columns:
        q1, q2, q3 = quartiles[c]
        if q1 is None:
            continue
        low, high = q1 - reach * (q3 - q1), q3 + reach * (q3 - q1)
        inside = F.col(c).between(low, high)
        entries.append(
            F.struct(
                F.lit(c).alias("feature"),
                F.lit(q1).alias("q25"), F.lit(q2).alias("q50"), F.lit(q3).alias("q75"),
                F.min(F.when(inside, F.col(c))).cast("double").alias("whisker_low"),
                F.max(F.when(inside, F.col(c))).cast("double").alias("whisker_high"),
                F.count_if(~inside).alias("n_outlier"),
            ).alias(c)
        )
    return df.agg(*entries).select(F.inline(F.array(*columns)))


# --- correlation -------------------------------------------------------------


def correlation(x: str, y: str) -> Column:
    """Pearson correlation over rows with both values; NULL if either is constant there."""
    a, b = (F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), F.col(c).cast("double")) for c in (x, y))
    spread = F.when((F.min(a) < F.max(a)) & (F.min(b) < F.max(b)), F.stddev_pop(a) * F.stddev_pop(b))
    return F.try_divide(F.covar_pop(a, b), spread)


def correlations(df: DataFrame, left: list[str], right: list[str]) -> DataFrame:
    """``feature_x, feature_y, r`` for each column of ``left`` with each of ``right``, over the rows with both values.

    NULL where either is constant.  Pairs of up to ``WIDE`` columns are built-in aggregates of one job, columns without nulls sharing
    theirs.  Of more columns the tasks multiply whole batches, values and masks of presence, and the products are added.
    """
    names = list(dict.fromkeys([*left, *right]))
    if len(names) > WIDE:
        return _products(df, left, right)
    pairs = {tuple(sorted((a, b))) for a in left for b in right}
    own = [F.struct(F.count(c).alias("n"), (F.min(c) < F.max(c)).alias("moves"), F.stddev_pop(c).alias("sd")).alias(f"c{i}") for i, c in enumerate(names)]
    ab = {pair: f"p{i}" for i, pair in enumerate(sorted(pairs))}
    row = only_row(df.agg(F.count(F.lit(1)).alias("n"), *own, *[F.covar_pop(a, b).alias(ab[a, b]) for a, b in ab if a != b]))
    stats = {c: row[f"c{i}"] for i, c in enumerate(names)}
    whole = {c for c in names if stats[c]["n"] == row["n"]}
    found: dict[tuple[str, str], float | None] = {}
    partial = [pair for pair in ab if not whole.issuperset(pair) and pair[0] != pair[1]]
    if partial:
        masked = only_row(df.agg(*[correlation(*pair).alias(ab[pair]) for pair in partial]))
        found = {pair: masked[ab[pair]] for pair in partial}
    for a, b in ab:
        if (a, b) not in found:
            moves = stats[a]["moves"] and stats[b]["moves"]
            found[a, b] = None if not moves else 1.0 if a == b else row[ab[a, b]] / (stats[a]["sd"] * stats[b]["sd"])
    rows = [(a, b, found[tuple(sorted((a, b)))]) for a in left for b in right]
    return df.sparkSession.createDataFrame(rows, "feature_x string, feature_y string, r double")


def _products(df: DataFrame, left: list[str], right: list[str]) -> DataFrame:
    """:func:`correlations` by matrix products in the tasks, in units of each column's mean and deviation."""
    names = list(dict.fromkeys([*left, *right]))
    values = df.select(*[F.col(c).cast("double") for c in names])
    row = only_row(values.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s"), (F.min(c) < F.max(c)).alias("moves")).alias(f"c{i}")
                                for i, c in enumerate(names)]))
    shift = np.array([row[f"c{i}"]["m"] or 0.0 for i in range(len(names))])
    scale = np.array([row[f"c{i}"]["s"] or 1.0 for i in range(len(names))])
    moves = {c: bool(row[f"c{i}"]["moves"]) for i, c in enumerate(names)}
    x_at, y_at = ([names.index(c) for c in side] for side in (left, right))
    parts = ("n", "x", "y", "xx", "yy", "xy")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(parts), len(left), len(right)))
        for batch in batches:
            z = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            missing = np.column_stack([c.is_null().to_numpy(zero_copy_only=False) for c in batch.columns])
            with np.errstate(invalid="ignore"):
                z = np.where(missing, 0.0, (z - shift) / scale)
            here = (~missing).astype(float)
            x, y, p, q = z[:, x_at], z[:, y_at], here[:, x_at], here[:, y_at]
            with np.errstate(invalid="ignore"):
                sums += np.stack([p.T @ q, x.T @ q, p.T @ y, (x * x).T @ q, p.T @ (y * y), x.T @ y])
        flat = sums.reshape(len(parts), -1)
        cells = [pa.array(np.arange(flat.shape[1], dtype=np.int32)), *map(pa.array, flat)]
        yield pa.RecordBatch.from_arrays(cells, names=["cell", *parts])

    cells = values.mapInArrow(work, "cell int, " + ", ".join(f"{c} double" for c in parts))
    total = cells.groupBy("cell").agg(*[F.sum(c).alias(c) for c in parts])
    cov = F.col("xy") - F.try_divide(F.col("x") * F.col("y"), F.col("n"))
    # a column that moves, but not in the rows of a pair, has only the rounding of its sums left
    spread = [F.col(c * 2) - F.try_divide(F.col(c) * F.col(c), F.col("n")) for c in "xy"]
    solid = (spread[0] > EXACT * 1e-3) & (spread[1] > EXACT * 1e-3)
    r = F.when(F.isnan(spread[0]) | F.isnan(spread[1]), F.lit(math.nan)).when(solid, cov / F.sqrt(F.abs(spread[0] * spread[1])))
    x_of = F.element_at(F.array(*map(F.lit, left)), F.expr(f"cell div {len(right)} + 1").cast("int"))
    y_of = F.element_at(F.array(*map(F.lit, right)), F.expr(f"cell % {len(right)} + 1").cast("int"))
    still = [c for c, moving in moves.items() if not moving]
    rows = total.select(x_of.alias("feature_x"), y_of.alias("feature_y"), r.alias("r"))
    flat = F.col("feature_x").isin(still) | F.col("feature_y").isin(still) if still else F.lit(False)
    same = F.col("feature_x") == F.col("feature_y")
    return rows.withColumn("r", F.when(~flat, F.when(same & F.col("r").isNotNull() & ~F.isnan("r"), F.lit(1.0)).otherwise(F.col("r"))))


def corr_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of all pairs, in long form, over pairwise complete rows."""
    return correlations(df, columns, columns)


def corr_select(df: DataFrame, features: list[str], target: str, at_least: float = 0.5) -> DataFrame:
    """Features whose correlation with the target is at least ``at_least`` in size."""
    found = correlations(df, features, [target])
    return found.filter((F.abs("r") >= at_least) & ~F.isnan("r")).select(F.col("feature_x").alias("feature"), "r")


def vif(df: DataFrame, columns: list[str]) -> DataFrame:
    """Variance inflation factors, with a constant: 1 / (1 - R^2) of each column on the others.

    Infinite for a column that the others give exactly, NULL for a constant one.  From a triangular factor that the tasks make together over
    the complete rows: near-collinear columns are told from collinear ones.
    """
    complete = df.select(*[F.col(c).cast("double") for c in columns]).na.drop()
    known = scale_moments(complete, columns)
    shift, scale = (np.array([known[c][i] or float(i) for c in columns]) for i in (0, 1))
    r = triangle(complete, columns, shift, scale)[1:, 1:]  # centred: the constant's row and column left out
    out: list[tuple[str, float | None]] = []
    size = np.linalg.norm(r, axis=0)
    live = [i for i in range(len(columns)) if known[columns[i]][1] and size[i] > 0]
    for i, c in enumerate(columns):
        if i not in live:
            out.append((c, None))
            continue
        others = [j for j in live if j != i]
        unit = r[:, others] / size[others]
        own = r[:, i] / size[i]
        if others:
            left, values, _ = np.linalg.svd(unit, full_matrices=False)
            basis = left[:, values > EXACT_QR * values[0]]
            own = own - basis @ (basis.T @ own)
            own = own - basis @ (basis.T @ own)
        rest = float(own @ own)
        out.append((c, float("inf") if rest < EXACT_QR ** 2 else 1.0 / rest))
    return df.sparkSession.createDataFrame(out, "feature string, vif double")


def collinearity_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per feature: strongest correlation with another feature, and the VIF."""
    strongest = (
        corr_matrix(df, columns).filter(F.col("feature_x") != F.col("feature_y"))
        .groupBy(F.col("feature_x").alias("feature")).agg(F.max(F.abs("r")).alias("max_abs_r"))
    )
    return strongest.join(vif(df, columns), "feature")


# --- distributions -----------------------------------------------------------


def bin_of(x: Column, low, high, bins: int) -> Column:
    """0-based equal-width bin; the upper end belongs to the last bin."""
    if low == high:
        return F.when(x.isNotNull(), F.lit(0))
    return F.least(F.width_bucket(x, F.lit(float(low)), F.lit(float(high)), F.lit(bins)), F.lit(bins)).cast("int") - 1


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Counts in equal-width bins, empty bins included."""
    low, high = only_row(df.agg(F.min(column), F.max(column)))
    spark = df.sparkSession
    if low is None:
        return spark.createDataFrame([], "bin int, low double, high double, n bigint")
    width = (float(high) - float(low)) / bins
    counts = df.groupBy(bin_of(F.col(column), low, high, bins).alias("bin")).agg(F.count(column).alias("n"))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin",
        (F.lit(float(low)) + F.col("bin") * width).alias("low"),
        (F.lit(float(low)) + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def zscore_outliers(df: DataFrame, columns: list[str], key: list[str], limit: float = 2.0) -> DataFrame:
    """Keys of rows where any column lies ``limit`` or more population standard
    deviations from its mean.  The moments are one row and become literals."""
    row = only_row(df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns]))
    tests = [
        F.abs((F.col(c) - F.lit(row[c]["m"])) / F.lit(row[c]["s"])) >= limit for c in columns if row[c]["s"]
    ]
    condition = F.lit(False)
    for test in tests:
        condition = condition | F.coalesce(test, F.lit(False))
    return df.filter(condition).select(*key)


def xy_pairs(df: DataFrame, features: list[str], target: str, key: list[str], fraction: float | None = None) -> DataFrame:
    """(feature, value, target) rows for scatter charts."""
    if fraction is not None:
        df = df.sample(fraction, seed=42)
    wide = df.select(*key, target, *[F.col(c).cast("double") for c in features])
    return wide.unpivot([*key, target], features, "feature", "value")


def time_line(df: DataFrame, columns: list[str], ts: str = "date_time", width: str | None = None) -> DataFrame:
    """Ordered series; ``width`` averages it per symbol and time span."""
    if width is None:
        return df.select("symbol", ts, *columns).orderBy("symbol", ts)
    spans = df.groupBy("symbol", F.window(ts, width).alias("_w")).agg(*[F.avg(c).alias(c) for c in columns])
    return spans.select("symbol", F.col("_w.start").cast("timestamp_ntz").alias(ts), *columns).orderBy("symbol", ts)


def axis_range(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(
        F.least(F.min(a), F.min(b)).alias("low"), F.greatest(F.max(a), F.max(b)).alias("high")
    )
