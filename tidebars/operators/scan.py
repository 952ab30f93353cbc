"""Affine scan: y[t] = a[t] * y[t-1] + b[t] over series of any length.

Affine maps compose associatively, so the series is cut into blocks:

1. inside a block, with running sums only:  P[i] = a[1]*...*a[i] and
   S[i] = sum of b[j] / P[j], so that  y[i] = P[i] * (carry + S[i]);
2. each whole block is itself one affine map (one row per ``BLOCK_ROWS`` bars).
   The maps of a chunk are combined where the chunk lies, the chunks of a symbol
   in groups, and the groups again, until one group per symbol is left;
3. the carries return to the bars by ``(symbol, chunk)``, which is how the bars
   are already partitioned: the bars are never shuffled again, and series of one
   chunk need no shuffle at all.

The first row with a value starts the series at ``seed``.  Rows before it, and
rows without a value, leave the state as it is.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebars.operators.expr import F as T
from tidebars.operators.expr import Expr, raw, reach, together
from tidebars.operators.layout import BLOCK, BLOCK_ROWS, CHUNK, FIRST, HALO_FLAG, POS, RESUME_STEP, STATE, Series
from tidebars.session import stage

_GROUP = 64  # chunks (and groups of them) combined per group and level


@dataclass(frozen=True)
class Recurrence:
    """One recurrence.  ``b`` or ``seed`` NULL means the row has no value.

    ``a`` must be positive; a plain number is taken as constant.
    """

    name: str
    a: float | Column | Expr
    b: Column | Expr
    seed: Column | Expr


def ema(name: str, x: Column | Expr, n: int) -> Recurrence:
    """Exponential average of span ``n``; the first value is the seed."""
    if n < 2:
        raise ValueError("a span under 2 has no memory: take the column itself")
    alpha = 2.0 / (n + 1)
    return Recurrence(name, 1 - alpha, x * alpha, x)


def wilder(name: str, x: Column | Expr, n: int, seed: Column | Expr | None = None) -> Recurrence:
    """Wilder's average; rows where ``seed`` is NULL are before the start."""
    return Recurrence(name, 1 - 1.0 / n, x / float(n), x if seed is None else seed)


def running_sum(name: str, x: Column | Expr) -> Recurrence:
    return Recurrence(name, 1.0, x, x)


def first_value(name: str, x: Column | Expr) -> Recurrence:
    """The symbol's first value, carried to all of its rows."""
    here = T.when(T.col(POS) == 0, x)
    return Recurrence(name, 1.0, here, here)


def affine_scan(series: Series, items: list[Recurrence], depth: int = 1) -> Series:
    """Add one column per recurrence.

    ``depth`` counts the scans that the inputs have already been through.
    """
    kept = [f"`{c}`" for c in series.df.columns]
    far, warm = dict(series.reach), dict(series.warm)
    for item in items:
        needs = together(item.a, item.b, item.seed)
        # a copied block is right again once its carry is: whole blocks count
        far[item.name] = -(-reach(needs, series.reach) // BLOCK_ROWS) * BLOCK_ROWS
        series._allowed(far[item.name], item.name)
        need, warm[item.name] = reach(needs, series.warm), RESUME_STEP * depth
        if FIRST in series.df.columns and need > warm[item.name]:
            raise ValueError(f"{item.name} rests on {need} rows, its resume point lies {warm[item.name]} rows into the context")
    items = [replace(item, a=raw(item.a), b=raw(item.b), seed=raw(item.seed)) for item in items]
    inputs = []
    for i, item in enumerate(items):
        inputs += [item.b.alias(f"_b{i}"), item.seed.alias(f"_d{i}")]
        if isinstance(item.a, Column):
            inputs.append(item.a.alias(f"_a{i}"))
    df = series.df.select("*", *inputs)
    if FIRST in series.df.columns:
        df = _resumed(df, kept, items, depth)

    # log of P; b only counts where there is a seed too
    run = (
        f"OVER (PARTITION BY `{series.symbol}`, {CHUNK}, {BLOCK} ORDER BY {POS} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )
    logs = []
    for i, item in enumerate(items):
        if isinstance(item.a, Column):
            log = f"coalesce(sum(CASE WHEN isnotnull(_b{i}) AND isnotnull(_d{i}) THEN ln(_a{i}) END) {run}, 0D)"
        elif item.a == 1.0:
            log = "0D"
        else:
            log = f"count(CASE WHEN isnotnull(_d{i}) THEN _b{i} END) {run} * {math.log(item.a)!r}D"
        logs.append(f"{log} AS _p{i}")
    df = df.selectExpr("*", *logs)

    sums = []
    for i in range(len(items)):
        value = f"CASE WHEN isnotnull(_d{i}) THEN _b{i} END"
        sums.append(f"coalesce(sum({value} * exp(-_p{i})) {run}, 0D) AS _s{i}")
        sums.append(f"first((_d{i} - _b{i}) * exp(-_p{i}), true) {run} AS _f{i}")
    df = df.selectExpr("*", *sums)

    carries = _carries(series, df, len(items))
    if carries is not None:
        df = df.join(carries, [series.symbol, CHUNK], "left")
        df = df.selectExpr("*", f"try_element_at(_in, {BLOCK}) AS _c")
    start = "coalesce(get(_c, {i}), _f{i})" if carries is not None else "_f{i}"
    out = [f"exp(_p{i}) * ({start.format(i=i)} + _s{i}) AS `{item.name}`" for i, item in enumerate(items)]
    done = tuple((item.name, depth) for item in items)
    return replace(series, df=df.selectExpr(*kept, *out), scans=series.scans + done, reach=far, warm=warm)


def _resumed(df: DataFrame, kept: list[str], items: list[Recurrence], depth: int) -> DataFrame:
    """Inputs of a series that continues from saved states.

    The state of a scan of this depth is put in at a fixed bar of the context;
    the bars before it only serve the windows that feed the scan.
    """
    at = f"{FIRST} + {RESUME_STEP * depth}"
    out = []
    for i, item in enumerate(items):
        out.append(f"CASE WHEN isnull({FIRST}) OR {POS} > {at} THEN _b{i} WHEN {POS} = {at} THEN coalesce(_b{i}, 0D) END AS _b{i}")
        out.append(
            f"CASE WHEN isnull({FIRST}) OR {POS} > {at} THEN _d{i} "
            f"WHEN {POS} = {at} THEN try_element_at({STATE}, '{item.name}') END AS _d{i}"
        )
        if isinstance(item.a, Column):
            out.append(f"_a{i}")
    return df.selectExpr(*kept, *out)


def _carries(series: Series, df: DataFrame, n_items: int) -> DataFrame | None:
    """Per (symbol, chunk): a map from block number to the carries into it."""
    if series.longest < BLOCK_ROWS:
        return None
    symbol = series.symbol
    maps = ", ".join(
        f"struct(exp(_p{i}) AS a, exp(_p{i}) * _s{i} AS b, exp(_p{i}) * (_f{i} + _s{i}) AS s)" for i in range(n_items)
    )
    whole = df.where(f"NOT {HALO_FLAG} AND {series.row} % {BLOCK_ROWS} = {BLOCK_ROWS - 1}")
    units = whole.selectExpr(f"`{symbol}`", CHUNK, f"{BLOCK} AS _unit", f"array({maps}) AS _maps")
    chunks = units.groupBy(symbol, CHUNK).agg(_gathered())  # at most one chunk of blocks, already together

    if series.longest <= series.chunk_rows:
        return chunks.select(symbol, CHUNK, F.map_from_entries(_run(_unseen(n_items))).alias("_in"))

    # a small table that several branches read: written once, the bars above it are not redone for each
    chunks = stage(chunks)
    totals = chunks.select(symbol, F.col(CHUNK).alias("_unit"), _total(n_items).alias("_maps"))
    n_chunks = series.longest // series.chunk_rows + 2
    into = _prefix(totals, symbol, n_chunks, n_items).withColumnsRenamed({"_unit": CHUNK, "_carry": "_start"})
    entries = chunks.join(into, [symbol, CHUNK], "left").select(
        symbol, CHUNK, "_start", _run(F.coalesce(F.col("_start"), _unseen(n_items))).alias("_entries")
    )
    # the next chunk needs the carries into its copied blocks and into its first own one
    per_chunk = series.chunk_rows // BLOCK_ROWS
    after = F.expr(f"""filter(
        concat(CASE WHEN isnull(_start) THEN array() ELSE array(struct({CHUNK} * {per_chunk} AS _unit, _start AS _carry)) END, _entries),
        e -> e._unit >= ({CHUNK} + 1) * {per_chunk} - {series.halo // BLOCK_ROWS})""")
    last = F.element_at("_entries", -1)["_unit"] % per_chunk == 0
    parts = F.array(
        F.struct(F.col(CHUNK).alias("chunk"), F.col("_entries").alias("part")),
        F.when(last, F.struct((F.col(CHUNK) + 1).alias("chunk"), after.alias("part"))),
    )
    spread = entries.select(symbol, F.explode(F.array_compact(parts)).alias("_p"))
    return (
        spread.groupBy(symbol, F.col("_p.chunk").alias(CHUNK))
        .agg(F.flatten(F.collect_list("_p.part")).alias("_entries"))
        .select(symbol, CHUNK, F.map_from_entries("_entries").alias("_in"))
    )


def _gathered() -> Column:
    return F.expr("sort_array(collect_list(struct(_unit, _maps))) AS _units")


def _unseen(n_items: int) -> Column:
    """States before the first value."""
    return F.expr(f"array_repeat(CAST(NULL AS DOUBLE), {n_items})")


def _total(n_items: int) -> Column:
    """All maps of ``_units`` as one."""
    return F.expr(f"""aggregate(_units,
        array_repeat(struct(1D AS a, 0D AS b, CAST(NULL AS DOUBLE) AS s), {n_items}),
        (acc, u) -> zip_with(acc, u._maps, (f, g) -> struct(
            f.a * g.a AS a, g.a * f.b + g.b AS b,
            CASE WHEN isnull(f.s) THEN g.s ELSE g.a * f.s + g.b END AS s)))""")


def _run(start: Column) -> Column:
    """Entries (unit after, states after) for every unit of ``_units``."""
    state = "struct<y:array<double>,out:array<struct<_unit:bigint,_carry:array<double>>>>"
    zero = F.struct(start.alias("y"), F.array().alias("out")).cast(state)

    def one(acc: Column, unit: Column) -> Column:
        y = F.zip_with(
            acc["y"], unit["_maps"], lambda y, m: F.when(y.isNull(), m["s"]).otherwise(m["a"] * y + m["b"])
        )
        entry = F.struct((unit["_unit"] + 1).alias("_unit"), y.alias("_carry"))
        return F.struct(y.alias("y"), F.array_append(acc["out"], entry).alias("out")).cast(state)

    return F.aggregate("_units", zero, one, lambda acc: acc["out"])


def _prefix(units: DataFrame, symbol: str, n_units: int, n_items: int) -> DataFrame:
    """Rows (symbol, unit, carry): the states after all units before ``unit``.

    A level gathers at most ``_GROUP`` units; ``n_units`` is the counted length of
    the longest symbol and decides how many levels are needed.
    """
    if n_units <= _GROUP:
        groups = units.groupBy(symbol).agg(_gathered())
        return groups.select(symbol, F.inline(_run(_unseen(n_items))))
    groups = units.groupBy(symbol, F.expr(f"_unit div {_GROUP}").alias("_group")).agg(_gathered())
    totals = groups.select(symbol, F.col("_group").alias("_unit"), _total(n_items).alias("_maps"))
    above = _prefix(totals, symbol, n_units // _GROUP + 2, n_items)
    above = above.withColumnsRenamed({"_unit": "_group", "_carry": "_start"})
    joined = groups.join(above, [symbol, "_group"], "left")
    return joined.select(symbol, F.inline(_run(F.coalesce(F.col("_start"), _unseen(n_items)))))
