"""The hourly load as one job: four tables, keys, and runs that readers see whole or not at all.

A run writes ``financial``, ``technical``, ``transformed_date``, the bars that came ``late``, and the carry of the next run, and commits them
with one manifest (see ``sources.runs``).  A run that broke off isn't seen and is repeated under its number; of two at once one commits.

A run reads the committed manifest, one carry row per symbol (newest bar, start of the context, states of
the scans) and of the stored bars the months of the contexts alone.
"""

from __future__ import annotations

import time
from dataclasses import replace

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidebars.functions.scalar import cyclical
from tidebars.functions.schemas import CYCLICAL_COLUMNS
from tidebars.operators.indicators import TECHNICAL_COLUMNS, TECHNICAL_RECIPES, add_indicators
from tidebars.operators.layout import POS, Series, lay_out
from tidebars.operators.windows import lag_fill
from tidebars.plans.hourly import _BARS, next_carry
from tidebars.session import stage
from tidebars.sources import runs
from tidebars.sources.files import is_not_empty
from tidebars.sources.tables import surrogate_key, with_month

TABLES = {
    "financial": ("fin_key", ["open", "high", "low", "close", "tick_vol", "hist_close"]),
    "technical": ("tech_key", TECHNICAL_COLUMNS),
    "transformed_date": ("date_key", CYCLICAL_COLUMNS),
}
LATE = "late"
_RUNS = "run int, rows bigint, first timestamp_ntz, last timestamp_ntz, last_key bigint, late bigint, read_s double, indicators_s double, write_s double"
_KEYS = ["symbol", "date_time"]


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each committed run: rows, time range, late bars, seconds by step."""
    return runs.facts(spark, folder, _RUNS)


def loaded(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """The rows of the committed runs of a table; none before the first run."""
    rows = runs.read(spark, folder, table, runs.newest(spark, folder))
    if rows is not None:
        return rows.drop("ym")
    if table == LATE:
        return spark.createDataFrame([], ", ".join(f"{c} {_kind(c)}" for c in _BARS))
    key, columns = TABLES[table]
    return spark.createDataFrame([], ", ".join(f"{c} {_kind(c)}" for c in (*_KEYS, key, *columns)))


def _kind(column: str) -> str:
    kinds = {"symbol": "string", "date_time": "timestamp_ntz", "tick_vol": "bigint"}
    return kinds.get(column, "bigint" if column.endswith("_key") else "double")


def _context(spark: SparkSession, folder: str, before: runs.Manifest, carry: DataFrame) -> DataFrame:
    """The stored bars that the next run starts from.

    Symbols whose context is the whole of their few bars are joined by the partition column, so that they don't open
    the months of the others.
    """
    starts = carry.select("symbol", "since")
    stored = runs.read(spark, folder, "financial", before)
    short = starts.filter(F.col("since").isNull()).select("symbol")
    near = stored.join(short, "symbol", "left_semi").select(*_BARS)
    long = starts.filter(F.col("since").isNotNull())
    oldest = long.agg(F.min("since")).first()[0]
    if oldest is None:
        return near
    recent = stored.filter(F.col("ym") >= oldest.strftime("%Y-%m")).join(long, "symbol").filter(F.col("date_time") >= F.col("since"))
    return near.unionByName(recent.select(*_BARS))


def _late(spark: SparkSession, folder: str, before: runs.Manifest, old: DataFrame) -> DataFrame | None:
    """Of the landed bars that aren't newer than their symbol's newest, those that are neither stored nor known as late; None if there are none."""
    old = with_month(old)
    if not is_not_empty(old):
        return None
    months = old.select("symbol", "ym").distinct()
    for table in ("financial", LATE):
        stored = runs.read(spark, folder, table, before)
        if stored is not None:
            near = stored.join(months, ["symbol", "ym"], "left_semi")  # folders of these symbols and months
            old = old.join(near.select(*_KEYS), _KEYS, "left_anti")
    return stage(old)


def hourly_load(
    spark: SparkSession, folder: str, landed: DataFrame, recipes: list[str] | None = None, columns: list[str] | None = None,
    fan: int = runs.FAN, **layout,
) -> Row | None:
    """Load the landed bars that are newer than their symbol's newest; the committed run, or None if nothing came.

    Landed rows may repeat each other or stored bars; rows without symbol or time are not loaded.  A bar that isn't newer than
    the newest of its symbol and isn't stored either can't be put in its place any more: it goes to the table ``late``, once.
    ``columns`` are those of the technical table, if not the usual ones.  If another load commits the same run,
    :class:`tidebars.sources.runs.Conflict` is raised and nothing is kept.
    """
    began = time.monotonic()
    before = runs.newest(spark, folder)
    carry = None if before is None else runs.read(spark, folder, "carry", before)
    new = landed.select(*_BARS).filter(F.col("symbol").isNotNull() & F.col("date_time").isNotNull()).dropDuplicates(_KEYS)
    late = None
    if carry is not None:
        marked = stage(new.join(carry.select("symbol", "mark"), "symbol", "left"))
        fresh = F.col("mark").isNull() | (F.col("date_time") > F.col("mark"))
        new = marked.filter(fresh).drop("mark")
        late = _late(spark, folder, before, marked.filter(~fresh).drop("mark"))
    else:
        new = stage(new)
    n_late = 0 if late is None else late.count()
    size = new.agg(F.count("*").alias("rows"), F.min("date_time").alias("first"), F.max("date_time").alias("last")).first()
    if not size["rows"] and not n_late:
        return None
    read = time.monotonic()

    run = runs.Run(spark, folder, before, fan)
    last_key = 0 if before is None else before.facts["last_key"]
    try:
        if n_late:
            run.write(LATE, late.select("symbol", "ym", *[c for c in _BARS if c != "symbol"]), ("symbol", "ym"))
        if size["rows"]:
            series, keyed = _computed(spark, folder, before, carry, new, recipes, columns, last_key + 1, layout)
            computed = time.monotonic()
            dated = with_month(keyed.select("*", *[x.alias(n) for n, x in cyclical().items()]))
            for table, (key, usual) in TABLES.items():
                own = [c for c in (columns or usual if table == "technical" else usual) if c in dated.columns]
                out = dated.select("symbol", "ym", "date_time", F.col("key").alias(key), *own).repartition("symbol", "ym")
                run.write(table, out, ("symbol", "ym"))
            run.write("carry", _carry(series), replace=True)
        else:
            computed = read
        said = dict(run=run.number, rows=size["rows"], first=_text(size["first"]), last=_text(size["last"]), last_key=last_key + size["rows"],
                    late=n_late, read_s=read - began, indicators_s=computed - read, write_s=time.monotonic() - computed)
        run.commit(said)
    except runs.Conflict:
        raise
    except Exception:
        run.abandon()
        raise
    return Row(**said | {"first": size["first"], "last": size["last"]})


def _text(at) -> str | None:
    return None if at is None else at.isoformat()


def _computed(spark, folder, before, carry, new, recipes, columns, first_key, layout) -> tuple[Series, DataFrame]:
    """The series of the new bars after their context, and its new rows with their keys."""
    if carry is None:
        series = lay_out(new, **layout)
    else:
        known = carry.filter(F.col("position").isNotNull())
        series = lay_out(_context(spark, folder, before, carry).unionByName(new), resume=known, **layout)
    series = add_indicators(lag_fill(series, "close", "hist_close", 0.0), recipes or TECHNICAL_RECIPES)
    kept = [c for c in [*_BARS, "hist_close", *(columns or TECHNICAL_COLUMNS)] if c in series.df.columns]
    states = [c for c in series.df.columns if c.startswith("_") or c in {name for name, _ in series.scans}]
    series = replace(series, df=stage(series.df.select(*dict.fromkeys([*kept, *states]))))
    rows = series.result(*[c for c in kept if c not in _KEYS]).join(new.select(*_KEYS), _KEYS, "left_semi")
    return series, stage(surrogate_key(rows, "key", first_key))


def _carry(series: Series) -> DataFrame:
    """What the next run needs of this one, a row per symbol."""
    marks = series.body().groupBy(series.symbol).agg(F.max(series.ts).alias("mark"), F.max(POS).alias("newest"))
    return next_carry(series).join(marks.drop("newest"), series.symbol)
