"""Chunked layout of long series.

A window ordered by time and partitioned by symbol alone sends a whole symbol
to one task.  Here every symbol is cut into chunks of ``chunk_rows``
consecutive bars, and the last ``halo`` bars of a chunk are copied to the next
one, so that any window of up to ``halo`` rows sees all of its rows inside one
chunk.  Tasks are then of equal size however the rows are spread over symbols.
The series knows how many earlier rows each of its columns rests on, windows over
windows included, and refuses a column that reaches back beyond the copies.

Row positions come from counts per symbol in the partitions of one sort by
(symbol, time): the partitions are of equal size whatever the width of the bars,
so neither the counting nor the numbering ever gathers a whole symbol.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidebars.operators.expr import Expr, Frame, needs_of, raw, reach
from tidebars.session import only_row, stage

POS, CHUNK, BLOCK, HALO_FLAG = "_pos", "_chunk", "_block", "_halo"
FIRST, STATE, ROW = "_first", "_state", "_row"  # of a resumed series
BLOCK_ROWS = 128  # rows per block of the affine scan
HALO = 256  # copied rows unless more are asked for: two whole blocks
CHUNK_ROWS = 8192
RESUME_STEP = 64  # bars between the resume points of successive scan depths


def number_rows(
    bars: DataFrame,
    symbol: str = "symbol",
    ts: str = "date_time",
) -> tuple[DataFrame, DataFrame]:
    """Add the 0-based position of each bar within its symbol, in time order.

    ``(symbol, ts)`` must be unique.  Rows without symbol or time have no place in a
    series and are left out; :func:`keyless_rows` has them.  Returns the numbered
    bars and the offsets (one row per symbol and partition of the sort).
    """
    placed = bars.filter(F.col(symbol).isNotNull() & F.col(ts).isNotNull()).repartitionByRange(symbol, ts)
    source = stage(placed.withColumn("_part", F.spark_partition_id()))
    before = Window.partitionBy(symbol).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = source.groupBy(symbol, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    inside = Window.partitionBy(symbol, "_part").orderBy(ts)
    numbered = (
        source.join(offsets.drop("_rows"), [symbol, "_part"])
        .withColumn(POS, F.col("_offset") + F.row_number().over(inside) - 1)
        .drop("_part", "_offset")
    )
    return numbered, offsets


def keyless_rows(bars: DataFrame, symbol: str = "symbol", ts: str = "date_time") -> DataFrame:
    """The rows that a series leaves out: no symbol or no time."""
    return bars.filter(F.col(symbol).isNull() | F.col(ts).isNull())


@dataclass(frozen=True)
class Series:
    """Bars in the chunked layout, with the window helpers that rely on it."""

    df: DataFrame
    symbol: str
    ts: str
    chunk_rows: int
    longest: int  # rows of the longest symbol
    scans: tuple[tuple[str, int], ...] = ()  # columns made by scans, with their depth
    row: str = POS  # position among the rows at hand, which decides chunk and block
    halo: int = HALO
    reach: dict[str, int] = field(default_factory=dict)  # earlier rows that a column rests on
    warm: dict[str, int] = field(default_factory=dict)  # rows of a resumed series before a column is right

    def window(self, n: int) -> Frame:
        """The current row and the ``n - 1`` rows before it, for expressions."""
        self._allowed(n - 1)
        return Frame(self._ordered().rowsBetween(-(n - 1), 0), n - 1)

    def _allowed(self, rows: int, what: str = "a window") -> None:
        if rows > self.halo:
            raise ValueError(f"{what} reaches {rows} rows back; lay the series out with lookback={rows} or more")

    def _ordered(self) -> WindowSpec:
        # The block number is implied by the position; naming it first gives
        # these windows and the scan's block windows one common sort.
        return Window.partitionBy(self.symbol, CHUNK).orderBy(BLOCK, POS)

    def lag(self, column: str | Column | Expr, k: int = 1) -> Expr:
        self._allowed(k, "a lag")
        return Expr(F.lag(raw(column), k).over(self._ordered()), {name: rows + k for name, rows in needs_of(column).items()})

    def rolling(self, agg, column: str | Column | Expr, n: int) -> Expr:
        """``agg`` over ``n`` rows, NULL unless all ``n`` values are present."""
        w = self.window(n)
        plain = F.col(column) if isinstance(column, str) else raw(column)
        typed = Expr(plain, needs_of(column))
        value = agg(plain if getattr(agg, "__module__", "").startswith("pyspark.") else typed)
        needs = value.needs if isinstance(value, Expr) else typed.needs
        full = F.when(F.count(plain).over(w.spec) == n, raw(value).over(w.spec))
        return Expr(full, {name: rows + n - 1 for name, rows in needs.items()})

    def add(self, **columns: Column | Expr) -> "Series":
        """Add columns; one that reaches beyond the copied rows is refused."""
        far, warm = dict(self.reach), dict(self.warm)
        for name, column in columns.items():
            far[name], warm[name] = reach(needs_of(column), self.reach), reach(needs_of(column), self.warm)
            self._allowed(far[name], name)
            if FIRST in self.df.columns and warm[name] > HALO:
                raise ValueError(f"{name} needs {warm[name]} rows of context, a resumed series has {HALO}")
        return replace(self, df=self.df.withColumns({name: raw(column) for name, column in columns.items()}), reach=far, warm=warm)

    def body(self) -> DataFrame:
        """The bars without the copies, with the helper columns still there."""
        return self.df.filter(~F.col(HALO_FLAG))

    def result(self, *columns: str) -> DataFrame:
        """The bars without copies and helper columns."""
        out = self.body()
        if columns:
            return out.select(self.symbol, self.ts, *columns)
        return out.select(*[c for c in out.columns if not c.startswith("_")])


def lay_out(
    bars: DataFrame,
    symbol: str = "symbol",
    ts: str = "date_time",
    chunk_rows: int | None = None,
    resume: DataFrame | None = None,
    lookback: int = HALO,
) -> Series:
    """Put bars into the chunked layout (one shuffle on ``(symbol, chunk)``).

    ``lookback`` is the number of earlier rows that the longest window, or chain of
    windows, rests on; chunks are never shorter than that.

    ``resume`` has one row per symbol whose bars do not start at its first bar:
    the position of the first bar at hand, and the saved states of the scans.
    """
    if chunk_rows is None:
        chunk_rows = int(bars.sparkSession.conf.get("tidebars.chunk.rows", str(CHUNK_ROWS)))
    if chunk_rows % BLOCK_ROWS or chunk_rows < HALO:
        raise ValueError(f"chunk_rows must be a multiple of {BLOCK_ROWS} and at least {HALO}")
    halo = max(HALO, -(-lookback // BLOCK_ROWS) * BLOCK_ROWS)
    chunk_rows = max(chunk_rows, halo)
    numbered, offsets = number_rows(bars, symbol, ts)
    longest = only_row(offsets.agg(F.max(F.col("_offset") + F.col("_rows"))))[0] or 0
    row = POS
    if resume is not None:
        row = ROW
        saved = resume.select(symbol, F.col("position").alias(FIRST), F.col("state").alias(STATE))
        numbered = numbered.join(saved, symbol, "left").withColumn(ROW, F.col(POS)).withColumn(
            POS, F.col(POS) + F.coalesce(F.col(FIRST), F.lit(0))
        )
    # never NULL, and known to be so: a filter on it would keep scans from sharing the shuffle
    home = F.coalesce(F.expr(f"{row} div {chunk_rows}"), F.lit(0))
    copied = F.col(row) % chunk_rows >= chunk_rows - halo
    chunks = F.when(copied, F.array(home, home + 1)).otherwise(F.array(home))
    df = (
        numbered.withColumn(CHUNK, F.explode(chunks))
        .withColumn(HALO_FLAG, F.col(CHUNK) > home)
        .withColumn(BLOCK, F.expr(f"{row} div {BLOCK_ROWS}"))
        .repartition(symbol, CHUNK)
    )
    return Series(df, symbol, ts, chunk_rows, longest, row=row, halo=halo)
