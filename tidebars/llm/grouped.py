"""Work on groups of rows in sorted partitions, hot groups split so that all pairs still meet."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebars.llm.common import tidy
from tidebars.session import stage


def split_pairs(rows: DataFrame, keys: list[str], member: str, limit: int) -> DataFrame:
    """``rows`` with ``bucket, low, high``: any two rows of a group ``keys`` meet in exactly one group ``keys, low, high``.

    A group of up to ``limit`` rows stays whole. A larger one is dealt into buckets of some ``limit`` rows by ``member`` (a
    column that tells its rows apart), and each row goes to the groups of its bucket with itself and with every other
    one. Inside a group of two buckets (``low < high``) only rows of different buckets are pairs.
    """
    sizes = stage(rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > limit))
    k = F.coalesce(F.ceil(F.col("_n") / limit), F.lit(1))
    bucket = F.pmod(F.xxhash64(member), k).cast("int")
    other = F.explode(F.sequence(F.lit(0), (k - 1).cast("int")))
    return (
        rows.join(sizes, keys, "left").withColumn("bucket", bucket).withColumn("_other", other)
        .withColumn("low", F.least("bucket", "_other")).withColumn("high", F.greatest("bucket", "_other")).drop("_n", "_other")
    )


def whole_groups(rows: DataFrame, keys: list[str], work: Callable[[pa.Table, np.ndarray], Iterable[pa.RecordBatch]], schema: str,
                 shrink: Callable[[pa.Table], pa.Table] | None = None) -> DataFrame:
    """``work`` on tables of whole groups: it gets rows in which the groups stand one after the other, and where each begins.

    One table holds the groups that end in a batch. The rows of the last group wait for the next batch; ``shrink`` may
    reduce them to fewer rows of the same meaning, for groups that have no bound.
    """

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*waiting, batch]).combine_chunks()
            starts = _starts(table, keys)
            last = int(starts[-1])
            if last:
                yield from work(table.slice(0, last), starts[:-1])
            rest = table.slice(last)
            waiting = (shrink(rest) if shrink is not None else rest).combine_chunks().to_batches()
        if waiting:
            yield from work(pa.Table.from_batches(waiting).combine_chunks(), np.zeros(1, np.int64))

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for key in keys:
        codes = np.asarray(table.column(key).combine_chunks().dictionary_encode(null_encoding="encode").indices)
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def column(table: pa.Table, key: str) -> pa.Array:
    """A column of a table as one array."""
    chunks = table.column(key)
    return chunks.combine_chunks() if chunks.num_chunks != 1 else chunks.chunk(0)
