"""As-of join: for each row the newest row of another table that is not after it, key by key.

Both tables are sorted together by key and time into equal partitions, so a key with most of the rows lies in many of them.
Inside a partition the newest row so far is a running maximum; what a key brings into a partition is the maximum of its
partitions before, of which there are as many as partitions. Nothing gathers a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebars.session import stage

_KEYS, _AT, _TURN, _ROW, _SEEN, _PART = "_keys", "_at", "_turn", "_row", "_seen", "_part"


def as_of_join(
    rows: DataFrame, others: DataFrame, keys: list[str], at: str, other_at: str | None = None, exclusive: bool = False,
    within: str | None = None, suffix: str = "_asof",
) -> DataFrame:
    """``rows`` with the columns of the newest row of ``others`` of the same ``keys`` whose ``other_at`` is not after ``at``.

    ``exclusive``: it must be before.  ``within`` is an interval ("2 hours") that it may lie back at most; older ones don't count.  Of ``others`` at one
    time the one with the greatest values counts.  Rows without such a row, without a key or without a time keep NULLs; every row comes out once.
    Columns of ``others`` whose names ``rows`` has too get ``suffix``.  All columns of ``others`` must be sortable.
    """
    other_at = other_at or at
    brought = [c for c in others.columns if c not in keys]
    names = {c: c + suffix if c in rows.columns else c for c in brought}
    seen = F.struct(F.col(other_at).alias("_time"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(brought)])
    row = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(rows.columns)])
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])

    left = rows.select(key.alias(_KEYS), F.col(at).alias(_AT), F.lit(0 if exclusive else 1).alias(_TURN), row.alias(_ROW))
    right = others.select(key.alias(_KEYS), F.col(other_at).alias(_AT), F.lit(1 if exclusive else 0).alias(_TURN), seen.alias(_SEEN))
    placed = [F.col(f"{_KEYS}.k{i}").isNotNull() for i in range(len(keys))] + [F.col(_AT).isNotNull()]
    complete = placed[0]
    for test in placed[1:]:
        complete = complete & test
    both = left.filter(complete).unionByName(right.filter(complete), allowMissingColumns=True)
    order = [_KEYS, _AT, _TURN]
    sorted_ = stage(both.repartitionByRange(*order).withColumn(_PART, F.spark_partition_id()))

    before = Window.partitionBy(_KEYS).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = sorted_.groupBy(_KEYS, _PART).agg(F.max(_SEEN).alias("_last")).select(_KEYS, _PART, F.max("_last").over(before).alias("_carry"))
    inside = Window.partitionBy(_KEYS, _PART).orderBy(_AT, _TURN).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    newest = sorted_.withColumn("_own", F.max(_SEEN).over(inside)).filter(F.col(_ROW).isNotNull())
    newest = newest.join(stage(carried), [_KEYS, _PART]).select(_ROW, F.col(_AT), F.coalesce("_own", "_carry").alias("_found"))

    found = F.col("_found")
    if within is not None:
        found = F.when(F.col("_found._time") >= F.col(_AT) - F.expr(f"INTERVAL {within}"), found)
    alone = left.filter(~F.coalesce(complete, F.lit(False))).select(_ROW, _AT, F.lit(None).cast(right.schema[_SEEN].dataType).alias("_found"))
    return newest.select(_ROW, found.alias("_found")).unionByName(alone.select(_ROW, "_found")).select(
        *_fields(_ROW, rows.columns), *_fields("_found", list(names.values())))


def _fields(struct: str, names: list[str]) -> list[Column]:
    return [F.col(f"{struct}.v{i}").alias(name) for i, name in enumerate(names)]
