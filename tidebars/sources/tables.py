"""Table maintenance on Parquet: create, append, add and drop columns, keys."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebars.session import only_row, stage


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def with_month(df: DataFrame, ts: str = "date_time") -> DataFrame:
    """Add the year-month partition column."""
    return df.withColumn("ym", F.date_format(ts, "yyyy-MM"))


def create_table(spark: SparkSession, path: str, schema: T.StructType, partitions: tuple[str, ...] = ()) -> None:
    """Create an empty table if there is none."""
    if not _exists(spark, path):
        spark.createDataFrame([], schema).write.partitionBy(*partitions).parquet(path)


def read_fixed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Append bars, one folder per symbol and month, with few files in each."""
    with_month(df).repartition("symbol", "ym").write.mode("append").partitionBy("symbol", "ym").parquet(path)


def new_rows(df: DataFrame, stored: DataFrame, keys: tuple[str, ...] = ("symbol", "date_time")) -> DataFrame:
    """Rows whose key is not stored yet.

    Only stored rows of the months at hand are read: the month list of the new
    rows is a handful of values, and prunes folders.
    """
    months = [r[0] for r in with_month(df).select("ym").distinct().collect()]
    if "ym" in stored.columns:
        stored = stored.filter(F.col("ym").isin(months))
    return df.join(stored.select(*keys), list(keys), "left_anti")


def stored_rows(spark: SparkSession, path: str, like: T.StructType) -> DataFrame | None:
    """The bar table at ``path`` under the columns of ``like``; None if there is none.

    The schema is given, so a table without a single file reads as empty.
    """
    if not _exists(spark, path):
        return None
    schema = like if "ym" in like.fieldNames() else T.StructType([*like.fields, T.StructField("ym", T.StringType())])
    return spark.read.schema(schema).parquet(path)


def append_new(df: DataFrame, path: str) -> None:
    """Append only what is not there, one row per key: running it twice adds nothing.

    The batch is written once to the shared folder, as both the months and the rows come from it.
    """
    df = stage(df.dropDuplicates(["symbol", "date_time"]))
    stored = stored_rows(df.sparkSession, path, df.schema)
    append_rows(df if stored is None else new_rows(df, stored), path)


def add_column(df: DataFrame, name: str, kind: str) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))


def rewrite(path: str, spark: SparkSession, change) -> DataFrame:
    """Write ``change(table)`` as the next version and make it the table at ``path``.

    The new version is complete before it takes the place of the old one, which is then deleted.
    """
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    after, before = f"{path}.next-{uuid.uuid4().hex}", f"{path}.last-{uuid.uuid4().hex}"
    table = change(spark.read.parquet(path))
    keys = [c for c in ("symbol", "ym") if c in table.columns and "ym" in table.columns]
    table.write.partitionBy(*keys).parquet(after)
    if not (fs.rename(hadoop_path(path), hadoop_path(before)) and fs.rename(hadoop_path(after), hadoop_path(path))):
        raise OSError(f"{path} can't be replaced")
    fs.delete(hadoop_path(before), True)
    return spark.read.schema(table.schema).parquet(path)


def truncate_table(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` without rows; its columns stay."""
    return rewrite(path, spark, lambda t: t.limit(0))


def drop_column(spark: SparkSession, path: str, *names: str) -> DataFrame:
    """The table at ``path`` without the columns; those it hasn't are no error."""
    return rewrite(path, spark, lambda t: t.drop(*names))


def drop_table(spark: SparkSession, path: str) -> bool:
    """Delete the table; False if there is none."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def surrogate_key(
    df: DataFrame, name: str, start: int = 1, order: str = "date_time", within: str = "symbol", stored: DataFrame | None = None
) -> DataFrame:
    """Consecutive keys in the order ``(order, within)``, from ``start`` or after the stored ones; nulls come first.

    The rows are sorted into partitions of equal size and numbered inside each; the counts of the partitions, one
    number each, become offsets.  No task sees more than a partition, however many rows share a time.
    """
    if stored is not None:
        last = only_row(stored.agg(F.max(name)))[0]
        start = start if last is None else last + 1
    placed = stage(df.repartitionByRange(order, within).withColumn("_part", F.spark_partition_id()))
    counts = sorted(placed.groupBy("_part").count().collect())
    offsets, at = [], start
    for part, n in counts:
        offsets.append((part, at))
        at += n
    table = df.sparkSession.createDataFrame(offsets, "_part int, _offset bigint")
    inside = Window.partitionBy("_part").orderBy(order, within)
    return (
        placed.join(F.broadcast(table), "_part")  # a row per partition of the sort
        .withColumn(name, F.col("_offset") + F.row_number().over(inside) - 1)
        .drop("_part", "_offset")
    )
