"""Session helpers: building a session, cutting lineage, reading one-row results."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, Row, SparkSession


def build_session(app: str = "tidebars", cores: str = "*") -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.cache.maxEntries", "2000")  # wide window plans compile many small classes
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    ``spark.checkpoint.dir`` names it.  A session on one machine may do without and gets a local one; on a
    cluster a local folder would lose data, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("tidebars.shared.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach")
        folder = tempfile.mkdtemp(prefix="tidebars-")
        spark.conf.set("tidebars.shared.dir", folder)
    return folder


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where a result feeds several branches: the branches then scan a
    pruned columnar table instead of repeating everything upstream, and a
    lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"stage-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint; unlike :func:`stage` it keeps partitioning and order."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def only_row(df: DataFrame) -> Row:
    """The single row of an ungrouped aggregate."""
    return df.first()
