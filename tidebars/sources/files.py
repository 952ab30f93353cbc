"""Reading and writing bar tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebars.functions import schemas
from tidebars.functions.scalar import epoch_to_timestamp, parse_datetime


def read_bars_tsv(spark: SparkSession, path: str, symbol: str | None = None) -> DataFrame:
    """Tab-separated exports with a header line, as text columns.

    ``path`` may name many files; the symbol is then the leading letters of the
    file name.
    """
    raw = spark.read.csv(path, sep="\t", header=True, schema=schemas.BARS_TSV, mode="PERMISSIVE", enforceSchema=True)
    name = F.lit(symbol) if symbol else F.upper(F.regexp_extract(F.input_file_name(), r"([A-Za-z]+)[^/]*$", 1))
    return raw.withColumn("symbol", name)


def type_bars(raw: DataFrame, cutoff: str | None = None) -> DataFrame:
    """Typed bars from text bars: one timestamp, double prices, whole volumes.

    ``cutoff`` keeps bars strictly before it.
    """
    typed = raw.select(
        "symbol",
        parse_datetime("date", "time").alias("date_time"),
        *[F.col(c).try_cast("double").alias(c) for c in ("open", "high", "low", "close")],
        F.col("tick_vol").try_cast("int").alias("tick_vol"),
        F.col("vol").try_cast("bigint").alias("vol"),
        F.col("spread").try_cast("int").alias("spread"),
    )
    return filter_before(typed, cutoff) if cutoff else typed


def read_rates(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """Landed broker batches (Parquet, epoch seconds) of a closed time range."""
    raw = spark.read.schema(schemas.RATES).parquet(path)
    return rates_to_bars(raw.filter(F.col("time").between(start, stop)))


def rates_to_bars(raw: DataFrame) -> DataFrame:
    """Broker columns under the names of the bar table."""
    bars = raw.drop("spread", "real_volume").withColumn("time", epoch_to_timestamp("time"))
    return bars.withColumnsRenamed({"time": "date_time", "tick_volume": "tick_vol"})


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_jdbc(
    spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int, **options: str
) -> DataFrame:
    """A database table read in ``parts`` key ranges, one task each."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=key, lowerBound=low, upperBound=high, numPartitions=parts
    )
    return reader.options(**options).load()


def read_features_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A saved feature file: ``date_time`` and double columns, fixed schema."""
    fields = ", ".join("date_time TIMESTAMP_NTZ" if c == "date_time" else f"`{c}` DOUBLE" for c in columns)
    return spark.read.csv(path, header=True, schema=fields)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the table at ``path``; CSV gets a header line."""
    df.write.mode("overwrite").format(fmt).options(**({"header": "true"} if fmt == "csv" else {})).save(path)


def filter_before(df: DataFrame, cutoff: str, ts: str = "date_time") -> DataFrame:
    return df.filter(F.col(ts) < F.lit(cutoff).cast("timestamp_ntz"))


def filter_after(df: DataFrame, mark: str, ts: str = "date_time") -> DataFrame:
    return df.filter(F.col(ts) > F.lit(mark).cast("timestamp_ntz"))


def slice_from(df: DataFrame, start: str, ts: str = "date_time") -> DataFrame:
    return df.filter(F.col(ts) >= F.lit(start).cast("timestamp_ntz"))


def point_lookup(df: DataFrame, at: str, *columns: str, ts: str = "date_time") -> DataFrame:
    return df.filter(F.col(ts) == F.lit(at).cast("timestamp_ntz")).select(*columns)


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Drop columns; names that are absent are ignored."""
    return df.drop(*columns)


def rename_by_position(df: DataFrame, names: list[str]) -> DataFrame:
    return df.toDF(*names)


def exclude_columns(df: DataFrame, *columns: str) -> list[str]:
    return [c for c in df.columns if c not in columns]


def fill_zero(df: DataFrame, *columns: str) -> DataFrame:
    return df.na.fill(0, list(columns) or None)


def dedup_bars(df: DataFrame, newest: str, keys: tuple[str, ...] = ("symbol", "date_time")) -> DataFrame:
    """The copy of each bar with the greatest ``newest`` (and then the greatest values).

    An aggregate, not a window: many copies of one bar shrink before the shuffle.
    """
    rest = [newest] + [c for c in df.columns if c not in keys and c != newest]
    best = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_best"))
    return best.select(*[c if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def dense_columns(df: DataFrame, columns: list[str], more_than: int) -> list[str]:
    """Names of the columns with more than ``more_than`` values (one aggregate)."""
    row = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    return [c for c in columns if row[c] > more_than]


def is_not_empty(df: DataFrame) -> bool:
    return not df.isEmpty()
