"""Helpers of several operators: rows without name clashes, Arrow batches, word hashes, code tables."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebars.session import stage

#: Odd multiplier of the rolling word hash, and the multipliers of its finaliser (fixed values of SplitMix64).
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def name(column: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + column.replace("`", "``") + "`")


def _plain_scan(df: DataFrame) -> bool:
    """Whether ``df`` has rows of Parquet files, each once at most, and tells their places."""
    node = df._jdf.queryExecution().analyzed() if hasattr(df, "_jdf") else None
    while node is not None and node.nodeName() in ("Project", "Filter", "SubqueryAlias") and node.deterministic():
        node = node.child()
    if node is None or node.nodeName() != "LogicalRelation" or "_metadata" in df.columns:
        return False
    try:
        df.select("_metadata.row_index").schema  # Parquet files have it
    except AnalysisException:
        return False
    return True


HOME_BITS, HOME_BUCKET = 62, 42  # of the number of a file's first row; of it, those below the bucket in which it is compared


def _numbers_clash(df: DataFrame) -> bool:
    """Whether the row numbers of two files of a plain scan overlap.

    A file's numbers are an interval from a hash of its path on; intervals are compared within buckets of the hash, of which
    each holds few files however many there are. Only the files' row counts are read.
    """
    first = F.xxhash64("path").bitwiseAND(F.lit((1 << HOME_BITS) - 1))
    files = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("place")).groupBy("path").agg(
        F.max("place").alias("last")).select(F.struct(first.alias("a"), (first + F.col("last")).alias("b")).alias("own"))
    bucket = F.explode(F.array_distinct(F.array(F.shiftright("own.a", HOME_BUCKET), F.shiftright("own.b", HOME_BUCKET))))
    listed = files.withColumn("bucket", bucket).groupBy("bucket").agg(F.sort_array(F.collect_list("own")).alias("own")).where(F.size("own") > 1)
    pairs = F.zip_with(F.slice("own", F.lit(1), F.size("own") - 1), F.slice("own", F.lit(2), F.size("own") - 1), lambda x, y: x["b"] >= y["a"])
    return not listed.where(F.exists(pairs, lambda x: x)).isEmpty()


def packed(df: DataFrame, *apart: str, numbered: bool = True) -> DataFrame:
    """Rows as ``row`` (struct of all columns but ``apart``) and ``rid``, a number of the row; ``apart`` as ``c0``, ``c1`` ...

    No column of the input can then clash with a working column. A row keeps its number in every job, however its table is
    split: in a plain scan of Parquet files the number is a hash of its file's path plus its place in the file, anything else
    (and files whose numbers would overlap) is numbered once and staged. Not ``numbered``: without ``rid``.
    """
    rest = [name(c).alias(c) for c in df.columns if c not in apart]
    columns = [F.struct(*(rest or [F.lit(0).alias("_")])).alias("row"), *[name(c).alias(f"c{i}") for i, c in enumerate(apart)]]
    if not numbered:
        return df.select(*columns)
    if not _plain_scan(df) or _numbers_clash(df):
        return stage(df.select(F.monotonically_increasing_id().alias("rid"), *columns))
    home = F.xxhash64("_metadata.file_path").bitwiseAND(F.lit((1 << HOME_BITS) - 1))
    never = F.lit(-1).cast("bigint")  # numbers can't be null: joins then filter no side, and the engine shares exchanges
    return df.select(F.coalesce(home + F.col("_metadata.row_index"), never).alias("rid"), *columns)


def unpacked(df: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of the input again, in their order, those in ``changed`` from the given expressions."""
    return df.select(*[
        (changed[c] if c in changed else F.col("row").getField(c)).alias(c) for c in columns
    ])


def bounded_batches(spark: SparkSession, megabytes: int = 8) -> None:
    """Limit Arrow batches by bytes, so that a run of long texts doesn't fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(megabytes << 20))


def as_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """Texts of an Arrow column as UTF-8; null is empty."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return [x or b"" for x in column.to_pylist()]


def dealt_join(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Rows joined with an aggregate by ``keys`` (long or text), which may be hot in ``rows``.

    Joined by the keys themselves, the aggregate would keep its partitions and the engine could not split those of
    ``rows``. By their complements (texts: reversed) both sides are dealt out for the join alone, and large partitions are split.
    """
    turned = {k: F.reverse if rows.schema[k].dataType.simpleString() == "string" else F.bitwise_not for k in keys}
    other = groups.select(*[turned[k](F.col(k)).alias(f"not_{k}") for k in keys], *[c for c in groups.columns if c not in keys])
    on = [turned[k](rows[k]) == other[f"not_{k}"] for k in keys]
    return rows.join(other, on).drop(*[f"not_{k}" for k in keys])


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Different words of a text column (null: empty), the number of each word in order, and where each text begins.

    Words are set apart by ASCII white space; an empty one stands where a text begins or ends with it.
    """
    split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    known = split.flatten().dictionary_encode()
    return known.dictionary, np.asarray(known.indices), np.asarray(split.offsets) - split.offsets[0].as_py()


def by_batch(work: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable:
    """A function for ``mapInArrow`` from one that maps a single batch."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = work(batch)
            if out is not None and out.num_rows:
                yield out

    return run


def tidy(work: Callable) -> Callable:
    """A function for ``mapInArrow`` that gives freed memory back when it ends, as the worker lives on for other stages.

    Functions that came by value refer to their own globals and back; what the task before left waits for the collector.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.collect()
        try:
            yield from work(batches)
        finally:
            forget_powers()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim is not None:
                trim(0)

    return run


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def forget_powers() -> None:
    """Give the memory of the powers back; the next text makes them again."""
    _POWERS[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, 0 to n; kept between calls of a task."""
    if len(_POWERS[0]) <= n:
        size = max(1024, 2 * n)
        for i, b in enumerate((BASE, np.uint64(_inverse(int(BASE))))):
            _POWERS[i] = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, b, np.uint64))])
    return _POWERS[0], _POWERS[1]


class Rolling:
    """Hashes of any run of words of one text, from prefix sums."""

    def __init__(self, codes: np.ndarray):
        up, self.down = _powers(len(codes))
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * up[: len(codes)], out=self.sums[1:])

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return mixed((self.sums[start + length] - self.sums[start]) * self.down[start])

    def all(self, length: int) -> np.ndarray:
        """Of all runs of ``length`` words, by start."""
        n = len(self.sums) - length
        return mixed((self.sums[length:] - self.sums[:n]) * self.down[:n])


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


PIECE = 4096  # new words that ``make`` gets at once


class CodeTable:
    """Numbers words as they come and keeps, for each, a run of values from ``make``.

    ``make`` gets a list of new words and returns a list of value lists (integers). ``trim``, called between batches, forgets
    everything once there are over ``limit`` words; the table only saves repeated work.
    """

    class _Index(dict):
        def __missing__(self, word):
            self[word] = n = len(self)
            return n

    def __init__(self, make: Callable[[list[bytes]], list[list[int]]], limit: int = 200_000, dtype=np.uint32):
        self.make, self.limit, self.dtype = make, limit, dtype
        self.clear()

    def clear(self) -> None:
        self.index = self._Index()
        self.values = np.zeros(0, self.dtype)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)

    def trim(self) -> None:
        if len(self.index) > self.limit:
            self.clear()

    def codes(self, texts: list[list]) -> list[np.ndarray]:
        """Word numbers of each text; the tables cover them all afterwards."""
        old = len(self.index)
        at = self.index.__getitem__  # numbers new words
        out = [np.fromiter(map(at, words), np.int64, len(words)) for words in texts]
        if len(self.index) > old:
            new = self._last(len(self.index) - old)
            values, lengths = [self.values], [self.length]
            for at in range(0, len(new), PIECE):
                made = self.make(new[at:at + PIECE])
                length = np.fromiter(map(len, made), np.int64, len(made))
                values.append(np.fromiter((v for m in made for v in m), self.dtype, int(length.sum())))
                lengths.append(length)
            self.values, self.length = np.concatenate(values), np.concatenate(lengths)
            self.start = np.cumsum(self.length) - self.length
        return out

    def _last(self, n: int) -> list[bytes]:
        """The ``n`` words added last, in order."""
        keys = reversed(self.index)
        return [next(keys) for _ in range(n)][::-1]

    def spread(self, codes: np.ndarray) -> np.ndarray:
        """The values of a text's words in a row."""
        length = self.length[codes]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        return self.values[np.repeat(self.start[codes] - (ends - length), length) + np.arange(total)]
