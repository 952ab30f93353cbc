"""Substring dedup by seed and extend.

Seeds are winnowed anchors: of the ``seed``-word runs inside a window of ``min_words`` words, the one with the
least hash (the leftmost of equals). An anchor depends on the window's words alone, so equal windows have equal
anchors, and each window belongs to one anchor of its text. Anchors that occur once can't lie in a repeat. The
others are extended both ways:

* to the whole span of the windows they own. If all occurrences of an anchor have the same span, all those
  windows are repeated; inside copies and shared passages this settles nearly everything;
* where spans differ (at the ends of repeats and at edits), by one window after the other.

Adjacent repeated windows make up the maximal repeats. Counting is by anchor and extension together, 128 bits,
with partial sums in the map tasks: no pairs of a group are made, and a group of any size is never in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebars.llm.common import (
    Rolling, as_bytes, bounded_batches, by_batch, dealt_join, mixed, packed, unpacked, word_hashes,
)
from tidebars.session import stage

SEED_WORDS = 12


def _owned(codes: np.ndarray, min_words: int, seed: int) -> tuple[Rolling, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The text's hashes and, per anchor: its hash, place, first window, number of windows."""
    rolling = Rolling(codes)
    grams = rolling.all(seed)
    reach = min_words - seed + 1
    least = np.lib.stride_tricks.sliding_window_view(grams, reach).argmin(axis=1) + np.arange(len(grams) - reach + 1)
    first = np.flatnonzero(np.diff(least, prepend=-1))
    count = np.diff(first, append=len(least))
    return rolling, grams[least[first]], least[first], first, count


def _anchors(min_words: int, seed: int):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        parts = []
        for rid, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
            words = text.split()
            if len(words) < min_words:
                continue
            rolling, anchor, place, first, count = _owned(word_hashes(words), min_words, seed)
            span = rolling.of(first, count + (min_words - 1))
            span = mixed(span ^ ((place - first) * 65_537 + count).astype(np.uint64))
            parts.append((np.full(len(first), rid), first, count, anchor.view(np.int64), span.view(np.int64)))
        if not parts:
            return None
        rid, first, count, anchor, span = (np.concatenate(x) for x in zip(*parts))
        return pa.RecordBatch.from_arrays(
            [pa.array(rid), pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(anchor), pa.array(span)],
            names=["rid", "first", "n", "anchor", "span"],
        )

    return by_batch(work)


def _windows(min_words: int, seed: int):
    """Every window of the anchors listed in ``firsts``, with its anchor's hash."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        parts = []
        columns = batch.column("rid").to_pylist(), as_bytes(batch.column("text")), batch.column("firsts").to_pylist()
        for rid, text, firsts in zip(*columns):
            rolling, anchor, _, first, count = _owned(word_hashes(text.split()), min_words, seed)
            pick = np.isin(first, firsts)
            at, n = first[pick], count[pick]
            start = np.repeat(at - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            parts.append((np.full(len(start), rid), start, np.repeat(anchor[pick], n).view(np.int64),
                          rolling.of(start, min_words).view(np.int64)))
        if not parts:
            return None
        rid, start, anchor, window = (np.concatenate(x) for x in zip(*parts))
        return pa.RecordBatch.from_arrays(
            [pa.array(rid), pa.array(start.astype(np.int32)), pa.array(anchor), pa.array(window)],
            names=["rid", "first", "anchor", "window"],
        )

    return by_batch(work)


def _cut(min_words: int):
    """Texts without the words under repeated windows."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, n_words, n_removed = [], [], []
        runs = batch.column("runs")
        offsets = np.asarray(runs.offsets).tolist()
        first, n = (np.asarray(runs.values.field(c)).astype(np.int64) for c in ("first", "n"))
        for text, a, b in zip(as_bytes(batch.column("text")), offsets, offsets[1:]):
            words = text.split()
            n_words.append(len(words))
            if a < b:
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, first[a:b], 1)
                np.add.at(edge, first[a:b] + n[a:b] + (min_words - 1), -1)
                keep = np.cumsum(edge)[:-1] == 0
                n_removed.append(len(words) - int(keep.sum()))
                words = [words[i] for i in np.flatnonzero(keep)]
            else:
                n_removed.append(0)
            kept.append(b" ".join(words))
        return pa.RecordBatch.from_arrays(
            [batch.column("rid"), batch.column("row"), batch.column("text"), pa.array(kept, pa.binary()).cast(pa.string()),
             pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())],
            names=["rid", "row", "text", "kept", "n_words", "n_removed"],
        )

    return by_batch(work)


def repeated_runs(docs: DataFrame, min_words: int, seed: int = SEED_WORDS) -> DataFrame:
    """``rid, first, n``: ``n`` repeated windows of the text from word ``first`` on. ``docs``: ``rid, row, text``.

    The texts of open ends are taken with all columns, so that the engine deals ``docs`` out by ``rid`` once for this and
    for the final cut.
    """
    anchors = stage(docs.select("rid", "text").mapInArrow(
        _anchors(min_words, seed), "rid bigint, first int, n int, anchor bigint, span bigint"))
    seen = anchors.groupBy("anchor").agg(
        F.count("*").alias("times"), F.min("span").alias("low"), F.max("span").alias("high"))
    seen = seen.where("times > 1").select("anchor", (F.col("low") != F.col("high")).alias("differ"))
    found = stage(dealt_join(anchors.select("rid", "first", "n", "anchor"), seen, ["anchor"]).select("rid", "first", "n", "differ"))
    open_ends = found.where("differ").groupBy("rid").agg(F.collect_list("first").alias("firsts"))
    windows = docs.join(open_ends, "rid").select("rid", "row", "text", "firsts").mapInArrow(
        _windows(min_words, seed), "rid bigint, first int, anchor bigint, window bigint")
    often = windows.groupBy("anchor", "window").agg(F.count("*").alias("times")).where("times > 1").drop("times")
    ends = dealt_join(windows, often, ["anchor", "window"]).select("rid", "first", F.lit(1).alias("n"))
    return found.where("not differ").select("rid", "first", "n").unionByName(ends)


def dedup_substrings(docs: DataFrame, text_col: str = "text", min_words: int = 35, seed: int = SEED_WORDS) -> DataFrame:
    """All columns of ``docs`` in ``row`` and ``text``, with ``kept`` (the words left, by one space), ``n_words``, ``n_removed``.

    A word is removed if it lies in a run of ``min_words`` words that also starts at another place of any
    row's text, the same row included. Words are separated by ASCII white space and compared byte by byte.

    Each row is a document of its own: repeated rows remove each other, whatever their ids, nulls included.
    Null and empty texts have no words; ``kept`` is then empty. Texts under ``min_words`` words stay whole. An
    empty table gives an empty result. Columns of any other name pass through in ``row``.
    """
    if not 0 < seed <= min_words:
        raise ValueError("seed must lie between 1 and min_words")
    bounded_batches(docs.sparkSession)
    rows = packed(docs, text_col).withColumnRenamed("c0", "text").withColumn("text", F.col("text").cast("string"))
    rows = rows.select("rid", "row", "text")
    runs = repeated_runs(rows, min_words, seed)
    runs = runs.groupBy("rid").agg(F.collect_list(F.struct("first", "n")).alias("runs"))
    schema = rows.schema
    joined = rows.join(runs, "rid", "left").select("rid", "row", "text", "runs")
    return joined.mapInArrow(
        _cut(min_words),
        f"rid bigint, row {schema['row'].dataType.simpleString()}, text string, kept string, n_words bigint, n_removed bigint",
    )


def without_repeats(docs: DataFrame, text_col: str = "text", min_words: int = 35) -> DataFrame:
    """``docs`` with repeated passages cut out; rows without any keep their text as it is. No row goes."""
    out = dedup_substrings(docs, text_col, min_words)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    return unpacked(out, docs.columns, **{text_col: text})
