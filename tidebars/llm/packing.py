"""Order-preserving packing by dynamic programming.

The documents of a task, each with its end id, form one stream of ids. Windows of at most ``size`` ids are cut from
it at document ends (free), sentence ends (a small penalty) or, where a sentence is long, inside it (a large
one). The least total of padding and penalties up to a cut point ``j`` is

    cost[j] = penalty[j] + min over i: cost[i] + size - (P[j] - P[i]),  P[j] - P[i] <= size

The minimum of ``cost[i] + P[i]`` over the sliding window is kept in a monotone queue. Lengths that are a power of
two need no padding; these few transitions are looked up by position. Documents stay in the order they are stored.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebars.llm.common import bounded_batches, name, tidy
from tidebars.llm.tokens import encoder

SENTENCE_COST, INSIDE_COST = 4.0, 64.0
GRAIN = 32  # of the sentence ends in a stretch of so many ids, one is a cut point
SHORT = 256  # the shortest window of a power of two before the end of a stream
STREAM = 1 << 19  # ids that are cut at once


def cut_points(total: int, ends: np.ndarray, sentences: np.ndarray, size: int) -> tuple[list[int], list[float]]:
    """Cut points of a stream in order, 0 first, with their penalties. ``ends``: of documents, ``sentences``: of sentences."""
    step = min(GRAIN, size)
    sentences = sentences[np.append(np.diff(sentences // GRAIN) > 0, True)[:len(sentences)]]
    cost = np.full(total + 1, np.inf)
    cost[sentences] = SENTENCE_COST
    cost[0] = 0
    cost[ends] = 0
    at = np.flatnonzero(cost < np.inf)
    gaps = np.flatnonzero(np.diff(at, append=total) > min(4 * GRAIN, size))
    for g in gaps.tolist():
        stop = int(at[g + 1]) if g + 1 < len(at) else total
        inside = np.arange(int(at[g]) + step, stop, step)
        cost[inside] = INSIDE_COST
    cost[total] = min(cost[total], INSIDE_COST)
    at = np.flatnonzero(cost < np.inf)
    return at.tolist(), cost[at].tolist()


def best_cuts(points: list[int], penalty: list[float], size: int, last: bool) -> list[int]:
    """Places in ``points`` of the best cuts, 0 first. Unless ``last``, the final one may lie up to a window before the end."""
    n = len(points)
    cost, origin = [0.0] * n, [0] * n
    queue = deque([0])
    keys = [float(points[0])] + [0.0] * (n - 1)
    place = {points[0]: 0}
    powers = [p for p in (1 << k for k in range(size.bit_length())) if SHORT <= p < size]
    for j in range(1, n):
        p = points[j]
        while points[queue[0]] < p - size:
            queue.popleft()
        i = queue[0]
        best = keys[i] + size - p
        for length in powers:
            k = place.get(p - length)
            if k is not None and cost[k] < best:
                best, i = cost[k], k
        cost[j], origin[j] = best + penalty[j], i
        key = keys[j] = cost[j] + p
        while queue and keys[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
        place[p] = j
    j = n - 1
    if not last:
        j = min((i for i in range(1, n) if points[i] > points[-1] - size), key=lambda i: (cost[i], -i))
    cuts = [j]
    while j:
        j = origin[j]
        cuts.append(j)
    return cuts[::-1]


class _Stream:
    """The ids not yet packed, and the documents they belong to."""

    def __init__(self, size: int, end: int):
        self.size, self.end, self.sequence = size, end, TaskContext.get().partitionId() << 32
        self.keys: list = []
        self.whole: list[int] = []  # ids of each document
        self.left: list[int] = []  # those not yet packed
        self.parts: list[np.ndarray] = []
        self.stops: list[np.ndarray] = []
        self.total = 0

    def add(self, key, ids: np.ndarray, stops: np.ndarray) -> None:
        self.keys.append(key)
        self.whole.append(len(ids))
        self.left.append(len(ids))
        self.parts.append(ids)
        self.stops.append(stops + self.total)
        self.total += len(ids)

    def pack(self, last: bool) -> list[tuple]:
        """Rows (document's key, start, length, crc, ids of the document, sequence, offset, ids) of the windows cut."""
        ids = np.concatenate(self.parts).astype("<u4")
        ends = np.cumsum(self.left)
        stops = np.concatenate(self.stops)
        points, penalty = cut_points(self.total, ends, stops, self.size)
        cuts = [points[c] for c in best_cuts(points, penalty, self.size, last)]
        if last:  # what is left over fills windows of powers of two
            tail = cuts.pop()
            tail -= cuts[-1]
            while tail:
                length = min(self.size, 1 << (tail.bit_length() - 1))
                cuts.append(cuts[-1] + length)
                tail -= length
        rows, doc, begun = [], 0, 0  # begun: where the document's unpacked ids begin
        for a, b in zip(cuts, cuts[1:]):
            at = a
            while at < b:
                stop = min(b, int(ends[doc]))
                start = self.whole[doc] - self.left[doc] + at - begun
                piece = ids[at:stop]
                rows.append((self.keys[doc], start, stop - at, zlib.crc32(piece), self.whole[doc], self.sequence, at - a, piece))
                at = stop
                if stop == ends[doc]:
                    doc, begun = doc + 1, stop
            self.sequence += 1
        cut = cuts[-1]
        self.keys, self.whole, left = self.keys[doc:], self.whole[doc:], self.left[doc:]
        if left:
            left[0] -= cut - begun
        self.left, self.parts, self.stops = left, [ids[cut:]], [stops[stops > cut] - cut]
        self.total -= cut
        return rows


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = 4096,
                   end: int = 2, with_ids: bool = False) -> DataFrame:
    """Pieces of documents in sequences: ``id, start, length, ids_crc32, doc_tokens, sequence_id, offset``, and ``ids`` if asked for.

    Every id lies in exactly one piece. Sequences follow the stored order of documents inside a task and never cross tasks;
    a sequence is padded to ``size`` unless its length is a power of two, and the end of a task's stream is cut into such
    lengths. A task keeps ``STREAM`` ids and one document. No shuffle.

    Null and empty texts are the end id alone; null ids and repeated rows are packed like any others. Texts longer than
    ``size`` run over several sequences. An empty table gives no rows. Other columns are not read.
    """
    bounded_batches(docs.sparkSession, 3)  # as arrays of words and ids a batch is much larger
    rows = docs.select(name(id_col).alias("id"), name(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    @tidy
    def work(batches):
        stream = _Stream(size, end)

        def out(last: bool) -> pa.RecordBatch:
            columns = list(zip(*stream.pack(last)))
            arrays = [pa.array(columns[0], key_type), *(pa.array(c, pa.int64()) for c in columns[1:7])]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                arrays.append(pa.array([p.astype(np.int32) for p in columns[7]], pa.list_(pa.int32())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names=names)

        with encoder(tokenizer) as texts:
            for batch in batches:
                key_type = batch.column(0).type
                for key, (ids, stops) in zip(batch.column(0).to_pylist(), texts.ids(batch.column(1), end)):
                    stream.add(key, ids, stops)
                    if stream.total >= STREAM:
                        yield out(False)
            if stream.total:
                yield out(True)

    schema = f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return rows.mapInArrow(work, schema + (", ids array<int>" if with_ids else ""))
