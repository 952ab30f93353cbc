"""Token-id files in patched frame-of-reference blocks.

A file holds the ids of documents in ascending order of id, in blocks of 128 ids. A block stores its least id,
the offsets from it in a bit width that the ``PERCENTILE``-th part of them needs, and the few wider ones as
exceptions (place, offset). The start of every block is indexed, as are the documents, so any run of ids is read
by its own blocks alone.

    magic | blocks | block starts (u64) | documents (Arrow stream: id, start, n_tokens) | sizes (3 u64) | magic
    block: least u32 | count u16 | width u8 | exceptions u8 | packed offsets | places u8... | offsets u32...
"""

from __future__ import annotations

import io
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebars.llm.common import bounded_batches, name, tidy
from tidebars.llm.tokens import WholeFile, encoder, file_system, new_folder
from tidebars.session import stage

MAGIC = b"TBPFOR01"
BLOCK = 128
PERCENTILE = 0.95
CHUNK = 512  # blocks coded at once
READ_IDS = 1 << 20  # ids decoded at once


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """Blocks of the ids; only the last may be shorter."""
    out: list[bytes] = []
    for at in range(0, len(ids), BLOCK * CHUNK):
        part = ids[at:at + BLOCK * CHUNK].astype(np.uint32)
        n = -(-len(part) // BLOCK)
        counts = np.full(n, BLOCK)
        counts[-1] = len(part) - (n - 1) * BLOCK
        values = np.append(part, np.full(n * BLOCK - len(part), part[-1], np.uint32)).reshape(n, BLOCK)
        least = values.min(axis=1)
        offsets = values - least[:, None]
        need = np.frexp(offsets.astype(np.float64))[1].astype(np.uint8)  # bits of each offset
        width = np.partition(need, int(PERCENTILE * (BLOCK - 1)), axis=1)[:, int(PERCENTILE * (BLOCK - 1))]
        wide = need > width[:, None]
        packed: list[bytes] = [b""] * n
        for w in np.unique(width).tolist():
            if w:
                rows = np.flatnonzero(width == w)
                bits = (offsets[rows][:, :, None] >> np.arange(w, dtype=np.uint32)).astype(np.uint8) & 1
                for row, line in zip(rows.tolist(), np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little")):
                    packed[row] = line.tobytes()
        n_wide = wide.sum(axis=1)
        at_row, place = np.nonzero(wide)
        extra = offsets[at_row, place].astype("<u4")
        ends = np.cumsum(n_wide).tolist()
        place = place.astype(np.uint8)
        for row, (low, count, w, k, end) in enumerate(zip(least.tolist(), counts.tolist(), width.tolist(), n_wide.tolist(), ends)):
            block = struct.pack("<IHBB", low, count, w, k) + packed[row]
            if k:
                block += place[end - k:end].tobytes() + extra[end - k:end].tobytes()
            out.append(block)
    return out


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks of ``data`` that begin at ``starts``."""
    raw = np.frombuffer(data, np.uint8)
    starts = starts.astype(np.int64)
    head = raw[starts[:, None] + np.arange(8)]
    least, count = head[:, :4].copy().view("<u4")[:, 0], head[:, 4:6].copy().view("<u2")[:, 0]
    width, n_wide = head[:, 6].astype(np.int64), head[:, 7].astype(np.int64)
    out = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        for at in range(0, len(rows) if w else 0, CHUNK):
            own = rows[at:at + CHUNK]
            lines = raw[(starts[own] + 8)[:, None] + np.arange(w * BLOCK // 8)]
            bits = np.unpackbits(lines, axis=1, bitorder="little").reshape(len(own), BLOCK, w)
            spread = np.zeros((len(own), BLOCK, 32), np.uint8)
            spread[:, :, :w] = bits
            out[own] = np.packbits(spread, axis=2, bitorder="little").view("<u4")[:, :, 0]
    rows = np.flatnonzero(n_wide)
    if len(rows):
        k = n_wide[rows]
        row = np.repeat(rows, k)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)
        begin = np.repeat(starts[rows] + 8 + width[rows] * BLOCK // 8, k)
        place = raw[begin + nth]
        value = raw[(begin + np.repeat(k, k) + 4 * nth)[:, None] + np.arange(4)].copy().view("<u4")[:, 0]
        out[row, place] = value
    out += least[:, None]
    if (count == BLOCK).all():
        return out.ravel()
    return out[np.arange(BLOCK)[None, :] < count[:, None]]


class TokenWriter:
    """Writes one file; ids are coded as they come."""

    def __init__(self, folder: str, file: str, kind: pa.DataType):
        self.file, self.kind = WholeFile(folder, file), kind
        self.file.write(MAGIC)
        self.rest: list[np.ndarray] = []
        self.waiting = self.total = 0
        self.starts: list[int] = []
        self.keys: list = []
        self.lengths: list[int] = []

    def add(self, keys: list, lengths: list[int], ids: np.ndarray) -> None:
        """Documents with the numbers of their ids, and all their ids in a row."""
        self.keys += keys
        self.lengths += lengths
        self.rest.append(ids)
        self.waiting += len(ids)
        self.total += len(ids)
        if self.waiting >= BLOCK * CHUNK:
            self._flush(self.waiting // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.rest) if self.rest else np.zeros(0, np.uint32)
        blocks = encode_blocks(ids[:n])
        at = self.file.write(b"".join(blocks))
        self.starts += (at + np.cumsum([0, *map(len, blocks)])[:-1]).tolist()
        self.rest, self.waiting = [ids[n:]], len(ids) - n

    def close(self) -> str:
        self._flush(self.waiting)
        index = np.array(self.starts, "<u8").tobytes()
        lengths = np.array(self.lengths, np.int64)
        table = pa.table({"id": pa.array(self.keys, self.kind), "start": np.cumsum(lengths) - lengths, "n_tokens": lengths})
        sink = io.BytesIO()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        documents = sink.getvalue()
        at = self.file.write(index + documents)
        self.file.write(struct.pack("<QQQ", at, len(index), len(documents)) + MAGIC)
        return self.file.close()


class TokenFile:
    """Random access to a file: ``documents`` and ``read(start, stop)``."""

    def __init__(self, uri: str):
        fs, path = file_system(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(32, size - 32)
        if tail[24:] != MAGIC or self.file.read_at(8, 0) != MAGIC:
            raise ValueError(f"{uri} is no complete token file")
        at, n_index, n_documents = struct.unpack("<QQQ", tail[:24])
        self.starts = np.frombuffer(self.file.read_at(n_index, at), "<u8")
        self.end = at
        self.documents = pa.ipc.open_stream(self.file.read_at(n_documents, at + n_index)).read_all()

    def read(self, start: int, stop: int) -> np.ndarray:
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, -(-stop // BLOCK)
        begin = int(self.starts[first])
        end = int(self.starts[last]) if last < len(self.starts) else self.end
        ids = decode_blocks(self.file.read_at(end - begin, begin), self.starts[first:last] - np.uint64(begin))
        return ids[start - first * BLOCK: stop - first * BLOCK]


def write_token_files(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end: int = 1,
                      folder: str | None = None) -> DataFrame:
    """Encode all texts and write them in ascending order of id; one row per file: ``part, uri, n_docs, n_tokens``.

    Each document is followed by ``end``; null and empty texts hold that id alone. Null ids come first. Rows of
    equal id are all written, in the order of their texts' hash. A file name depends on the task's place alone, and a
    file appears when it is whole, so repeated tasks do no harm. An empty table gives no files. Other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    folder = folder or new_folder(spark, "tokens")
    rows = docs.select(name(id_col).alias("id"), name(text_col).cast("string").alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text")).repartitionByRange("id", "h").sortWithinPartitions("id", "h", "text")

    @tidy
    def work(batches):
        part, out = TaskContext.get().partitionId(), None
        with encoder(tokenizer) as texts:
            for batch in batches:
                if not batch.num_rows:
                    continue
                out = out or TokenWriter(folder, f"part-{part:06d}.pfor", batch.column(0).type)
                ids, first, _ = texts.batch(batch.column(1), end, sentences=False)
                out.add(batch.column(0).to_pylist(), np.diff(first).tolist(), ids)
        if out:
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "uri": out.close(), "n_docs": len(out.keys), "n_tokens": out.total}])

    return stage(rows.select("id", "text").mapInArrow(work, "part bigint, uri string, n_docs bigint, n_tokens bigint"))


def read_documents(files: DataFrame, kind: str = "bigint") -> DataFrame:
    """``id, start, n_tokens, ids_crc32`` of each document of the files; ``start`` counts the ids of all before it.

    ``kind`` is the SQL type of the ids. Only a line for each file passes the driver.
    """
    spark = files.sparkSession
    listed = files.orderBy("part").collect()
    base, rows = 0, []
    for f in listed:
        rows.append((f["part"], f["uri"], base))
        base += f["n_tokens"]
    frame = spark.createDataFrame(rows, "part int, uri string, base bigint").repartition(max(1, len(rows)), "part")

    @tidy
    def work(batches):
        for batch in batches:
            for uri, base in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                file = TokenFile(uri)
                start, n = (file.documents.column(c).to_numpy() for c in ("start", "n_tokens"))
                at = 0
                while at < len(start):  # runs of documents of about READ_IDS ids
                    to = max(at + 1, int(np.searchsorted(start + n, start[at] + READ_IDS, side="right")))
                    ids = file.read(int(start[at]), int(start[to - 1] + n[to - 1])).astype("<u4")
                    own = start[at:to] - start[at]
                    crc = [zlib.crc32(ids[s:s + k]) for s, k in zip(own.tolist(), n[at:to].tolist())]
                    keys = file.documents.column("id").slice(at, to - at).combine_chunks()
                    yield pa.RecordBatch.from_arrays(
                        [keys if isinstance(keys, pa.Array) else keys.chunk(0), pa.array(start[at:to] + base),
                         pa.array(n[at:to]), pa.array(crc, pa.int64())],
                        names=["id", "start", "n_tokens", "ids_crc32"])
                    at = to

    return frame.mapInArrow(work, f"id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_files(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end: int = 1) -> DataFrame:
    """Write all documents and read them back; see the two functions."""
    kind = docs.schema[id_col].dataType.simpleString()
    return read_documents(write_token_files(docs, tokenizer, id_col, text_col, end), kind)
