"""WARC archives with an index written first-hand, and coalesced byte-range reads.

Every record is a gzip member of its own. As a record is written, its file, offset, length, URL and payload digest go
to an index table; a reader selects rows there, sorts them by file and offset, joins neighbouring ranges to one read
and parses only the selected records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebars.llm.common import as_bytes, bounded_batches, dealt_join, name, tidy
from tidebars.llm.tokens import WholeFile, file_system, new_folder
from tidebars.session import stage

FILE_BYTES = 1 << 30  # a file is closed once it is larger
SPAN = 16 << 20  # bytes of a file that a task reads
READ_BYTES, GAP = 8 << 20, 64 << 10  # the largest joined read, and the hole it may hold
DATE = "1970-01-01T00:00:00Z"  # pages carry no date
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_INDEX = pa.schema([
    ("uri", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()), ("digest", pa.string()),
    ("record_type", pa.string())])


def record(key: str | None, url: str | None, payload: bytes, refers_to: str | None = None, revisit: bool = False) -> tuple[bytes, str]:
    """A record's bytes before compression, and the digest of its payload. A revisit has the HTTP head alone."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = ["WARC/1.1", "WARC-Type: " + ("revisit" if revisit else "response"), f"WARC-Record-ID: {urn(key)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url))
    lines.append("WARC-Payload-Digest: sha1:" + digest)
    if revisit:
        lines += [f"WARC-Refers-To: {urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", digest


def urn(key: str | None) -> str:
    return "<urn:page:>" if key is None else f"<urn:page:id:{quote(key, safe='')}>"


def key_of(value: str | None) -> str | None:
    return unquote(value[len("<urn:page:id:"):-1]) if value and value.startswith("<urn:page:id:") else None


def parse(data: bytes) -> dict:
    """A record's fields, its payload checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != digest or len(payload) != size:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return {"key": key_of(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload": payload, "size": size,
            "digest": digest, "type": kind, "refers_to": key_of(fields.get("WARC-Refers-To"))}


def _gzip(data: bytes) -> bytes:
    squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def write_warc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0,
               folder: str | None = None) -> DataFrame:
    """Write one record per row; the index ``uri, offset, length, url, digest, record_type``, one row per record.

    Of rows with equal payloads of at least ``min_bytes`` bytes those of the largest id are responses and the others revisit it;
    smaller payloads are all responses. Null and empty html is an empty payload. A null id is under any other; where all ids are
    null all are responses. Repeated rows of the largest id are all responses. A null URL has no header. An empty table
    writes no files. Copies are counted by digest with partial sums, and a hot digest's rows are split over tasks.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    folder = folder or new_folder(spark, "warc")
    rows = pages.select(
        name(id_col).alias("id"), name(url_col).cast("string").alias("url"), F.coalesce(name(html_col).cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    top = rows.groupBy("sha").agg(F.max("id").alias("top"))
    revisit = (F.octet_length("html") >= min_bytes) & F.col("top").isNotNull() & ~F.col("id").eqNullSafe(F.col("top"))
    rows = dealt_join(rows, top, ["sha"]).select(
        F.col("id").cast("string").alias("id"), "url", "html", F.when(revisit, F.col("top").cast("string")).alias("top"), revisit.alias("revisit"))

    @tidy
    def work(batches):
        # an attempt has files of its own: another one's index rows never point into them
        part, n, out = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}", 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            lines = []
            columns = [batch.column(i).to_pylist() for i in (0, 1, 3, 4)]
            for key, url, top, again, html in zip(*columns, as_bytes(batch.column(2))):
                if out is None or out.size >= FILE_BYTES:
                    if out:
                        out.close()
                    out, n = WholeFile(folder, f"part-{part}-{n:04d}.warc.gz"), n + 1
                data, digest = record(key, url, html, top, again)
                packed = _gzip(data)
                lines.append((out.uri, out.write(packed), len(packed), url, digest, "revisit" if again else "response"))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*lines), _INDEX)], schema=_INDEX)
        if out:
            out.close()

    return stage(rows.mapInArrow(work, "uri string, offset bigint, length bigint, url string, digest string, record_type string"))


def read_warc(index: DataFrame, kind: str = "bigint", payloads: bool = True) -> DataFrame:
    """The records of the given index rows, read back: ``id`` and ``refers_to`` (of SQL type ``kind``), ``url``, ``payload_bytes``,
    ``payload_digest``, ``record_type`` and, if asked for, ``payload`` (empty for revisits).

    A damaged record raises an error. No index rows give no records.
    """
    rows = index.select("uri", "offset", "length").withColumn("span", F.floor(F.col("offset") / SPAN))
    total = rows.agg(F.sum("length")).first()[0] or 0
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-total // SPAN))  # by bytes, not by rows of the index
    rows = rows.repartition(tasks, "uri", "span").sortWithinPartitions("uri", "offset").select("uri", "offset", "length")

    def ranges(batches):
        """Runs of neighbouring records: file, and (offset, length) of each."""
        uri, run = None, []
        for batch in batches:
            for u, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if run and (u != uri or offset + length - run[0][0] > READ_BYTES or offset - sum(run[-1]) > GAP):
                    yield uri, run
                    run = []
                uri = u
                run.append((offset, length))
        if run:
            yield uri, run

    @tidy
    def work(batches):
        opened, file = None, None
        for uri, run in ranges(batches):
            if uri != opened:
                fs, path = file_system(uri)
                opened, file = uri, fs.open_input_file(path)
            begin = run[0][0]
            data = file.read_at(sum(run[-1]) - begin, begin)
            found = [parse(zlib.decompress(data[o - begin:o - begin + n], 31)) for o, n in run]
            out = {
                "id": pa.array([r["key"] for r in found], pa.string()), "url": pa.array([r["url"] for r in found], pa.string()),
                "payload_bytes": pa.array([r["size"] for r in found], pa.int64()),
                "payload_digest": pa.array([r["digest"] for r in found], pa.string()),
                "record_type": pa.array([r["type"] for r in found], pa.string()),
                "refers_to": pa.array([r["refers_to"] for r in found], pa.string())}
            if payloads:
                out["payload"] = pa.array([r["payload"] for r in found], pa.binary())
            yield pa.RecordBatch.from_pydict(out)

    schema = "id string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string"
    out = rows.mapInArrow(work, schema + (", payload binary" if payloads else ""))
    return out.withColumns({c: F.col(c).cast(kind) for c in ("id", "refers_to")})
