"""SimHash near-duplicates through a Gray-ordered hierarchical index.

Upper nodes of the index are masked bit patterns that their fingerprints share. Two fingerprints at ``d`` or
fewer differing bits agree in one of ``d + 1`` blocks of the bits still free, so a node has ``d + 1`` children
for each of its fingerprints, one for each block, and every link lies inside some child. Nodes with over
``LEAF`` fingerprints are divided again; with each level free bits vanish, so that a leaf has at most ``LEAF``
distinct fingerprints whatever the data. Inside a leaf the fingerprints are sorted by Gray rank, runs of
neighbours factor their common bits into group nodes, and a group pair is left out as soon as the differences
of its patterns add up to over ``d`` bits; the rest is compared.

Equal fingerprints are one entry throughout, so groups of copies of any size cost one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebars.llm.common import as_bytes, bounded_batches, by_batch, dealt_join, packed, unpacked
from tidebars.llm.components import components, stars
from tidebars.session import stage

LEAF = 2048
RUN = 16


def simhash(text: bytes, shingle: int = 3) -> int:
    """64 bits; a bit is 1 if it is set in over half of the shingles' XXH64 (seed 42)."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    n = len(words) - shingle + 1
    hashes = np.fromiter(
        (digest(line[s:e], 42) for s, e in zip(starts[:n].tolist(), ends[shingle - 1:].tolist())), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65_536):
        bits = np.unpackbits(hashes[at:at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(rows: DataFrame, shingle: int) -> DataFrame:
    """``rid, id, fp`` (long, the 64 bits) of rows ``rid, id, text``."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([simhash(t, shingle) for t in as_bytes(batch.column(2))], np.uint64)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found.view(np.int64))], names=["rid", "id", "fp"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("rid", "id", "text").mapInArrow(by_batch(work), f"rid bigint, id {kind}, fp bigint")


def child_masks(mask: int, bits: int) -> list[int]:
    """The masks of a node's children: its own with one of ``bits + 1`` blocks of the free bits each."""
    free = [i for i in range(64) if not mask >> i & 1]
    return [mask | sum(1 << int(i) for i in block) for block in np.array_split(np.array(free), bits + 1) if len(block)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _divide(bits: int):
    """Rows ``mask, fp`` of large nodes to those of their children."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        masks, fps = (np.asarray(batch.column(i)).view(np.uint64) for i in (0, 1))
        out = []
        for mask in np.unique(masks):
            own = fps[masks == mask]
            out += [(np.full(len(own), m, np.uint64), own) for m in child_masks(int(mask), bits)]
        mask, fp = (np.concatenate(x) for x in zip(*out))
        return pa.RecordBatch.from_arrays(
            [pa.array(mask.view(np.int64)), pa.array((fp & mask).view(np.int64)), pa.array(fp.view(np.int64))],
            names=["mask", "pattern", "fp"],
        )

    return by_batch(work)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _groups(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per run of neighbours: AND and OR of all codes below; bits where both agree are shared."""
    at = np.arange(0, len(low), RUN)
    return np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at)


def _apart(a: tuple, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Differing bits that nodes i and j surely have: those shared on both sides with unlike values."""
    low, high = a
    shared = ~(low[i] ^ high[i]) & ~(low[j] ^ high[j])
    return np.bitwise_count((low[i] ^ low[j]) & shared)


def leaf_pairs(codes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The codes in Gray order, and the places of all pairs at ``bits`` or fewer differing bits."""
    codes = codes[np.argsort(gray_rank(codes), kind="stable")]
    levels = [(codes, codes)]
    while len(levels[-1][0]) > RUN:
        levels.append(_groups(*levels[-1]))
    n = len(levels[-1][0])
    i, j = (x.ravel() for x in np.triu_indices(n))
    for depth in range(len(levels) - 1, -1, -1):
        near = _apart(levels[depth], i, j) <= bits
        i, j = i[near], j[near]
        if depth:  # children of the pairs that are left
            size, step = len(levels[depth - 1][0]), np.arange(RUN)
            down = (i[:, None, None] * RUN + step[None, :, None], j[:, None, None] * RUN + step[None, None, :])
            i, j = (x.ravel() for x in np.broadcast_arrays(*down))
            inside = (i < size) & (j < size) & (i <= j)
            i, j = i[inside], j[inside]
    apart = i < j
    return codes, i[apart], j[apart]


def _link(bits: int):
    """Leaves (``codes``) to star edges between the codes of each of their components."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        column = batch.column(0)
        flat, offsets = np.asarray(column.values).view(np.uint64), np.asarray(column.offsets)
        a, b = [], []
        for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            if e - s == 2:
                if int(flat[s] ^ flat[s + 1]).bit_count() <= bits:
                    a.append(flat[s:s + 1])
                    b.append(flat[s + 1:e])
                continue
            codes, i, j = leaf_pairs(flat[s:e], bits)
            if len(i):
                label = stars(len(codes), i, j)
                other = np.flatnonzero(label != np.arange(len(codes)))
                a.append(codes[other])
                b.append(codes[label[other]])
        if not a:
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], names=["a", "b"])

    return by_batch(work)


def index_edges(fps: DataFrame, bits: int) -> DataFrame:
    """Edges ``a, b`` that connect exactly the distinct fingerprints ``fp`` linked at ``bits`` or fewer bits."""
    masks = F.explode(F.array(*[F.lit(_signed(m)) for m in child_masks(0, bits)])).alias("mask")
    rows = fps.select("fp", masks).select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("pattern"), "fp")
    node, edges = ["mask", "pattern"], None
    while True:
        rows = stage(rows)
        sizes = stage(rows.groupBy(*node).agg(F.count("*").alias("n")).where("n > 1"))
        leaves = stage(rows.join(sizes.where(F.col("n") <= LEAF), node).select(*node, "fp"))
        found = leaves.groupBy(*node).agg(F.collect_list("fp").alias("codes")).select("codes").mapInArrow(
            _link(bits), "a bigint, b bigint")
        edges = found if edges is None else edges.unionByName(found)
        large = sizes.where(F.col("n") > LEAF).select(*node)
        if large.isEmpty():
            return edges
        rows = rows.join(large, node).select("mask", "fp").mapInArrow(
            _divide(bits), "mask bigint, pattern bigint, fp bigint")


def _classes(rows: DataFrame, shingle: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """Rows ``rid, id, fp``; and for each fingerprint ``fp, low`` (least id), ``root`` (of its component)."""
    prints = stage(fingerprints(rows, shingle))
    least = prints.groupBy("fp").agg(F.min("id").alias("low"))
    roots = stage(components(index_edges(prints.select("fp").distinct(), bits)))
    roots = roots.select(F.col("node").alias("fp"), "root")
    return prints, stage(least.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    bounded_batches(docs.sparkSession)
    rows = packed(docs, id_col, text_col)
    return rows.select("rid", "row", F.col("c0").alias("id"), F.col("c1").cast("string").alias("text"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       bits: int = 3) -> DataFrame:
    """``id, fingerprint, component_id`` for each row of ``docs``.

    ``fingerprint`` has 16 hex digits; ``component_id`` is the least id reachable over links of ``bits`` or fewer
    differing bits, the row's own included. ASCII letters are lower-cased; words are separated by ASCII white space.

    Texts with fewer words than a shingle have one shingle, the whole text; null and empty texts have
    fingerprint zero and link like any other. Null ids are never the least unless a component has no other;
    then ``component_id`` is null. Repeated rows each get a row. An empty table gives no rows.
    """
    prints, classes = _classes(_rows(docs, id_col, text_col), shingle, bits)
    least = classes.groupBy("root").agg(F.min("low").alias("component_id"))
    by_print = stage(dealt_join(classes, least, ["root"]).select("fp", "component_id"))
    return dealt_join(prints, by_print, ["fp"]).select(
        "id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bits: int = 3) -> DataFrame:
    """``docs`` with one row of each component: that of the least id (nulls last), of equal ids the first stored."""
    rows = _rows(docs, id_col, text_col)
    prints, classes = _classes(rows, shingle, bits)
    first = F.min(F.struct(F.col("id").isNull(), "id", "rid"))
    keep = dealt_join(prints, classes.select("fp", "root"), ["fp"]).groupBy("root").agg(first.alias("first"))
    keep = stage(keep.select(F.col("first.rid").alias("rid")))
    kept = rows.join(keep, "rid", "left_semi")
    return unpacked(kept, docs.columns, **{id_col: F.col("id"), text_col: F.col("text")})
