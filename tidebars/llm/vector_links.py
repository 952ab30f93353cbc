"""Near-duplicate vectors by a subspace pigeonhole join.

Vectors are scaled to length one, where a cosine of at least ``c`` is a squared distance of at most ``2 - 2 c``, and turned by
random signs and a Walsh-Hadamard transform, which spreads the distance over all dimensions. The turned vector is split into blocks of a
few dimensions, and the squared distance into budgets proportional to their widths: two vectors within the whole distance are
within the budget of at least one block. Each block is joined by range on a grid over its first dimensions: a vector lies in its
own cell and visits the later cells that its budget reaches, so two vectors meet in one cell of a block at most. What passes the
budget of a block there, and of none before it, is verified by the exact cosine of the original vectors; a pair is thus seen
once, and links are counted where they are found: no pair is written or shuffled.

All values that decide where a pair is seen are sums taken element by element, the same in every task.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebars.llm.ann import _usable
from tidebars.llm.common import bounded_batches, by_batch, dealt_join, name
from tidebars.llm.components import components, stars
from tidebars.llm.grouped import column, split_pairs, whole_groups
from tidebars.session import stage

BLOCK = 8  # dimensions of a block
GRID = 4  # dimensions of a block that its grid may use
CELL = 2048  # vectors of a cell before it is split
SEED = 20_240_611
SLACK = 1e-9  # relative; sums of squares are rounded
PAIRS = 1 << 14  # verified at once


def squares(rows: np.ndarray) -> np.ndarray:
    """Sum of squares of each row, one column after the other."""
    total = np.zeros(len(rows))
    for k in range(rows.shape[1]):
        total += rows[:, k] * rows[:, k]
    return total


def turned(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one, turned; dimensions padded to a power of two."""
    n, dim = vectors.shape
    size = 1 << max(0, dim - 1).bit_length()
    out = np.zeros((n, size))
    largest = np.abs(vectors).max(axis=1)[:, None]  # squares of huge or tiny components stay in range
    unit = vectors / largest
    out[:, :dim] = unit / np.sqrt(squares(unit))[:, None]
    out *= np.random.default_rng(SEED).choice([-1.0, 1.0], size)
    step = 1
    while step < size:
        pair = out.reshape(n, -1, 2, step)
        out = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(n, size)
        step *= 2
    return out / math.sqrt(size)


def blocks(size: int) -> list[tuple[int, int]]:
    """The blocks of a turned vector: from, to."""
    return [(at, min(size, at + BLOCK)) for at in range(0, size, BLOCK)]


def budgets(size: int, cosine: float) -> list[float]:
    return [(2 - 2 * cosine) * (b - a) / size * (1 + SLACK) + 1e-15 for a, b in blocks(size)]


def _cells(cosine: float, grid: int):
    """Vectors to their own cell of each block and the later cells that the budget reaches."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        vectors = batch.column(batch.schema.get_field_index("v"))
        dims = np.diff(np.asarray(vectors.offsets))
        taken, out = [], {"dim": [], "block": [], "cell": [], "own": []}
        for dim in np.unique(dims).tolist():
            rows = np.flatnonzero(dims == dim)
            own = vectors.take(pa.array(rows))
            u = turned(np.asarray(own.flatten(), np.float64).reshape(len(rows), dim))
            for j, ((a, b), budget) in enumerate(zip(blocks(u.shape[1]), budgets(u.shape[1], cosine))):
                reach = math.sqrt(budget)
                width = 2.01 * reach
                base = int(2 / width) + 4
                part = u[:, a:min(b, a + grid)] + 1 + width
                place = np.floor(part / width).astype(np.int64)
                side = np.where(part - reach * (1 + SLACK) < place * width, -1, np.where(part + reach * (1 + SLACK) >= (place + 1) * width, 1, 0))
                weight = base ** np.arange(part.shape[1], dtype=np.int64)
                home = place @ weight
                for chosen in itertools.product((0, 1), repeat=part.shape[1]):
                    on = np.array(chosen, bool)
                    at = (side[:, on] != 0).all(axis=1)
                    cell = home + (side[:, on] * weight[on]).sum(axis=1) if on.any() else home
                    at &= (cell > home) if on.any() else True
                    found = np.flatnonzero(at)
                    taken.append(rows[found])
                    for key, value in (("dim", dim), ("block", j), ("cell", cell[found]), ("own", not on.any())):
                        out[key].append(np.broadcast_to(value, len(found)))
        at = pa.array(np.concatenate(taken))
        kinds = {"dim": np.int32, "block": np.int32, "cell": np.int64, "own": bool}
        more = {k: pa.array(np.concatenate(v).astype(kinds[k])) for k, v in out.items()}
        columns = {c: batch.column(batch.schema.get_field_index(c)).take(at) for c in batch.schema.names}
        return pa.RecordBatch.from_pydict(columns | more)

    return by_batch(work)


def _linked(u: np.ndarray, v: np.ndarray, block: int, cosine: float, pair_ok) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a cell of ``block`` that are linked and within the budget of no block before."""
    parts, limits = blocks(u.shape[1]), budgets(u.shape[1], cosine)
    a, b = parts[block]
    own = np.ascontiguousarray(u[:, a:b])
    length = (own * own).sum(axis=1)
    norm = np.sqrt((v * v).sum(axis=1))
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, len(u), 512):
        near = length[at:at + 512, None] + length[None, :] - 2 * (own[at:at + 512] @ own.T) <= limits[block] + 1e-9
        i, j = np.nonzero(near)
        i += at
        fit = pair_ok(i, j)
        i, j = i[fit], j[fit]
        for s in range(0, len(i), PAIRS):
            x, y = i[s:s + PAIRS], j[s:s + PAIRS]
            fit = np.ones(len(x), bool)
            for k, (c, d) in enumerate(parts[:block + 1]):
                inside = squares(u[x, c:d] - u[y, c:d]) <= limits[k]
                fit &= inside if k == block else ~inside
            x, y = x[fit], y[fit]
            fit = np.einsum("ij,ij->i", v[x], v[y]) / (norm[x] * norm[y]) >= cosine
            left.append(x[fit])
            right.append(y[fit])
    return np.concatenate(left), np.concatenate(right)


def _links(cosine: float):
    """Cells to ``a, b`` (edges that connect what is linked) and ``a, links`` (number of linked vectors found)."""

    def work(table: pa.Table, starts: np.ndarray):
        own, cid, n, block, bucket, low, high = (
            column(table, c).to_numpy(zero_copy_only=False) for c in ("own", "cid", "n", "block", "bucket", "low", "high"))
        vectors = column(table, "v")
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows]):
            if e - s < 2 or not own[s:e].any():
                continue
            v = np.asarray(vectors.slice(s, e - s).flatten(), np.float64).reshape(e - s, -1)
            v = np.ldexp(v, -np.frexp(np.abs(v).max(axis=1))[1][:, None])  # exact, and no square overflows
            mine, part, apart = own[s:e], bucket[s:e], low[s] < high[s]

            def pair_ok(i, j, mine=mine, part=part, apart=apart):
                ok = (i < j) & (mine[i] | mine[j])
                return ok & (part[i] != part[j]) if apart else ok

            i, j = _linked(turned(v), v, int(block[s]), cosine, pair_ok)
            if not len(i):
                continue
            ids, sizes = cid[s:e], n[s:e]
            links = np.zeros(e - s, np.int64)
            np.add.at(links, i, sizes[j])
            np.add.at(links, j, sizes[i])
            label = stars(e - s, i, j)
            other, some = np.flatnonzero(label != np.arange(e - s)), np.flatnonzero(links)
            a = np.concatenate([ids[other], ids[some]])
            b = pa.concat_arrays([pa.array(ids[label[other]]), pa.nulls(len(some), pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [pa.array(a), b, pa.array(np.concatenate([np.zeros(len(other), np.int64), links[some]]))], names=["a", "b", "links"])

    return work


def vector_links(vectors: DataFrame, cosine: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label") -> DataFrame:
    """``id, n_links, component_id, kept`` for each row of ``vectors``.

    Two rows are linked if their labels are equal and not null and their cosine in double precision is at least ``cosine`` (over 0).
    ``component_id`` is the least id reachable over links, the row's own included; ``kept`` rows have it as their id.

    Vectors that are null, zero, empty or hold null or non-finite components link with nothing, and vectors only with those of their
    own length. Repeated rows are linked vectors each. A null id is the least only of a component without another; such rows aren't kept.
    Equal vectors of a label are compared once, whatever their number. Other columns don't matter. An empty table gives no rows.
    """
    if not 0 < cosine <= 1:
        raise ValueError("the cosine must be over 0 and at most 1")
    spark = vectors.sparkSession
    bounded_batches(spark)
    kind = "float" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "double"
    plain = F.transform(name(vector_col).cast(f"array<{kind}>"), lambda x: x + F.lit(0).cast(kind))  # one zero
    rows = stage(vectors.select(name(id_col).alias("id"), name(label_col).cast("string").alias("label"), plain.alias("v")).withColumn(
        "fit", F.coalesce(F.col("label").isNotNull() & _usable("v"), F.lit(False))))
    fit = rows.where("fit").withColumn("h", F.xxhash64("label", "v"))
    classes = stage(fit.groupBy("h", "label", "v").agg(F.min("id").alias("first"), F.count("*").alias("n")).withColumn(
        "cid", F.monotonically_increasing_id()))
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    grid = min(GRID, max(0, math.ceil(math.log(max(1, most / CELL), 3)) + 1))

    cells = classes.select("label", "cid", "n", "v").mapInArrow(
        _cells(cosine, grid), f"label string, cid bigint, n bigint, v array<{kind}>, dim int, block int, cell bigint, own boolean")
    keys = ["label", "dim", "block", "cell"]
    found = stage(whole_groups(
        split_pairs(stage(cells), keys, "cid", CELL), [*keys, "low", "high"], _links(cosine), "a bigint, b bigint, links bigint"))

    links = found.where("b IS NULL").groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
    roots = components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "cid")
    known = stage(classes.join(roots, "cid", "left").join(links, "cid", "left").select(
        "h", "label", "v", "first", F.coalesce("root", "cid").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    least = known.groupBy("root").agg(F.min("first").alias("component_id"))
    known = stage(dealt_join(known, least, ["root"]).select("h", "label", "v", "n_links", "component_id"))
    linked = fit.join(known, ["h", "label", "v"]).select("id", "n_links", "component_id")
    alone = rows.where("NOT fit").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    both = linked.unionByName(alone)
    return both.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
