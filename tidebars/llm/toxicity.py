"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; the unlabelled set is a sample of the texts, whatever their label. With the
class prior ``p`` (the share of toxic rows among the training labels) the risk of a score ``f`` is

    p * E_pos[l(f)] + max(0, E_unl[l(-f)] - p * E_pos[l(-f)])

with the logistic loss ``l``. Where the second part falls under zero, a step raises it instead of following it down, so
the classifier can't gain by fitting the toxic texts among the unlabelled ones as clean. Scores are linear in the
presence of words and word beginnings; numpy trains on a bounded sample in one task, Spark counts and scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebars.llm.common import CodeTable, bounded_batches, by_batch, name, packed, split_words, tidy, unpacked

POSITIVES, UNLABELLED = 4000, 8000  # expected size of the two samples
FEATURES = 6000  # features of a model
PREFIXES = (4, 5, 6)
RARE, ENRICHED = 4, 2.0  # positives that must have a feature, and how much likelier they must have it than the unlabelled
ROUNDS, STEP, DECAY = 400, 0.05, 1e-4
EDGES = "\"'()[]{}<>.,;:!?*_-`|/\\=«»“”„’…"


def word_features(word: str) -> list[int]:
    """Hashes of a word without case and outer punctuation, and of its beginnings."""
    text = word.lower().strip(EDGES)
    if not text:
        return []
    parts = ["=" + text] + ["^" + text[:n] for n in PREFIXES if len(text) >= n]
    return [xxhash.xxh64_intdigest(p.encode("utf-8", "replace")) for p in parts]


def _present(table: CodeTable, texts: pa.Array) -> Iterator[np.ndarray]:
    """The different values of each text's words."""
    known, at, offsets = split_words(texts)
    table.trim()
    numbers = table.codes([known.to_pylist()])[0]
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield np.unique(table.spread(numbers[np.unique(at[a:b])]))


def _features(batch: pa.RecordBatch) -> pa.RecordBatch:
    table = CodeTable(lambda words: [word_features(w) for w in words], dtype=np.uint64)
    found = [x.view(np.int64) for x in _present(table, batch.column(1))]
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["positive", "features"])


def nnpu_weights(positive: np.ndarray, row: np.ndarray, feature: np.ndarray, n_features: int, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias. ``positive``: per row; ``row``, ``feature``: places of the ones of the sparse matrix."""
    n = len(positive)
    share = np.where(positive, 1.0 / max(1, positive.sum()), 1.0 / max(1, (~positive).sum()))
    w, bias = np.zeros(n_features), float(np.log(prior / (1 - prior)))
    first, second = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for t in range(1, ROUNDS + 1):
        f = np.bincount(row, w[feature], n) + bias
        up = 1 / (1 + np.exp(-np.clip(f, -500, 500)))  # slope of l(-f)
        loss = np.logaddexp(0, f)  # l(-f)
        negative = (share * loss)[~positive].sum() - prior * (share * loss)[positive].sum()
        below = np.where(positive, -prior, 1.0) * share * up  # of the negative part
        slope = -below if negative < 0 else below + np.where(positive, prior * share * (up - 1), 0)
        gradient = np.append(np.bincount(feature, slope[row], n_features) + DECAY * w, slope.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient * gradient
        step = STEP * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-10)
        w, bias = w - step[:-1], bias - step[-1]
    return w, float(bias)


def _sampled(rows: DataFrame, target: int) -> DataFrame:
    """About ``target`` of the rows, chosen by a hash of ``id``."""
    n = rows.count()
    if n <= target:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1 << 30)) < int((1 << 30) * target / n))


class Model:
    """Features (sorted hashes), their weights and the bias; ``None`` features score the prior for every text."""

    def __init__(self, features: np.ndarray, weights: np.ndarray, bias: float):
        self.features, self.weights, self.bias = features, weights, bias

    def scorer(self):
        """A function from texts to scores."""
        features, weights, bias = self.features, self.weights, self.bias

        def places(words: list[str]) -> list[list[int]]:
            hashes = [word_features(w) for w in words]
            flat = np.fromiter((h for hs in hashes for h in hs), np.uint64)
            at = np.searchsorted(features, flat)
            hit = features[np.minimum(at, len(features) - 1)] == flat if len(features) else np.zeros(len(flat), bool)
            at, hit, out, end = at.tolist(), hit.tolist(), [], 0
            for hs in hashes:
                out.append([at[i] for i in range(end, end + len(hs)) if hit[i]])
                end += len(hs)
            return out

        table = CodeTable(places, limit=100_000)

        def score(texts: pa.Array) -> np.ndarray:
            f = np.array([weights[p].sum() for p in _present(table, texts)]) + bias
            return 1 / (1 + np.exp(-np.clip(f, -500, 500)))

        return score


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model of ``docs``; ``labels`` may only hold rows that may be learnt from.

    The unlabelled sample is taken from the rows of ``docs``; at most ``UNLABELLED`` and ``POSITIVES`` rows are expected in the
    samples and ``FEATURES`` features in the model, whatever the size of the tables. Labels that are null count for nothing; of
    repeated labels of a document one 1 is enough. Without a positive row every text scores the prior, or 0 without labels.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(name(id_col).alias("id"), name(text_col).cast("string").alias("text"))
    marks = labels.select(name(id_col).alias("id"), name(label_col).cast("int").alias("y")).dropna()
    marks = marks.groupBy("id").agg(F.max("y").alias("y"))
    n, toxic = marks.agg(F.count("*"), F.coalesce(F.sum(F.when(F.col("y") == 1, 1)), F.lit(0))).first()
    prior = min(0.95, max(1e-4, toxic / n)) if n else 1e-4
    bare = Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(prior / (1 - prior))))
    if not toxic:
        return bare
    chosen = _sampled(marks.where("y = 1"), POSITIVES).select("id", F.lit(True).alias("positive")).unionByName(
        _sampled(rows.select("id").dropna(), UNLABELLED).select("id", F.lit(False).alias("positive")).distinct())
    sample = rows.join(F.broadcast(chosen), "id").select("positive", "text").mapInArrow(
        by_batch(_features), "positive boolean, features array<bigint>")
    counts = sample.select("positive", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.sum(F.col("positive").cast("int")).alias("p"), F.sum((~F.col("positive")).cast("int")).alias("u"))
    sizes = {r["positive"]: r["n"] for r in sample.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    p, u = F.col("p") / max(1, sizes.get(True, 0)), F.col("u") / max(1, sizes.get(False, 0))
    spread = 1 / max(1, sizes.get(True, 0)) + 1 / max(1, sizes.get(False, 0))
    gain = (p - u) / F.sqrt((p + u) / 2 * spread)
    best = counts.where((F.col("p") >= RARE) & (p >= u * ENRICHED)).orderBy(gain.desc(), "feature").limit(FEATURES).select("feature").collect()
    features = np.sort(np.array([r[0] for r in best], np.int64).view(np.uint64))
    if not len(features):
        return bare

    def narrowed(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = [np.searchsorted(features, x[np.isin(x, features)]).astype(np.int32)
               for x in (np.array(v, np.int64).view(np.uint64) for v in batch.column(1).to_pylist())]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.list_(pa.int32()))], names=["positive", "at"])

    @tidy
    def fit(batches):
        data = sorted((p, tuple(at)) for b in batches for p, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        positive = np.array([p for p, _ in data], bool)
        row = np.repeat(np.arange(len(data)), [len(at) for _, at in data])
        feature = np.fromiter((x for _, at in data for x in at), np.int64, len(row))
        w, bias = nnpu_weights(positive, row, feature, len(features), prior)
        yield pa.RecordBatch.from_pylist([{"weights": w.tolist(), "bias": bias}])

    small = sample.mapInArrow(by_batch(narrowed), "positive boolean, at array<int>")
    out = small.repartition(1).mapInArrow(fit, "weights array<double>, bias double").first()
    return Model(features, np.array(out["weights"]), out["bias"])


def may_learn(column: str) -> F.Column:
    """Rows of the training part: crc32 of the id as text, mod 3, isn't 1. A null id counts as an empty text."""
    return ~held_out(column)


def held_out(column: str) -> F.Column:
    return F.pmod(F.crc32(F.coalesce(name(column).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", threshold: float = 0.7) -> DataFrame:
    """``row`` and ``text`` (all of ``docs``), ``held_out``, ``score`` from 0 to 1, ``predicted`` (1 from ``threshold`` on).

    Trained on rows that aren't held out; scores depend on the whole text alone. Null and empty texts score the model's
    bias. Repeated rows score alike, rows with null ids too. An empty table gives no rows.
    """
    learn = labels.where(may_learn(id_col))
    model = train(docs.where(may_learn(id_col)), learn, id_col, text_col, label_col)
    rows = packed(docs, id_col, text_col, numbered=False)
    rows = rows.select("row", F.col("c0").alias("id"), F.col("c1").cast("string").alias("text"), held_out("c0").alias("held_out"))
    kind = rows.schema

    @tidy
    def score(batches):
        scorer = model.scorer()
        for batch in batches:
            if batch.num_rows:
                arrays = [batch.column(i) for i in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.array(scorer(batch.column(2)), pa.float64())],
                    names=["row", "id", "text", "held_out", "score"])

    scored = rows.mapInArrow(
        score, f"row {kind['row'].dataType.simpleString()}, id {kind['id'].dataType.simpleString()}, text string, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` without the rows predicted toxic."""
    kept = score_toxicity(docs, labels, id_col, text_col, threshold=threshold).where("predicted = 0")
    return unpacked(kept, docs.columns, **{id_col: F.col("id"), text_col: F.col("text")})
