"""The pipeline, stage by stage, against brute force on a small corpus."""

import collections
import os
import random
import sys

import numpy as np

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline  # noqa: E402
from test_substring_simhash import cut_brute, linked_brute, simhash_brute  # noqa: E402
from tidebars.llm.toxicity import score_toxicity  # noqa: E402
from tidebars.session import stage  # noqa: E402


def corpus():
    rng = random.Random(11)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgkm" for b in ("alo", "eri", "uso") for c in ("", "n", "st")]
    item = " ".join(rng.choice(vocabulary) for _ in range(25))
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    texts, marks = [], []
    for i in range(260):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(5, 120))]
        toxic = rng.random() < 0.2
        if toxic:
            w[2:2] = ["vilest", "scummy", "lowlife"]
        if i % 20 == 3:
            w += item.split()
        if i % 25 == 4:
            w[3:3] = passage.split()
        texts.append(" ".join(w))
        marks.append((i, int(toxic)))
    for i in range(10, 30):  # exact and near copies
        texts.append(texts[i])
        texts.append(texts[200 + i] + " tail")
    return list(enumerate(texts)) + [(900, None), (901, "")], marks, item


def test_stages(spark, tokenizer, tmp_path):
    rows, marks, item = corpus()
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                  "doc_id bigint, text string, lang string, source string, n_chars bigint")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, y) for i, y in marks], "doc_id bigint, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.read.parquet(str(tmp_path / "labels.parquet"))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash_near_dedup", "substring_dedup", "benchmark_decontamination", "packing"]
    outputs, columns = [docs], docs.columns
    for _, work in corpus_pipeline.STAGES:
        outputs.append(stage(work(spark, outputs[-1], str(tmp_path))))
    tables = [{r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()} for out in outputs[:5]]
    assert all(out.columns == columns for out in outputs[:5])

    scores = {r["id"]: r["predicted"] for r in score_toxicity(docs, labels).collect()}
    assert set(tables[1]) == {i for i in tables[0] if not scores[i]} and len(tables[1]) < len(tables[0])
    toxic = {i for i, y in marks if y}
    assert len(toxic & set(tables[1])) < 0.1 * len(toxic) and len(set(tables[0]) - toxic - set(tables[1])) < 0.1 * len(tables[0])

    ids = sorted(tables[1])
    roots = linked_brute([simhash_brute(tables[1][i][0]) for i in ids], ids)
    assert set(tables[2]) == set(roots) and len(tables[2]) < len(tables[1])

    ids = sorted(tables[2])
    for i, (_, gone, kept) in zip(ids, cut_brute([tables[2][k][0] for k in ids], 35)):
        assert tables[3][i][0] == (kept if gone else tables[2][i][0])
        assert tables[3][i][1] == (None if tables[3][i][0] is None else len(tables[3][i][0]))
    assert set(tables[3]) == set(ids)

    own = item.split()
    grams = {tuple(own[k:k + 8]) for k in range(len(own) - 7)}
    holds = {i for i, (t, _) in tables[3].items()
             if any(tuple((t or "").split()[k:k + 8]) in grams for k in range(len((t or "").split()) - 7))}
    assert set(tables[4]) == set(tables[3]) - holds and holds

    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer)
    pieces = collections.Counter()
    for r in outputs[5].collect():
        pieces[r["doc_id"]] += r["length"]
    assert pieces == {i: len(t.encode(x or "", add_special_tokens=False).ids) + 1 for i, (x, _) in tables[4].items()}
    assert outputs[5].groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0] <= 4096
    rerun = corpus_pipeline.run(spark, str(tmp_path))
    assert np.sum([r["length"] for r in rerun.collect()]) == sum(pieces.values())


def test_scan_for_leaks_holds_a_part_of_a_batch(monkeypatch):
    """The arrays of a batch's tokens don't stand in memory at once, and parts give the windows of the whole batch."""
    import tracemalloc

    import pyarrow as pa

    from tidebars.llm import common, decontamination

    rng = np.random.default_rng(3)
    words = np.array([f"{'abcdefgh'[k % 8]}w{'xyz'[k % 3]}{'opqrst'[k // 8 % 6]}" for k in range(100)] + ["Paris", "12", "km", "end."])
    texts = [" ".join(words[rng.integers(0, len(words), n)]) for n in [2_500] * 200 + [0, 1, 7, 8, 9]] + [None, "  "]

    def scan(rows):
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int64()), pa.array(rows, pa.string())], names=["rid", "text"])
        return decontamination._scan([8], np.zeros(1 << (decontamination.BITS - 3), np.uint8), False), iter([batch])

    list(scan(texts[-3:])[0](scan(texts[-3:])[1]))
    work, batches = scan(texts)
    tracemalloc.start()
    list(work(batches))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6  # a batch of 2.5 MB
    assert len(common._POWERS[0]) == 1  # nor do powers of the longest text stay in the worker

    few = texts[190:]
    whole = [r for b in decontamination._scan([8], None, True)(scan(few)[1]) for r in b.to_pylist()]
    monkeypatch.setattr(decontamination, "PART", 1_000, raising=False)
    parts = [r for b in decontamination._scan([8], None, True)(scan(few)[1]) for r in b.to_pylist()]
    order = lambda r: (r["key"], r["form"], r["start"])
    assert sorted(parts, key=order) == sorted(whole, key=order) and len(whole) > 1_000
