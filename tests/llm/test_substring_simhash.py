"""Substring dedup and SimHash near-dedup against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidebars.llm import simhash_gray
from tidebars.llm.common import packed
from tidebars.llm.components import components
from tidebars.llm.simhash_gray import leaf_pairs, one_of_each, simhash, simhash_components
from tidebars.llm.substring_dedup import dedup_substrings, without_repeats


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def cut_brute(texts, n):
    lists = [words_of(t) for t in texts]
    seen = collections.Counter(tuple(w[i:i + n]) for w in lists for i in range(len(w) - n + 1))
    out = []
    for w in lists:
        gone = set()
        for i in range(len(w) - n + 1):
            if seen[tuple(w[i:i + n])] > 1:
                gone.update(range(i, i + n))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def corpus(seed, n=60, vocabulary=40):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    passages = [[rng.choice(words) for _ in range(rng.randint(8, 40))] for _ in range(5)]
    texts = []
    for _ in range(n):
        w = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(w))
            w[at:at] = rng.choice(passages)
        texts.append(rng.choice([" ", "\n", "\t "]).join(w))
    return texts + texts[:4] + ["a " * 50, "b " * 9, "", None, "ä ö  x", "same " * 200]


@pytest.mark.parametrize("n, seed", [(9, 3), (12, 12), (10, 1)])
def test_repeats_match_brute_force(docs, n, seed):
    texts = corpus(n)
    rows = [(i if i != 7 else None, t) for i, t in enumerate(texts)]
    found = dedup_substrings(docs(rows), "text", n, seed).collect()
    want = collections.Counter(zip([r[0] for r in rows], cut_brute(texts, n)))
    got = collections.Counter((r["row"]["doc_id"], (r["n_words"], r["n_removed"], r["kept"])) for r in found)
    assert got == want


def test_repeats_edges(docs):
    empty = dedup_substrings(docs([]), "text", 5, 3)
    assert empty.collect() == []
    with pytest.raises(ValueError):
        dedup_substrings(docs([]), "text", 3, 5)
    line = " ".join(f"u{i}" for i in range(40))
    out = without_repeats(docs([(1, line), (1, line), (2, "keep  this"), (3, None), (None, line + " tail")]), "text", 35)
    assert out.columns == ["doc_id", "text", "rid", "row"]
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    assert got == sorted([(1, ""), (1, ""), (2, "keep  this"), (3, None), (None, "tail")], key=str)


def test_long_text_with_distant_repeat(docs):
    long = [f"t{i}" for i in range(30_000)]
    text = " ".join(long + long[100:150])
    got = dedup_substrings(docs([(1, text), (2, " ".join(long[29_000:29_040]))]), "text", 35).collect()
    assert {r["row"]["doc_id"]: r["n_removed"] for r in got} == {1: 50 + 50 + 40, 2: 40}


def simhash_brute(text):
    w = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    parts = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked_brute(codes, ids, bits=3):
    parent = list(range(len(codes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    groups = collections.defaultdict(list)
    for i in range(len(codes)):
        groups[find(i)].append(ids[i])
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(codes))]


def near_texts(seed):
    rng = random.Random(seed)
    base = [f"v{rng.randint(0, 500)}" for _ in range(300)]
    out = []
    for _ in range(40):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = f"e{rng.randint(0, 9)}"
        out.append(" ".join(w))
    return out + [" ".join(f"r{rng.random()}" for _ in range(50)) for _ in range(20)]


def test_fingerprint():
    for text in corpus(4) + ["One TWO three", "One", "ÄÖ x"]:
        assert simhash((text or "").encode()) == simhash_brute(text)


def test_shingle_hash_is_sparks(spark):
    line = "Ein Wort mit ä"
    got = spark.range(1).select(F.xxhash64(F.lit(line)).alias("h")).first()["h"]
    assert got % (1 << 64) == xxhash.xxh64_intdigest(line.encode(), 42)


@pytest.mark.parametrize("leaf", [2048, 8])
def test_components_match_brute_force(docs, monkeypatch, leaf):
    monkeypatch.setattr(simhash_gray, "LEAF", leaf)
    texts = near_texts(leaf) + ["", None, "A b", "a B"]
    ids = [i + 10 for i in range(len(texts))]
    ids[3] = None
    rows = list(zip(ids, texts)) + [(ids[0], texts[0])]
    ids, texts = zip(*rows)
    codes = [simhash_brute(t) for t in texts]
    want = collections.Counter(zip(ids, (f"{c:016x}" for c in codes), linked_brute(codes, ids)))
    assert collections.Counter(map(tuple, simhash_components(docs(rows)).collect())) == want


def test_one_of_each(docs):
    text = " ".join(f"z{i}" for i in range(100))
    rows = [(5, text), (2, text), (2, text), (None, text), (7, "other words here"), (None, "alone with null id now")]
    kept = one_of_each(docs(rows))
    assert kept.columns == ["doc_id", "text", "rid", "row"]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([(2, text), rows[4], rows[5]], key=str)
    assert one_of_each(docs([])).collect() == []
    assert simhash_components(docs([])).collect() == []


def test_leaf_pairs_match_all_pairs():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    codes = np.unique(np.concatenate([b ^ (np.uint64(1) << rng.integers(0, 64, 120, dtype=np.uint64)) for b in base]))
    ordered, i, j = leaf_pairs(codes, 3)
    got = {frozenset((int(ordered[a]), int(ordered[b]))) for a, b in zip(i, j)}
    want = {frozenset((int(a), int(b))) for k, a in enumerate(codes) for b in codes[:k] if (int(a) ^ int(b)).bit_count() <= 3}
    assert got == want


def test_components_of_graphs(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, x) for x in range(2, 60)] + [(200, 200), (300, 299), (299, 300)]
    rng.shuffle(edges)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 60)}, 299: 299, 300: 299}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_sha_of_query_matches(docs):
    out = dedup_substrings(docs([(1, "a b")]), "text", 35).select(F.sha2("kept", 256).alias("h")).first()["h"]
    assert out == hashlib.sha256(b"a b").hexdigest()


def test_row_numbers_hold_for_any_split(spark, tmp_path):
    """Splits follow the number of cores, which changes when an executor is lost or joins."""
    path = f"{tmp_path}/a b%20c"
    spark.range(6000).selectExpr("id % 100 as doc_id", "concat('text ', id) as text").repartition(3).write.option(
        "parquet.block.size", 2048).option("parquet.page.row.count.limit", 100).option("parquet.block.row.count.limit", 500).parquet(path)
    table = spark.read.parquet(path)
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.leafNodeDefaultParallelism"]
    for frame in (table, table.where("doc_id < 50").select("text", "doc_id"), spark.range(900).selectExpr("id % 7 as doc_id", "string(id) as text"),
                  table.selectExpr("explode(array(1, 2)) as doc_id", "text")):
        rows, found = packed(frame, "doc_id", "text"), []
        try:
            for values in (("128m", "4m", "2"), ("4k", "0", "5")):
                for k, v in zip(keys, values):
                    spark.conf.set(k, v)
                found.append({r["rid"]: (r["c0"], r["c1"]) for r in rows.select("rid", "c0", "c1").collect()})  # planned anew
        finally:
            for k in keys:
                spark.conf.unset(k)
        assert found[0] == found[1] and len(found[0]) == frame.count()


def test_overlapping_file_numbers_are_seen(spark, tmp_path, monkeypatch):
    from tidebars.llm import common

    spark.range(4000).selectExpr("id as doc_id", "string(id) as text").repartition(4).write.parquet(f"{tmp_path}/x")
    table = spark.read.parquet(f"{tmp_path}/x")
    assert not common._numbers_clash(table) and common._plain_scan(table)
    monkeypatch.setattr(common, "HOME_BITS", 11)  # as if hashes lay close together
    monkeypatch.setattr(common, "HOME_BUCKET", 8)
    assert common._numbers_clash(table)
    rids = [r["rid"] for r in packed(table, "doc_id").collect()]
    assert len(set(rids)) == 4000
    assert not common._plain_scan(table.join(spark.range(5), F.col("doc_id") > F.col("id")))
