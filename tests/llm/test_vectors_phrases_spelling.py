"""Vector links, collocations and spelling variants against brute force."""

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidebars.llm import collocations as phrases
from tidebars.llm import spelling, vector_links as vectors
from tidebars.llm.collocations import collocations
from tidebars.llm.grouped import split_pairs
from tidebars.llm.spelling import Grams, near_words, one_edit, postings_of, spelling_variants
from tidebars.llm.vector_links import blocks, budgets, squares, turned, vector_links

CAPITALS = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


# --- vector links -----------------------------------------------------------------------------------------------------


def links_brute(rows, cosine):
    def fit(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n, root = [0] * len(rows), list(range(len(rows)))
    linked = collections.defaultdict(set)
    for (i, (_, v, p)), (j, (_, w, q)) in itertools.combinations(enumerate(rows), 2):
        if p == q and fit(v, p) and fit(w, q) and len(v) == len(w):
            a, b = np.array(v, float), np.array(w, float)
            if a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                linked[i].add(j)
                linked[j].add(i)
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(linked[i]), least, rows[i][0] is not None and rows[i][0] == least))
    return collections.Counter(out)


def clustered(seed, n=240, dim=64):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dim))
    rows = []
    for i in range(n):
        v = centres[i % 12] + rng.standard_normal(dim) * rng.choice([0.01, 0.08, 0.12, 0.4, 1.0])
        rows.append((1000 - i, [float(x) for x in (v * rng.choice([0.5, 1, 30])).astype(np.float32)], int(i % 3 == 0)))
    return rows


def as_vectors(spark, rows, kind="float"):
    schema = f"vec_id bigint, embedding array<{kind}>, label int, cid string, n int, block string"
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], schema)  # working names as other columns


def got_links(df, cosine=0.98, **names):
    return collections.Counter((r["id"], r["n_links"], r["component_id"], r["kept"]) for r in vector_links(df, cosine, **names).collect())


@pytest.mark.parametrize("dim, cell", [(64, 2048), (64, 16), (100, 8), (3, 8), (1, 4)])
def test_links_match_brute_force(spark, monkeypatch, dim, cell):
    monkeypatch.setattr(vectors, "CELL", cell)
    rows = clustered(dim, dim=dim)
    rows += rows[:5] + [(i, rows[0][1], rows[0][2]) for i in range(40)]  # copies of one vector
    assert got_links(as_vectors(spark, rows)) == links_brute(rows, 0.98)


def test_links_of_unusual_vectors(spark):
    one = [1.0, 0.0, -0.0]
    rows = [(1, one, 1), (2, [2.0, 0.0, 0.0], 1), (3, one, None), (4, None, 1), (5, [], 1), (6, [0.0, 0.0, 0.0], 1), (7, [1.0, None, 0.0], 1),
            (8, [float("nan"), 1.0, 0.0], 1), (9, [float("inf"), 1.0, 0.0], 1), (10, [1.0, 0.0], 1), (11, one, 2), (None, one, 1), (2, one, 1),
            (12, [1e200, 0.0, 1e190], 1), (13, [1e-200, 0.0, 0.0], 1)]
    got = got_links(as_vectors(spark, rows, "double"))
    plain = [(i, [x * 1e-200 if x and x > 1e100 else x * 1e200 if x and 0 < x < 1e-100 else x for x in v] if v else v, p) for i, v, p in rows]
    assert got == links_brute(plain, 0.98)
    assert got_links(as_vectors(spark, rows[:0])) == collections.Counter()


def test_near_vectors_share_the_budget_of_a_block():
    rng = np.random.default_rng(5)
    for dim in (5, 48, 64, 300):
        a = rng.standard_normal((300, dim))
        b = a + rng.standard_normal((300, dim)) * 0.19
        u, w = turned(a), turned(b)
        cos = (a * b).sum(1) / np.sqrt((a * a).sum(1) * (b * b).sum(1))
        assert np.allclose((u * w).sum(1), cos)
        inside = [squares(u[:, c:d] - w[:, c:d]) <= limit for (c, d), limit in zip(blocks(u.shape[1]), budgets(u.shape[1], 0.98))]
        assert np.any(inside, axis=0)[cos >= 0.98].all() and (cos >= 0.98).any()
        assert np.array_equal(turned(a)[7:9], turned(a[7:9]))  # the same in every task


def test_all_pairs_meet_once_in_split_groups(spark):
    rows = spark.range(100).selectExpr("id", "CASE WHEN id < 70 THEN 'hot' ELSE CAST(id AS string) END AS g")
    dealt = split_pairs(rows, ["g"], "id", 10).where("g = 'hot'").collect()
    groups = collections.defaultdict(list)
    for r in dealt:
        groups[r["low"], r["high"]].append((r["id"], r["bucket"]))
    met = collections.Counter()
    for (low, high), members in groups.items():
        assert len(members) <= 50
        met.update(tuple(sorted((a, b))) for (a, x), (b, y) in itertools.combinations(members, 2) if low == high or x != y)
    assert met == collections.Counter({pair: 1 for pair in itertools.combinations(range(70), 2)})


# --- collocations -----------------------------------------------------------------------------------------------------


def collocations_brute(rows, longest, least, top, share=100):
    counts, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(CAPITALS)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                counts.update((lang, tuple(words[i:i + size])) for i in range(len(words) - size + 1))
    candidates = {k: v for k, v in counts.items() if v >= least and len(k[1]) > 1}
    out = []
    for (lang, p), a in candidates.items():
        if any(x == lang and len(q) > len(p) and 100 * f >= share * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
               for (x, q), f in candidates.items()):
            continue
        cuts = [(1000 * a * n[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((lang, " ".join(p), a, counts[lang, p[:k]], counts[lang, p[k:]], n[lang], score))
    ranked = []
    for lang in {x[0] for x in out}:
        own = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(lang, i + 1, *x[1:]) for i, x in enumerate(own[:top])]
    return sorted(ranked)


def text_rows(seed, n=120):
    rng = random.Random(seed)
    words = ["red", "Blue", "ä", "the", "THE", "of", "日本", "x-y", "end"]
    lines = [" ".join(rng.choices(words, k=5)) for _ in range(3)]
    out = []
    for _ in range(n):
        parts = [rng.choice([rng.choice(lines), " ".join(rng.choices(words, k=rng.randint(0, 9)))]) for _ in range(rng.randint(0, 6))]
        out.append((rng.choice([" ", ".", ", ", "\t", "\n", "\x0b", "! "]).join(parts), rng.choice(["en", "de", None, "und", "en"])))
    return out + out[:9] + [(None, "en"), ("", None), ("solo", "fr"), ("of the " * 30_000, "en"), (".,;", "en")]


def as_texts(spark, rows):
    schema = "text string, lang string, prefix string, size int, f string"
    return spark.createDataFrame([(t, g, "p", 3, "f") for t, g in rows], schema)


@pytest.mark.parametrize("longest, least, top, share", [(5, 10, 2000, 100), (3, 4, 7, 100), (2, 4, 50, 100), (5, 4, 2000, 60)])
def test_collocations_match_brute_force(spark, longest, least, top, share):
    rows = text_rows(longest + least)
    got = collocations(as_texts(spark, rows).repartition(7), longest=longest, least=least, top=top, share=share).collect()
    assert sorted(map(tuple, got)) == collocations_brute(rows, longest, least, top, share)


def test_collocations_with_full_bitmaps_and_split_stripes(spark, monkeypatch):
    monkeypatch.setattr(phrases, "_has", lambda bitmap, places: np.ones(len(places), bool))  # every infrequent word passes
    monkeypatch.setattr(phrases, "SHARE", 10)
    monkeypatch.setattr(phrases, "PARTS", 3)
    monkeypatch.setattr(phrases, "SALT", 2)
    monkeypatch.setattr(phrases, "PENDING", 2)
    rows = text_rows(3)
    got = collocations(as_texts(spark, rows).repartition(5), least=6).collect()
    assert sorted(map(tuple, got)) == collocations_brute(rows, 5, 6, 2000)


def test_collocations_of_nothing(spark):
    assert collocations(as_texts(spark, [])).collect() == []
    assert collocations(as_texts(spark, [(None, None), ("a b", "en")])).collect() == []


def test_places_in_the_bitmap_agree(spark):
    words = ["a", "ä", "日本", "word"]
    df = spark.createDataFrame([(g, a, b) for g in ("en", "und") for a in words for b in words], "g string, a string, b string")
    got = df.select("g", "a", "b", phrases._place(F.col("g"), F.col("a")).alias("one"), phrases._place(F.col("g"), F.col("a"), F.col("b")).alias("two"))
    h = {w: np.array([xxhash.xxh64_intdigest(w.encode(), 42)], np.uint64) for w in [*words, "en", "und"]}
    for r in got.collect():
        assert r["one"] == phrases._places(h[r["g"]][0], h[r["a"]])[0] and r["two"] == phrases._places(h[r["g"]][0], h[r["a"]], h[r["b"]])[0]


# --- spelling variants ------------------------------------------------------------------------------------------------


def variants_brute(rows, every, least, times=5):
    counts = collections.Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(CAPITALS)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 6:
                counts[w] += 1
    n = {w: c for w, c in counts.items() if c >= least}
    near = {w: [x for x in n if x != w and one_edit(w.encode("latin-1"), x.encode("latin-1"))] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= times * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return sorted(out, key=str)


def spelled(seed, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choices(["an", "ti", "on", "re", "ß", "é", "s", "aa"], k=rng.randint(3, 6))) for _ in range(25)]
    words += ["aaaaaaaa", "aaaaaaa", "aaaaaaab", "z" * 70 + "x" + "y" * 70, "z" * 70 + "y" * 70, "q" * 64, "q" * 65, "q" * 66, "÷×÷×÷×"]
    rows = []
    for i in range(n):
        text = []
        for _ in range(rng.randint(0, 90)):
            w = rng.choice(words)
            if rng.random() < 0.1:
                k = rng.randrange(len(w))
                w = w[:k] + rng.choice(["", "x", w[k] * 2]) + w[k + 1:]
            text.append(rng.choice([w, w.upper(), w.title()]))
        rows.append((i if i != 7 else None, rng.choice([" ", ", ", "1", "Ā", "ſ"]).join(text)))
    return rows + rows[:3] + [(99, None), (98, ""), (97, "w" * 100_000 + " " + "w" * 99_999), (96, ("w" * 100_000 + " " + "w" * 99_999 + " ") * 6)]


@pytest.mark.parametrize("every, frequent, limit, small", [(199, 1000, 2048, 48), (3, 3, 8, 4), (2, 1, 2048, 48)])
def test_variants_match_brute_force(spark, docs, monkeypatch, every, frequent, limit, small):
    monkeypatch.setattr(spelling, "LIST", limit)
    monkeypatch.setattr(spelling, "SMALL", small)
    monkeypatch.setattr(spelling, "INNER", 10**9)
    monkeypatch.setattr(near_words, "__defaults__", (frequent,))
    rows = spelled(every)
    got = spelling_variants(docs(rows).repartition(5), every=every, least=2).collect()
    assert sorted(map(tuple, got), key=str) == variants_brute(rows, every, 2)


def test_variants_of_nothing(docs):
    assert spelling_variants(docs([])).collect() == []
    assert spelling_variants(docs([(1, None), (2, "short ones only, 123")])).collect() == []


@pytest.mark.parametrize("inner", [[], ["aa", "ab"], ["aa", "aaa", "ab", "aba", "abab", "ba", "bab", "baba", "aaaa", "bb"]])
def test_near_words_share_a_list(inner):
    """Of any two near words one of the merged lists is common at places at most one apart, unless the bound says nothing of both."""
    rng = random.Random(len(inner))
    grams = Grams(np.array([int.from_bytes(g.encode(), "big") for g in inner], np.uint64))
    frequency = np.random.default_rng(1).integers(0, 50, spelling.SLOTS)
    cache = {}

    def lists(w):
        if w not in cache:
            _, place, code, weak = postings_of(grams, np.frombuffer(w, np.uint8)[None, :], frequency)
            cache[w] = {(int(c), int(p)) for c, p in zip(code, place)}, bool(weak[0])
        return cache[w]

    bounded = 0
    for _ in range(4000):
        a = bytes(rng.choices(b"aaabbc", k=rng.randint(6, 12)))
        k, kind = rng.randrange(len(a) + 1), rng.randrange(3)
        b = a[:k] + (b"" if kind == 0 else bytes(rng.choices(b"abc", k=1))) + a[k + (kind != 1):]
        if a == b or len(b) < 6:
            continue
        assert one_edit(a, b)
        (x, weak), (y, also) = lists(a), lists(b)
        if not (weak and also):
            bounded += 1
            assert any((c, p + d) in y for c, p in x for d in (-1, 0, 1)), (a, b)
    assert bounded > 100
