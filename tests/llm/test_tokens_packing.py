"""Token files and packing against whole-text encoding."""

import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidebars.llm import packing, token_files
from tidebars.llm.packing import best_cuts, cut_points, pack_documents
from tidebars.llm.token_files import TokenFile, TokenWriter, decode_blocks, encode_blocks, read_documents, write_token_files
from tidebars.llm.token_files import token_files as round_trip
from tidebars.llm.tokens import Encoder

SPACES = [" ", "\n", "\t", "\r\n", "\x0b", "\x0c", "  ", " ", " ", "\x1c", "\x85", ""]
PIECES = ["Hello", "H̱i", "x…!", "5.!", "it's.", "a'.", "\"So\"", "(b)", "word***", "é.", "…", "¿Qué?", "x²!", "Ⅷ.", "word<|endoftext|>!",
          "<|endoftext|>,", "K", "ΑΣ.", "İ..", "क़!", "שׁ.", "ÿ..", "1,5", "..", "e\u0301,", "wörld", "don't", "it's", "123", "4.5", "<|endoftext|>", "é", "́x", "ß", "İ", "ΣΑΣ", "日本", "!?", "…", "a-b", "'s",
          "<|startoftext|>x", "한", "🙂", "ﬁ", "²", "٣", "_", "</w>", "​", "﻿"]


def texts(seed, n=60):
    rng = random.Random(seed)
    out = ["".join(rng.choice(PIECES) + rng.choice(SPACES) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return out + ["", None, " \n ", "long. " * 6000, "nodots " * 9000]


def whole(tokenizer, rows, end):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer)
    return [np.append(t.encode(x or "", add_special_tokens=False).ids, end).astype("<u4") for x in rows]


def test_encoder_equals_whole_text(tokenizer):
    rows = texts(1, 400)
    got = Encoder(tokenizer).ids(pa.array(rows, pa.string()), 9)
    for t, (ids, _), want in zip(rows, got, whole(tokenizer, rows, 9)):
        assert ids.tolist() == want.tolist(), t


def test_memory_is_bounded(tokenizer):
    encoder = Encoder(tokenizer)
    encoder.table.limit = 3
    rows = [f"word{i} again{i}" for i in range(20)]
    for t, want in zip(rows, whole(tokenizer, rows, 0)):
        assert next(encoder.ids(pa.array([t]), 0))[0].tolist() == want.tolist()
        assert len(encoder.table.index) <= 8


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 128 * 600 + 5])
@pytest.mark.parametrize("high", [1, 2, 50_000, 2 ** 32])
def test_blocks_round_trip(n, high):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
    if n:
        ids[rng.integers(0, n, 3)] = high - 1
    blocks = encode_blocks(ids)
    starts = np.cumsum([0, *map(len, blocks)])[:-1]
    assert np.array_equal(decode_blocks(b"".join(blocks) or b"\0", np.array(starts, np.uint64)), ids) if n else not blocks


def test_outliers_are_exceptions():
    ids = np.full(128, 7, np.uint32)
    ids[5] = 40_000
    assert len(encode_blocks(ids)[0]) == 8 + 1 + 4


def test_random_access(tmp_path):
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 50_000, k).astype(np.uint32) for k in (5, 0, 70_000, 128, 3)]
    writer = TokenWriter(str(tmp_path), "x.pfor", pa.string())
    for k, p in enumerate(parts):
        writer.add([f"id{k}"], [len(p)], p)
    file = TokenFile(writer.close())
    ids = np.concatenate(parts)
    for a, b in [(0, len(ids)), (0, 0), (4, 6), (60_000, 65_537), (127, 129), (len(ids) - 1, len(ids))]:
        assert np.array_equal(file.read(a, b), ids[a:b])
    assert file.documents.column("n_tokens").to_pylist() == [5, 0, 70_000, 128, 3]
    (tmp_path / "bad").write_bytes(b"x" * 100)
    with pytest.raises(ValueError):
        TokenFile(str(tmp_path / "bad"))


def test_files_hold_all_documents_in_order(docs, tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "READ_IDS", 100)
    rows = list(enumerate(texts(2)))
    random.Random(3).shuffle(rows)
    rows[5] = (None, rows[5][1])
    got = round_trip(docs(rows), tokenizer, end=1).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    want, at = [], 0
    for (key, _), ids in zip(ordered, whole(tokenizer, [t for _, t in ordered], 1)):
        want.append((key, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_repeated_rows_and_empty_table(docs, tokenizer):
    files = write_token_files(docs([(1, "a"), (1, "a"), (2, None)]), tokenizer)
    assert sorted(r["start"] for r in read_documents(files).collect()) == [0, 2, 4]
    assert round_trip(docs([]), tokenizer).collect() == []


def check_pieces(got, rows, tokenizer, size):
    ids = whole(tokenizer, [t for _, t in rows], 2)
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by_doc[r["id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for (key, _), own in zip(rows, ids):
        at = 0
        for r in sorted(by_doc[key], key=lambda r: r["start"]):
            piece = own[at:at + r["length"]]
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(own), zlib.crc32(piece.tobytes()))
            assert r["ids"] == piece.tolist()
            at += r["length"]
        assert at == len(own)
    padding = 0
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding / max(1, sum(map(len, ids)))


@pytest.mark.parametrize("size, stream", [(4096, 1 << 19), (4096, 9000), (512, 2000), (16, 100)])
def test_every_id_in_one_piece(docs, tokenizer, monkeypatch, size, stream):
    monkeypatch.setattr(packing, "STREAM", stream)
    rows = list(enumerate(texts(7)))
    got = pack_documents(docs(rows), tokenizer, size=size, with_ids=True).collect()
    assert check_pieces(got, rows, tokenizer, size) < 0.05


def test_packing_edges(docs, tokenizer):
    assert pack_documents(docs([]), tokenizer).collect() == []
    got = pack_documents(docs([(None, "a b"), (1, None), (1, None)]), tokenizer).collect()
    assert sorted((r["id"] is None, r["doc_tokens"], r["start"], r["length"]) for r in got if r["id"] is not None) == [(False, 1, 0, 1)] * 2
    assert {r["doc_tokens"] for r in got if r["id"] is None} == {3} and sum(r["length"] for r in got) == 5


def test_cuts_are_the_cheapest(monkeypatch):
    monkeypatch.setattr(packing, "SHORT", 2)
    rng = random.Random(5)
    for _ in range(200):
        size = rng.choice([8, 16])
        points = [0]
        while len(points) < 15:
            points.append(points[-1] + rng.randint(1, size))
        penalty = [0.0] + [float(rng.randint(0, 9)) for _ in points[1:]]

        def pad(n):
            return 0 if n & (n - 1) == 0 else size - n

        cost = [0.0]
        for j in range(1, len(points)):
            cost.append(penalty[j] + min(
                cost[i] + (pad(points[j] - points[i]) if points[j] - points[i] > 1 else size - 1)
                for i in range(j) if points[j] - points[i] <= size))
        cuts = best_cuts(points, penalty, size, True)
        total = sum(penalty[b] + (pad(points[b] - points[a]) if points[b] - points[a] > 1 else size - 1) for a, b in zip(cuts, cuts[1:]))
        assert total == cost[-1]


def test_cut_points_cover_long_sentences():
    points, cost = cut_points(5000, np.array([5000]), np.zeros(0, np.int64), 4096)
    assert points[0] == 0 and points[-1] == 5000 and max(np.diff(points)) <= 256
    points, cost = cut_points(300, np.array([100, 300]), np.array([40, 41, 200]), 4096)
    assert dict(zip(points, cost))[100] == 0 and 41 in points and 40 not in points
