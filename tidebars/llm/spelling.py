"""Spelling variants: frequent words that differ in one code point, found through an index of variable-length grams.

The gram dictionary starts from all grams of ``SHORTEST`` letters; a gram that is frequent among the words is replaced by its
extensions, up to ``LONGEST`` letters. A word is decomposed from left to right into the longest gram of the dictionary at
each place, without those that lie inside one before. For every place of the word it is counted how many of its grams an
edit there may affect: those that cover the place, those right of it that a gram across the place could take in, and an open gram at
the word's end. The largest of these counts bounds how many grams a near word can lack, so two near words share one of the
rarest ``bound + 1`` grams of each, at places that differ by one at most: only these lists are merged. What meets there is verified.

Where the bound takes in all grams of both words, the lists prove nothing; such words are also indexed by the shortest
grams alone, of which one edit leaves at least three. Words of over ``WIDE`` letters have two grams, their first and their last
half of ``WIDE`` letters (kept by hash), of which one edit affects one; words of ``WIDE`` letters have these too.

The dictionary only decides how long the lists are, never what is found; its inner grams are those with over one part in
``INNER`` of all grams, so there are at most ``INNER`` of each length, and the frequencies for "rarest" are kept by hash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebars.llm.common import bounded_batches, by_batch, mixed, name, word_hashes
from tidebars.llm.grouped import column, split_pairs, whole_groups
from tidebars.llm.runs import LOWER, cut_words, numbered, text_bytes
from tidebars.session import stage

SHORTEST, LONGEST = 2, 5  # letters of a gram
FREQUENT, INNER = 1000, 20_000  # a gram is extended if it is in more places than both FREQUENT and one part in INNER of all
SLOTS = 1 << 16  # of the frequencies by hash
WIDE = 64  # letters of words that are worked on together; longer ones come one by one
LIST = 2048  # words of a list before it is split
SMALL = 48  # lists up to this size are paired together

_ZERO = np.array([zlib.crc32(bytes([i])) ^ zlib.crc32(b"\0") for i in range(256)], np.uint32)  # a zero byte after each last byte


def _seeds(ids: list[str]) -> np.ndarray:
    """By document: its checksum before a word of 0 to WIDE bytes, to be combined with the word's by exclusive or."""
    out = np.zeros((len(ids), WIDE + 1), np.uint32)
    out[:, 0] = [zlib.crc32(f"{i}:".encode()) for i in ids]
    for k in range(WIDE):
        out[:, k + 1] = _ZERO[out[:, k] & 255] ^ (out[:, k] >> np.uint32(8))
    return out


def _letters(data: np.ndarray) -> np.ndarray:
    """Bytes of ASCII letters and of U+00C0 to U+00FF, which are those that begin with the byte C3."""
    ascii_letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    first = data == 0xC3
    second = np.zeros(len(data), bool)
    second[1:] = first[:-1]
    return ascii_letter | first | second


def _counted(every: int, least_length: int):
    """Rows ``id, text`` to ``word, n`` of a batch."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        data, offsets = text_bytes(batch.column(1))
        words, _, of = cut_words(LOWER[data], offsets, _letters(data))
        if not len(words):
            return None
        known, codes = numbered(words)
        listed = known.to_pylist()
        letters = pc.utf8_length(known.cast(pa.large_string())).to_numpy()
        size = np.fromiter(map(len, listed), np.int64, len(listed))
        own = np.fromiter(map(zlib.crc32, listed), np.uint32, len(listed))
        doc = np.repeat(np.arange(len(of)), of)
        ids = batch.column(0).to_pylist()
        h = _seeds(ids)[doc, np.minimum(size, WIDE)[codes]] ^ own[codes]
        for at in np.flatnonzero(size[codes] > WIDE).tolist():
            h[at] = zlib.crc32(listed[codes[at]], zlib.crc32(f"{ids[doc[at]]}:".encode()))
        hit = np.flatnonzero(h % every == 0)
        counts = np.bincount(codes, minlength=len(listed)) - np.bincount(codes[hit], minlength=len(listed))
        out = known.cast(pa.large_string()).cast(pa.string())
        keep = np.flatnonzero((letters >= least_length) & (counts > 0))
        long = hit[letters[codes[hit]] > least_length]
        place = h[long] % letters[codes[long]]
        cut: dict[str, int] = {}
        for code, p in zip(codes[long].tolist(), place.tolist()):
            word = listed[code].decode()
            word = word[:p] + word[p + 1:]
            cut[word] = cut.get(word, 0) + 1
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([out.take(pa.array(keep)), pa.array(list(cut), pa.string())]),
             pa.array(np.concatenate([counts[keep], np.fromiter(cut.values(), np.int64, len(cut))]))], names=["word", "n"])

    return by_batch(work)


def noisy_words(docs: DataFrame, id_col: str, text_col: str, every: int = 199, least_length: int = 6, least: int = 5) -> DataFrame:
    """``word, n``: different words of the texts with at least ``least_length`` letters and ``least`` occurrences.

    Words are maximal runs of ASCII letters and U+00C0 to U+00FF, capitals of ASCII lower-cased. If ``every`` divides the CRC-32 of
    ``<id>:<word>``, the letter at that checksum modulo the length is missing: the noise that variants are found by.
    """
    texts = docs.select(F.coalesce(name(id_col).cast("string"), F.lit("")).alias("id"), name(text_col).cast("string").alias("text"))
    words = texts.where("text <> ''").mapInArrow(_counted(every, least_length), "word string, n bigint")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of each length up to WIDE: their places, and their letters as a matrix."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(size[size <= WIDE]).tolist():
        at = np.flatnonzero(size == length)
        yield at, np.frombuffer(b"".join(words[i] for i in at.tolist()), np.uint8).reshape(len(at), length)


def gram_codes(letters: np.ndarray, size: int) -> np.ndarray:
    """The grams of ``size`` letters at each place, as numbers; a gram's number tells its length too."""
    n, length = letters.shape
    codes = np.zeros((n, max(0, length - size + 1)), np.uint64)
    for k in range(size if codes.shape[1] else 0):
        codes = (codes << np.uint64(8)) | letters[:, k:k + codes.shape[1]]
    return codes


def _within(sorted_codes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    if not len(sorted_codes):
        return np.zeros(codes.shape, bool)
    return sorted_codes[np.minimum(np.searchsorted(sorted_codes, codes), len(sorted_codes) - 1)] == codes


class Grams:
    """A gram dictionary, by its inner grams: those that are extended wherever a word goes on."""

    def __init__(self, inner: np.ndarray):
        self.inner = np.sort(inner.astype(np.uint64))
        tails = [self.inner[self.inner >= 256 ** k] & np.uint64(256 ** k - 1) for k in range(1, LONGEST - 1)]
        self.tails = np.unique(np.concatenate(tails))  # proper suffixes

    def decompose(self, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For words of one length, by word and place: the gram there, its length, whether it is kept, and whether it ends open."""
        n, length = letters.shape
        code = gram_codes(letters, SHORTEST)
        size = np.full(code.shape, SHORTEST)
        places = np.arange(code.shape[1])
        open_end = np.zeros(code.shape, bool)
        for q in range(SHORTEST, LONGEST):
            more = (size == q) & _within(self.inner, code)
            last = places + q == length
            open_end |= more & last
            more &= ~last
            longer = gram_codes(letters, q + 1)
            longer = np.pad(longer, ((0, 0), (0, code.shape[1] - longer.shape[1])))
            code, size = np.where(more, longer, code), np.where(more, q + 1, size)
        ends = places + size
        before = np.zeros(code.shape, np.int64)
        before[:, 1:] = np.maximum.accumulate(ends, axis=1)[:, :-1]
        return code, size, ends > before, open_end

    def affected(self, letters: np.ndarray, size: np.ndarray, kept: np.ndarray, open_end: np.ndarray) -> np.ndarray:
        """The most kept grams that one inserted, deleted or replaced letter can affect, at any place."""
        n, length = letters.shape
        places = np.arange(size.shape[1])
        ends = places + size
        tail = [_within(self.tails, gram_codes(letters, m)) for m in range(1, LONGEST - 1)]  # by length less one, at each place

        def taken(start: int) -> np.ndarray:
            """Kept grams at ``start`` or later that a gram from before ``start`` could take in: letters from there to its last but one end some inner gram."""
            out = np.zeros(n, np.int64)
            for p in range(start, min(size.shape[1], start + LONGEST)):
                for q in range(SHORTEST, LONGEST + 1):
                    m = p + q - 1 - start
                    if 1 <= m <= LONGEST - 2 and start + m <= length:
                        out += kept[:, p] & (size[:, p] == q) & tail[m - 1][:, start]
            return out

        most = np.zeros(n, np.int64)
        for i in range(length + 1):
            inserted = (kept & (places < i) & (ends > i)).sum(axis=1) + taken(i)
            if i == length:
                inserted += (kept & open_end).sum(axis=1)
            else:
                changed = (kept & (places <= i) & (ends > i)).sum(axis=1) + taken(i + 1)
                most = np.maximum(most, changed)
            most = np.maximum(most, inserted)
        return most


def _gram_counts(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Words to the number of places of each gram that may be inner."""
    found = [np.zeros(0, np.uint64)]
    for _, letters in _by_length(latin(batch.column(0))):
        found += [gram_codes(letters, q).ravel() for q in range(SHORTEST, LONGEST)]
    code, n = np.unique(np.concatenate(found), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array(n)], names=["gram", "n"])


def latin(words: pa.Array) -> list[bytes]:
    """One byte a letter."""
    return [w.encode("latin-1") for w in words.to_pylist()]


def _slots(code: np.ndarray) -> np.ndarray:
    return (mixed(code) & np.uint64(SLOTS - 1)).astype(np.int64)


def _slot_counts(inner: np.ndarray):
    """Words to the number of kept grams by slot."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        grams, counts = Grams(inner), np.zeros(SLOTS, np.int64)
        for _, letters in _by_length(latin(batch.column(0))):
            code, _, kept, _ = grams.decompose(letters)
            counts += np.bincount(_slots(code[kept]), minlength=SLOTS)
        slot = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays([pa.array(slot), pa.array(counts[slot])], names=["slot", "n"])

    return by_batch(work)


def postings_of(grams: Grams, letters: np.ndarray, frequency: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For words of one length: word, place and gram of the lists to be merged, and which words the bound says nothing about."""
    code, size, kept, open_end = grams.decompose(letters)
    bound = grams.affected(letters, size, kept, open_end)
    total = kept.sum(axis=1)
    rank = np.minimum(frequency[_slots(code)], (1 << 24) - 1).astype(np.uint64) << np.uint64(40) | code
    rank = np.where(kept, rank, np.uint64(2 ** 64 - 1))
    last = np.take_along_axis(np.sort(rank, axis=1), np.minimum(bound, total - 1)[:, None], axis=1)
    word, place = np.nonzero(kept & (rank <= last))  # all places of a chosen gram
    return word, place, code[word, place], bound >= total


def _postings(inner: np.ndarray, frequency: np.ndarray):
    """Rows ``word, n`` to ``gram, place, own, word, n, weak``: each list entry at its place, and as a visitor at the next."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        grams, weak, words = Grams(inner), np.zeros(batch.num_rows, bool), latin(batch.column(0))
        row, gram, place, own = [], [], [], []

        def add(rows: np.ndarray, codes: np.ndarray, places: np.ndarray, at_home: bool) -> None:
            row.append(rows)
            gram.append(codes)
            place.append(places)
            own.append(np.full(len(rows), at_home))

        for at, letters in _by_length(words):
            word, p, code, weak[at] = postings_of(grams, letters, frequency)
            add(at[word], code, p, True)
            add(at[word], code, p + 1, False)
        wide = [i for i, w in enumerate(words) if len(w) >= WIDE]
        for end, part in ((-1, slice(None, WIDE // 2)), (-2, slice(-(WIDE // 2), None))):
            add(np.array(wide, np.int64), word_hashes([words[i][part] for i in wide]), np.full(len(wide), end), True)
        row, gram, place, own = (np.concatenate(x) for x in (row, gram, place, own))
        at = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [pa.array(gram.view(np.int64)), pa.array(place.astype(np.int32)), pa.array(own), batch.column(0).take(at),
             batch.column(1).take(at), pa.array(weak[row])], names=["gram", "place", "own", "word", "n", "weak"])

    return by_batch(work)


class _Letters:
    """Letters of many words, from the left and from the right, and what of them tells words apart quickly."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        row = np.repeat(np.arange(len(words)), self.size)
        at = np.arange(len(flat)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        short = at < WIDE
        width = int(min(WIDE, self.size.max(initial=1)))
        self.left, self.right = np.zeros((2, len(words), width), np.uint8)
        self.left[row[short], at[short]] = flat[short]
        back = self.size[row] - 1 - at
        self.right[row[back < WIDE], back[back < WIDE]] = flat[back < WIDE]
        # 32 kinds of letters: a bit for one or more of a kind and a bit for two or more; one edit changes two bits at most
        kinds = np.bincount(row * 32 + (flat & 31), minlength=32 * len(words)).reshape(len(words), 32)
        bits = np.uint64(1) << np.arange(32, dtype=np.uint64)
        self.bag = ((kinds > 0) * bits).sum(axis=1, dtype=np.uint64) | ((kinds > 1) * bits).sum(axis=1, dtype=np.uint64) << np.uint64(32)

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether words differ by exactly one inserted, deleted or replaced letter."""
        longer = np.maximum(self.size[i], self.size[j])
        out = np.abs(self.size[i] - self.size[j]) <= 1
        left, right = self.left[i] != self.left[j], self.right[i] != self.right[j]
        same = np.where(left.any(axis=1), left.argmax(axis=1), self.left.shape[1])
        back = np.where(right.any(axis=1), right.argmax(axis=1), self.left.shape[1])
        fits = out & (same + back >= longer - 1) & (left.any(axis=1) | (self.size[i] != self.size[j]))
        for at in np.flatnonzero(out & (longer > WIDE)).tolist():
            fits[at] = one_edit(self.words[i[at]], self.words[j[at]])
        return fits


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced letter."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def _pairs(starts: np.ndarray, ends: np.ndarray, bag: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs of a list whose bags differ in two bits at most."""
    size = ends - starts
    small = size <= SMALL
    at = np.concatenate([np.arange(s, e) for s, e in zip(starts[small].tolist(), ends[small].tolist())]) if small.any() else np.zeros(0, np.int64)
    end = np.repeat(ends[small], size[small])
    for step in range(1, SMALL):
        inside = at + step < end
        at, end = at[inside], end[inside]
        if not len(at):
            break
        close = np.bitwise_count(bag[at] ^ bag[at + step]) <= 2
        yield at[close], at[close] + step
    for s, e in zip(starts[~small].tolist(), ends[~small].tolist()):
        for row in range(s, e, 512):
            i, j = np.nonzero(np.bitwise_count(bag[row:min(e, row + 512), None] ^ bag[None, s:e]) <= 2)
            i, j = i + row, j + s
            yield i[i < j], j[i < j]


def _near(table: pa.Table, starts: np.ndarray):
    """Lists to the near pairs ``a, n_a, b, n_b`` that meet in them."""
    own, bucket, low, high = (column(table, c).to_numpy(zero_copy_only=False) for c in ("own", "bucket", "low", "high"))
    letters = _Letters(latin(column(table, "word")))
    left, right = [], []
    for i, j in _pairs(starts, np.append(starts[1:], table.num_rows), letters.bag):
        fit = (own[i] | own[j]) & ((low[i] == high[i]) | (bucket[i] != bucket[j]))
        i, j = i[fit], j[fit]
        for at in range(0, len(i), 1 << 16):
            x, y = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
            fit = letters.near(x, y)
            left.append(x[fit])
            right.append(y[fit])
    if not left:
        return
    i, j = np.concatenate(left), np.concatenate(right)
    word, n = column(table, "word"), column(table, "n")
    if len(i):
        yield pa.RecordBatch.from_arrays([word.take(pa.array(i)), n.take(pa.array(i)), word.take(pa.array(j)), n.take(pa.array(j))],
                                         names=["a", "n_a", "b", "n_b"])


def near_words(words: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """All pairs ``a, n_a, b, n_b`` of ``words`` (``word, n``; ``word`` unique, staged) that differ by exactly one letter, once each, ``a < b``.

    Words have at least six letters, each in U+0001 to U+00FF.
    """
    freq = stage(words.select("word").mapInArrow(by_batch(_gram_counts), "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")))
    total = freq.where(F.col("gram") < 256 ** SHORTEST).agg(F.sum("n")).first()[0] or 0
    rows = freq.where(F.col("n") > max(frequent, total / INNER)).select("gram").collect()  # at most INNER of each length
    inner = np.array([r[0] for r in rows], np.uint64)

    def found(own: DataFrame, inner: np.ndarray) -> tuple[DataFrame, DataFrame]:
        slots = own.select("word").mapInArrow(_slot_counts(inner), "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
        frequency = np.zeros(SLOTS, np.int64)
        for slot, n in slots.collect():  # at most SLOTS
            frequency[slot] = n
        lists = stage(own.select("word", "n").mapInArrow(
            _postings(inner, frequency), "gram bigint, place int, own boolean, word string, n bigint, weak boolean"))
        dealt = split_pairs(lists.drop("weak"), ["gram", "place"], "word", LIST)
        return whole_groups(dealt, ["gram", "place", "low", "high"], _near, "a string, n_a bigint, b string, n_b bigint"), lists

    pairs, lists = found(words, inner)
    weak = stage(lists.where("weak").select("word", "n").distinct())
    pairs = pairs.unionByName(found(weak, np.zeros(0, np.uint64))[0])
    low = F.col("a") < F.col("b")

    def by_order(x: str, y: str) -> Column:
        return F.when(low, F.col(x)).otherwise(F.col(y))

    return pairs.select(by_order("a", "b").alias("a"), by_order("n_a", "n_b").alias("n_a"),
                        by_order("b", "a").alias("b"), by_order("n_b", "n_a").alias("n_b")).distinct()


def _roots(links: DataFrame) -> DataFrame:
    """``word, root`` for ``links`` (``word, form``): each round doubles the steps followed."""
    state, left = stage(links.select("word", F.col("form").alias("root"))), None
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        state = stage(state.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if state.where("moved").isEmpty():
            return state.select("word", "root")
        state = state.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 199, least_length: int = 6,
                      least: int = 5, times: int = 5) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of :func:`noisy_words`.

    ``n_near`` counts the words that differ from it by exactly one inserted, deleted or replaced letter. ``form`` is the most
    frequent of them (ties: the first in code-point order) if it occurs at least ``times`` as often, else null; ``root`` is where the forms end,
    the word itself without one.

    Null texts have no words; a null id counts as an empty one. Texts and words of any length are read whole. Repeated rows count each.
    Other columns don't matter. An empty table gives no rows.
    """
    if least_length < 6 or times < 2:
        raise ValueError("words need six letters, and a form must be more frequent than its word")
    bounded_batches(docs.sparkSession)
    words = stage(noisy_words(docs, id_col, text_col, every, least_length, least))
    pairs = stage(near_words(words))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("n_other")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("n_other")))
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_other")).alias("n"), "other")).alias("best"))
    rows = words.join(near, "word", "left")
    is_form = -F.col("best.n") >= times * F.col("n")
    rows = stage(rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(is_form, F.col("best.other")).alias("form"), F.when(is_form, -F.col("best.n")).alias("form_n")))
    roots = _roots(rows.where("form IS NOT NULL"))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
