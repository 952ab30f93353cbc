"""Phrases that stand together more often than their parts would, from stripes of next words.

A stripe belongs to a prefix (of no to four words) and counts the words that follow it. Every batch of texts makes its own
stripes; those of a prefix are merged element by element. What is asked is read off the merged stripes: an entry is the number of times a phrase
occurs, the sum of the empty prefix's is the number of words, and the largest entry tells whether a longer
phrase takes the prefix's place (entries under the least count play no part in that, as a longer phrase counts if it
is as frequent as a candidate).

A phrase is frequent only if its parts are. So words are counted first, then pairs of frequent words, then all longer
phrases whose pairs are frequent. Tasks ask a bitmap of fixed size whether a word or pair is frequent; where the bitmap errs, it lets
an infrequent one pass, whose count is then dropped: with more words than bits the work grows, the result stays.

Prefixes whose first word makes up a thousandth of all words, at most a thousand, and the empty one have their
stripes dealt over ``PARTS`` segments by next word. Between tasks the stripes of a batch travel packed: those of a bucket of prefixes
are one compressed row, a line for each stripe.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebars.llm.common import bounded_batches, mixed, name
from tidebars.llm.grouped import column, whole_groups
from tidebars.llm.runs import LOWER, cut_words, numbered, text_bytes
from tidebars.session import stage

BITS = 25  # of a place in a bitmap: 4 MB
PARTS = 256
SHARE = 1000  # a word is hot if it makes up one part in so many
SALT = 32  # parts in which the phrases of a language are ranked before the rest
WORD, BLANK, END = 0, 1, 2
KIND = np.zeros(256, np.uint8)
KIND[list(b" \t")] = BLANK
KIND[list(b".,;:!?\n\x0b\x0c\r")] = END
PACKED = "lang string, bucket int, stripes binary"
BLANKS, TABS, LINES = (pa.scalar(x, pa.large_binary()) for x in (b" ", b"\t", b"\n"))
PENDING = 64  # packed rows of a bucket that wait before they are merged


def _digest(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text, 42)


def _place(lang: Column, *words: Column) -> Column:
    """The place of a word or a pair of words in its bitmap, as :func:`_places` has it."""
    mixed = F.xxhash64(lang)
    for i, word in enumerate(reversed(words)):
        mixed = mixed.bitwiseXOR(F.shiftleft(F.xxhash64(word), 7 * i))
    return mixed.bitwiseAND(F.lit((1 << BITS) - 1))


def _places(lang: np.uint64, *words: np.ndarray) -> np.ndarray:
    mixed = lang
    for i, word in enumerate(reversed(words)):
        mixed = mixed ^ (word << np.uint64(7 * i))
    return mixed & np.uint64((1 << BITS) - 1)


def _has(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bitmap[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _bitmap(places: DataFrame) -> np.ndarray:
    """The bits of column ``place``: at most 1,024 rows of 4 KB come to the driver."""
    rows = places.groupBy(F.shiftright("place", 15).alias("row")).agg(F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit(32767))).alias("bits"))
    out = np.zeros((1 << (BITS - 15), 4096), np.uint8)
    for row, bits in rows.collect():
        out[row] = np.frombuffer(bytes(bits), np.uint8)
    return out.ravel()


class _Words:
    """The words of texts of one language: their numbers in order, and the piece that each stands in."""

    def __init__(self, texts: pa.Array):
        data, offsets = text_bytes(texts)
        data = LOWER[data]
        kind = KIND[data]
        words, begin, of = cut_words(data, offsets, kind == WORD)
        self.known, self.codes = numbered(words)
        ends = np.flatnonzero(kind == END)
        # both numbers grow along the texts: pieces differ if either does
        self.piece = np.searchsorted(ends, begin) + np.repeat(np.arange(len(of)), of)
        self.hashes = np.fromiter(map(_digest, self.known.to_pylist()), np.uint64, len(self.known))

    def text(self, starts: np.ndarray, size: int) -> pa.Array:
        """The phrases of ``size`` words that begin at ``starts``."""
        if not size:
            return pa.array([b""] * len(starts), pa.large_binary())
        words = [self.known.take(pa.array(self.codes[starts + i])) for i in range(size)]
        return words[0] if size == 1 else pc.binary_join_element_wise(*words, BLANKS)


def _stripes(words: _Words, lang: str, size: int, at: np.ndarray, prefix: np.ndarray, known: dict | None, buckets: int) -> pa.RecordBatch:
    """Packed stripes of prefixes of ``size`` words: ``prefix`` numbers those that begin at ``at``."""
    n = max(1, len(words.known))
    entry, first, count = np.unique(prefix * n + words.codes[at + size], return_index=True, return_counts=True)
    prefix, next_word, start = entry // n, entry % n, at[first]
    part = np.zeros(len(entry), np.uint64)
    if not size or known["hot"]:
        part = words.hashes[next_word] % np.uint64(PARTS)
    if size:
        hot = np.fromiter(((lang, w.decode()) in known["hot"] for w in words.known.to_pylist()), bool, len(words.known))
        part = np.where(hot[words.codes[start]], part, np.uint64(0))
    home = part
    for i in range(size):
        home = mixed(home ^ words.hashes[words.codes[start + i]])
    bucket = (mixed(home) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((next_word, part, prefix, bucket))
    bucket, prefix, part, next_word, start, count = (x[order] for x in (bucket, prefix, part, next_word, start, count))
    new = np.flatnonzero(np.r_[True, (prefix[1:] != prefix[:-1]) | (part[1:] != part[:-1])])
    following = pa.LargeListArray.from_arrays(pa.array(np.r_[new, len(entry)]), words.known.take(pa.array(next_word)))
    lines = pc.binary_join_element_wise(words.text(start[new], size), pc.binary_join(following, BLANKS), TABS)
    return _packed(lang, bucket[new], lines, np.r_[new, len(entry)], count)


def _packed(lang: str, bucket: np.ndarray, lines: pa.Array, offsets: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
    """A row for each bucket of lines that stand together: their counts and the lines, compressed."""
    begin = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    texts = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(np.r_[begin, len(bucket)]), lines), LINES)
    bounds = offsets[np.r_[begin, len(bucket)]].tolist()
    pack = zstandard.ZstdCompressor(level=3).compress
    rows = [pack(np.int64(e - s).tobytes() + count[s:e].astype(np.int64).tobytes() + text.as_py())
            for s, e, text in zip(bounds, bounds[1:], texts)]
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(begin), pa.string()), pa.array(bucket[begin].astype(np.int32)), pa.array(rows, pa.binary())],
        names=["lang", "bucket", "stripes"])


def _unpacked(rows: list[bytes]) -> tuple[pa.Array, np.ndarray, pa.Array, np.ndarray]:
    """The stripes of packed rows: prefixes, numbers of entries, and of all entries the words and the counts."""
    unpack = zstandard.ZstdDecompressor().decompress
    counts, texts = [], []
    for row in rows:
        plain = unpack(row)
        end = 8 + 8 * int(np.frombuffer(plain, np.int64, 1)[0])
        counts.append(np.frombuffer(plain[8:end], np.int64))
        texts.append(plain[end:])
    lines = pc.split_pattern(pa.array([b"\n".join(texts)], pa.large_binary()).cast(pa.large_string()), "\n").flatten()
    parts = pc.split_pattern(lines, "\t", max_splits=1).flatten()
    even = np.arange(0, len(parts), 2)
    following = pc.split_pattern(parts.take(pa.array(even + 1)), " ")
    return parts.take(pa.array(even)), pc.list_value_length(following).to_numpy().astype(np.int64), following.flatten(), np.concatenate(counts)


def _count(sizes: range, known_in, buckets: int):
    """Rows ``lang, text`` to the stripes of prefixes of the given sizes."""

    def work(batches):
        known = known_in.value if known_in is not None else None
        for batch in batches:
            langs, texts = batch.column(0), batch.column(1)
            for lang in pc.unique(langs).to_pylist():
                words = _Words(texts.filter(pc.equal(langs, lang)))
                if len(words.codes):
                    yield from _of_sizes(words, lang, sizes, known, buckets)

    return work


def _of_sizes(words: _Words, lang: str, sizes: range, known: dict | None, buckets: int):
    everywhere = np.arange(len(words.codes))
    if sizes[0] == 0:
        yield _stripes(words, lang, 0, everywhere, np.zeros(len(everywhere), np.int64), known, buckets)
        return
    own = np.uint64(_digest(lang.encode()))
    frequent = _has(known["words"], _places(own, words.hashes))[words.codes]
    pair = np.flatnonzero(frequent[:-1] & frequent[1:] & (words.piece[:-1] == words.piece[1:]))
    if sizes[0] == 1:
        if len(pair):
            yield _stripes(words, lang, 1, pair, words.codes[pair], known, buckets)
        return
    a, b = words.hashes[words.codes[pair]], words.hashes[words.codes[pair + 1]]
    pair = pair[_has(known["pairs"], _places(own, a, b))]
    linked = np.zeros(len(everywhere) + 1, bool)
    linked[pair] = True
    at, number = pair, np.unique(words.codes[pair] * len(words.known) + words.codes[pair + 1], return_inverse=True)[1]
    for size in sizes:  # ``at`` has the places of the prefixes whose pairs are all frequent
        more = linked[at + size - 1]
        at, number = at[more], number[more]
        if not len(at):
            return
        yield _stripes(words, lang, size, at, number, known, buckets)
        number = np.unique(number * len(words.known) + words.codes[at + size], return_inverse=True)[1]


def _merged(rows: list[bytes]) -> tuple[pa.Array, np.ndarray, pa.Array, np.ndarray]:
    """Stripes merged element by element: the prefixes, and of all entries, by prefix, the prefix's number, the word and the count."""
    prefixes, lengths, words, counts = _unpacked(rows)
    prefixes, number = numbered(prefixes)
    known, code = numbered(words)
    n = max(1, len(known))
    entry, at = np.unique(np.repeat(number, lengths) * n + code, return_inverse=True)
    total = np.zeros(len(entry), np.int64)
    np.add.at(total, at, counts)
    return prefixes, entry // n, known.take(pa.array(entry % n)), total


def _shrink(table: pa.Table) -> pa.Table:
    """Packed rows of one bucket as one."""
    if table.num_rows < PENDING:
        return table
    prefixes, number, words, f = _merged(column(table, "stripes").to_pylist())
    offsets = np.searchsorted(number, np.arange(len(prefixes) + 1))
    following = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets), words.cast(pa.large_binary())), BLANKS)
    lines = pc.binary_join_element_wise(prefixes.cast(pa.large_binary()), following, TABS)
    lang, bucket = table.column("lang")[0].as_py(), table.column("bucket")[0].as_py()
    return pa.Table.from_batches([_packed(lang, np.full(len(lines), bucket), lines, offsets, f)]).cast(table.schema)


def _merge(least: int):
    """Packed stripes to merged ones with the entries of at least ``least``; ``total`` is the sum of all entries."""

    def work(table: pa.Table, starts: np.ndarray):
        packed, langs = column(table, "stripes"), column(table, "lang")
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows]):
            prefixes, number, words, f = _merged(packed.slice(s, e - s).to_pylist())
            total = np.bincount(number, weights=f, minlength=len(prefixes)).astype(np.int64)
            keep = np.flatnonzero(f >= least)
            offsets = np.searchsorted(number[keep], np.arange(len(prefixes) + 1)).astype(np.int32)
            size = np.where(pc.equal(prefixes, "").to_numpy(zero_copy_only=False), 0, pc.count_substring(prefixes, " ").to_numpy() + 1)
            some = np.flatnonzero((np.diff(offsets) > 0) | (size == 0))
            if not len(some):
                continue
            lists = (pa.ListArray.from_arrays(pa.array(offsets), x) for x in (words.take(pa.array(keep)).cast(pa.string()), pa.array(f[keep])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([langs[s].as_py()] * len(some), pa.string()), prefixes.take(pa.array(some)).cast(pa.string()), pa.array(size[some].astype(np.int32)),
                 *[x.take(pa.array(some)) for x in lists], pa.array(total[some])], names=["lang", "prefix", "size", "next", "f", "total"])

    return work


def stripes(texts: DataFrame, sizes: range, least: int, known: dict | None) -> DataFrame:
    """Merged stripes of ``texts`` (``lang, text``): ``lang, prefix, size, next, f, total``.

    ``known`` is what the counts before have shown: bitmaps of frequent ``words`` and ``pairs``, and the ``hot`` words by language.
    """
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(known) if known is not None else None  # bitmaps of fixed size and at most SHARE words
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))  # some for each task that merges
    local = texts.mapInArrow(_count(sizes, shared, buckets), PACKED)
    return stage(whole_groups(
        local, ["lang", "bucket"], _merge(least),
        "lang string, prefix string, size int, next array<string>, f array<bigint>, total bigint", _shrink))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 5, least: int = 100, top: int = 2000,
                 share: int = 100) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language.

    A phrase has 2 to ``longest`` words of one piece of text (pieces end at ``. , ; : ! ?`` and line ends) and occurs at least
    ``least`` times (``a``). Its score is that of its weakest cut, ``floor(1000 a n / (l r))`` with the counts ``l`` and ``r`` of the parts and the
    number ``n`` of all words of the language. It is left out if it lies in a longer one that occurs ``share`` percent as often. Equal scores go by ``a``, then by the phrase.

    ASCII letters are lower-cased. A null text is empty, a null language is ``und``. Repeated rows count each; texts of any length are
    read whole. Other columns don't matter. An empty table, or one without frequent phrases, gives no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.coalesce(name(lang_col).cast("string"), F.lit("und")).alias("lang"), name(text_col).cast("string").alias("text")).where("text <> ''")

    def inline(merged: DataFrame) -> DataFrame:
        """``lang, prefix, size`` and the entries ``word, f`` of stripes."""
        return merged.select("lang", "prefix", "size", F.inline(F.arrays_zip(F.col("next").alias("word"), "f")))

    empty = stripes(texts, range(0, 1), least, None)
    n = stage(empty.groupBy("lang").agg(F.sum("total").alias("n")))
    words = inline(empty)
    everything = n.agg(F.sum("n")).first()[0] or 0
    hot = words.where(F.col("f") >= max(1, everything // SHARE)).select("lang", "word").collect()  # at most SHARE words, or a few more by rounding
    known = {"words": _bitmap(words.select(_place(F.col("lang"), F.col("word")).alias("place"))), "hot": {tuple(x) for x in hot}}

    pairs = stripes(texts, range(1, 2), least, known)
    frequent = inline(pairs)
    place = _place(F.col("lang"), F.col("prefix"), F.col("word")).alias("place")
    merged = pairs.unionByName(empty)
    if longest > 2:
        known = known | {"pairs": _bitmap(frequent.select(place))}
        merged = merged.unionByName(stripes(texts, range(2, longest), least, known))

    phrase = F.when(F.col("size") == 0, F.col("word")).otherwise(F.concat_ws(" ", "prefix", "word"))
    counts = stage(inline(merged).select("lang", "prefix", (F.col("size") + 1).alias("size"), phrase.alias("phrase"), "f"))
    return _ranked(counts, n, top, share)


def _ranked(counts: DataFrame, n: DataFrame, top: int, share: int) -> DataFrame:
    """The best phrases from ``counts`` (``lang, prefix, size, phrase, f``)."""
    suffix = F.expr("substring_index(phrase, ' ', 1 - size)")
    longer = counts.where("size > 2")
    most = longer.select("lang", F.col("prefix").alias("phrase"), "f").unionByName(
        longer.select("lang", suffix.alias("phrase"), "f")).groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    phrases = counts.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a")).join(most, ["lang", "phrase"], "left").where(
        F.coalesce(100 * F.col("most") < share * F.col("a"), F.lit(True))).drop("most")

    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.selectExpr("*", "substring_index(phrase, ' ', k) AS left", "substring_index(phrase, ' ', k - size) AS right")
    parts = counts.select("lang", "phrase", "f")
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]).join(
        parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]).join(n, "lang")
    big = "decimal(19,0)"  # of counts; products of two have 38 digits
    scored = F.expr(f"((cast(a AS {big}) * cast(n AS decimal(16,0))) * cast(1000 AS decimal(4,0))) div (cast(l AS {big}) * cast(r AS {big}))")
    best = cuts.withColumn("score", scored).groupBy("lang", "phrase").agg(
        F.min_by(F.struct("a", "l", "r", "n", "score"), F.struct("score", "k")).alias("cut")).select("lang", "phrase", "cut.*")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALT))
    first = Window.partitionBy("lang", salt).orderBy(*order)
    best = best.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")  # at most SALT * top rows
    return best.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
