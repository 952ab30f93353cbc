"""Benchmark decontamination by template canonicalisation.

Texts become tokens; numbers, units and names are replaced by typed placeholders, so that a question with other
numbers or names has the same template. Windows of ``window`` template tokens are joined by hash, compared as texts, and
lined up by document, item and offset. Windows whose slots are empty or equal are a plain copy and always a leak. Other windows
count in runs in which each value of the item stands for one value of the document, over ``RUN`` tokens or the whole item:
a date and a place with the words between them are no leak. Windows with few words are joined without placeholders.

Names are known by their capital letter, which sentence starts and texts in lower case hide. Two templates are
therefore joined: ``cased`` with names as placeholders, and ``plain`` with names as lower-case words.

Windows of documents are made in the scan and met there by a bitmap of fixed size over the benchmark's hashes; only
windows that pass are joined, so any size of benchmark is handled in the same way.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebars.llm.common import CodeTable, Rolling, bounded_batches, by_batch, name, packed, split_words, tidy, unpacked
from tidebars.session import stage

WINDOW = 8  # template tokens
LITERAL = 4  # of them that must be words; windows with fewer are joined as they are, without placeholders
COPY = 2  # the form of these
RUN = 2 * WINDOW  # template tokens (or the whole item) that a run with other values must cover
BITS = 24  # the bitmap has 2 ** BITS bits
PART = 1 << 16  # words whose templates are in memory at once, or those of one text
#: Words taken as units after a number, and words that start sentences and are no names.
UNITS = frozenset(
    "% $ € £ ¥ mm cm m km mg g kg t ml l s sec second seconds min minute minutes h hr hour hours day days week weeks month "
    "months year years inch inches ft foot feet yard yards mile miles oz ounce ounces lb lbs pound pounds ton tons dollar "
    "dollars cent cents euro euros percent degree degrees litre litres liter liters meter meters metre metres gram grams "
    "mph kmh watt watts volt volts".split())
OPENERS = frozenset(
    "a an the in on at of for from by with and or but if when while how what who which where why is are was were it he she they "
    "we you i this that these those there then each every all some to as after before find compute calculate suppose let given "
    "der die das ein eine im in und wenn wie was le la les un une et si el los las y o en de se que".split())
NUMBERS = frozenset("one two three four five six seven eight nine ten eleven twelve hundred thousand million".split())
#: Punctuation after a word that is no token, and how a sentence ends.
OUTER = "!\"#&'()*+,-./:;<=>?@[\\]^_`{|}~"
SENTENCE_END = r"[.!?:][\"')\]»”]*$"
_PIECE = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+(?:['’-][^\W\d_]+)*|[%$€£¥]", re.UNICODE)
WORD, NUMBER, UNIT, CAPITAL, OPENER = range(5)  # kinds of a token; a capital one may be a name
_SPECIAL = {kind: xxhash.xxh64_intdigest(b"\0" + bytes([kind])) for kind in (NUMBER, UNIT, CAPITAL)}


def _token(text: str) -> tuple[int, str]:
    low = text.lower()
    if text[0].isdigit() or low in NUMBERS:
        return NUMBER, low
    if low in UNITS:
        return UNIT, low
    if text[0].isupper():
        return (OPENER if low in OPENERS else CAPITAL), low
    return WORD, low


def tokens_of(word: str) -> list[tuple[int, str]]:
    """``kind, text`` of the tokens of a run without white space; punctuation is left out."""
    letters = word.rstrip(".,")
    if letters.isalpha():  # one token, as most words are
        return [_token(letters)]
    return [_token(m[0]) for m in _PIECE.finditer(word)]


def _packed_tokens(word: str) -> list[int]:
    """For each token two values: hash of the lower-case text, and kind."""
    if word.isalpha():  # one token, as most words are
        kind, low = _token(word)
        return [xxhash.xxh64_intdigest(low), kind]
    return [v for kind, low in tokens_of(word) for v in (xxhash.xxh64_intdigest(low), kind)]


def code_table() -> CodeTable:
    return CodeTable(lambda words: [_packed_tokens(w) for w in words], dtype=np.uint64)


class Template:
    """The two templates of some texts, one text after the other, from the numbers of their words and where sentences end.

    ``forms`` yields for each, and for the tokens as they are (``COPY``): its number, code of each template token, place of the
    token it begins at, whether it is a slot (of the plain template, in ``COPY``), and the text it is of. ``first``: where each text's tokens begin.
    """

    def __init__(self, numbers: np.ndarray, over: np.ndarray, offsets: np.ndarray, table: CodeTable):
        values = table.spread(numbers)
        ends = np.concatenate([[0], np.cumsum(table.length[numbers] // 2)])
        self.first = ends[offsets]
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        codes, kind = values[0::2], values[1::2].astype(np.int8)
        n = len(kind)
        stop = np.zeros(n + 1, bool)  # a sentence ends after the token; the last place takes words before the first one
        stop[ends[1:][over] - 1] = True
        stop = stop[:n]
        joined = text[1:] == text[:-1]  # the next token is of the same text
        number, unit, names = kind == NUMBER, kind == UNIT, kind == CAPITAL
        beside = np.zeros(n, bool)  # a unit counts as one next to a number only
        beside[1:] |= number[:-1] & joined
        beside[:-1] |= number[1:] & joined
        unit &= beside
        plain = codes.copy()
        plain[number], plain[unit] = _SPECIAL[NUMBER], _SPECIAL[UNIT]
        cased = plain.copy()
        cased[names] = _SPECIAL[CAPITAL]
        keep = np.ones(n, bool)  # of a run of names the first
        keep[1:] = ~(names[1:] & names[:-1] & ~stop[:-1] & joined)
        slot = number | unit
        self._forms = [
            (0, plain, np.arange(n), slot, text), (1, cased[keep], np.flatnonzero(keep), (slot | names)[keep], text[keep]),
            (COPY, codes, np.arange(n), slot, text)]

    def forms(self):
        return self._forms


def templates(texts: pa.Array, table: CodeTable):
    """The templates of a batch, ``PART`` words or one text at a time, each after the number of texts before it.

    What holds for a word wherever it stands is found once for the whole batch; the arrays of one part at a time take memory.
    """
    known, at, offsets = split_words(texts)
    bodies = pc.ascii_rtrim(known, characters=OUTER).dictionary_encode()
    table.trim()
    numbers = table.codes([bodies.dictionary.to_pylist()])[0][np.asarray(bodies.indices)]
    over = np.asarray(pc.match_substring_regex(known, SENTENCE_END).to_numpy(zero_copy_only=False), bool)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + PART, "right")) - 1)
        words = at[offsets[row]:offsets[stop]]
        yield row, Template(numbers[words], over[words], offsets[row:stop + 1] - offsets[row], table)
        row = stop


def starts_of(slot: np.ndarray, text: np.ndarray, size: int, form: int) -> np.ndarray:
    """Starts of the windows of ``size`` tokens of one text: with enough words among them, or, of ``COPY``, the others."""
    if len(slot) < size or not size:
        return np.zeros(0, np.int64)
    words = np.concatenate([[0], np.cumsum(~slot)])
    whole = text[size - 1:] == text[:len(text) - size + 1]
    return np.flatnonzero(whole & ((words[size:] - words[:-size] >= min(LITERAL, size)) != (form == COPY)))


def _shape(words: list[str], slot: np.ndarray, at: np.ndarray, start: int, stop: int) -> tuple[str, list[str]]:
    """The template text of the template tokens from ``start`` to ``stop`` (slots as ``#``) and the values in its slots.

    ``at`` has the place in ``words`` of every template token of the text, and the end.
    """
    text, slots = [], []
    for k in range(start, stop):
        own = " ".join(words[int(at[k]):int(at[k + 1])])
        if slot[k]:
            slots.append(own)
            text.append("#")
        else:
            text.append(own)
    return " ".join(text), slots


def _scan(sizes: list[int], bitmap: np.ndarray | None, item_sizes: bool):
    """Texts to windows ``key, size, form, start, hash, shape, slots``; only hashes in the bitmap, if there is one.

    ``item_sizes``: a text with fewer than ``WINDOW`` template tokens is one window.
    """
    schema = pa.schema([("key", pa.int64()), ("size", pa.int32()), ("form", pa.int32()), ("start", pa.int32()),
                        ("hash", pa.int64()), ("shape", pa.string()), ("slots", pa.list_(pa.string())), ("tokens", pa.int32())])

    @tidy
    def work(batches):
        table = code_table()
        for batch in batches:
            if not batch.num_rows:
                continue
            out, words = [], {}
            for first, template in templates(batch.column(1), table):
                n_texts = len(template.first) - 1
                for form, own, at, slot, text in template.forms():
                    begin = np.searchsorted(text, np.arange(n_texts + 1))  # of each text's template tokens
                    lengths = np.diff(begin)
                    rolling = None
                    for size in (np.unique(np.minimum(lengths, WINDOW)).tolist() if item_sizes else sizes):
                        starts = starts_of(slot, text, size, form)
                        if not len(starts):
                            continue
                        rolling = rolling or Rolling(own)
                        hashes = rolling.of(starts, size) if form == COPY else rolling.all(size)[starts]
                        hashes ^= np.uint64(form * 0x5851F42D4C957F2D % (1 << 64))
                        if bitmap is not None:
                            low = hashes & np.uint64((1 << BITS) - 1)
                            hit = (bitmap[low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                        else:
                            hit = np.minimum(lengths[text[starts]], WINDOW) == size
                        starts, hashes = starts[hit], hashes[hit]
                        for s, h in zip(starts.tolist(), hashes.view(np.int64).tolist()):
                            row = int(text[s])
                            if first + row not in words:
                                line = batch.column(1)[first + row].as_py() or ""
                                words[first + row] = [t for w in re.split(r"[ \t-\r]+", line) for _, t in tokens_of(w)]
                            a, b = int(begin[row]), int(begin[row + 1])
                            places = np.append(at[s:s + size + 1] if s + size < b else at[s:b], template.first[row + 1:row + 2] if s + size >= b else [])
                            shape, slots = _shape(words[first + row], slot[s:s + size] & (form != COPY), places - template.first[row], 0, size)
                            out.append((batch.column(0)[first + row].as_py(), size, form, s - a, h, shape, slots, b - a))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return work


_COLUMNS = "key bigint, size int, form int, start int, hash bigint, shape string, slots array<string>, tokens int"


def _bitmap(items: DataFrame) -> np.ndarray:
    """Which hashes the benchmark has, a bit for each, by their last ``BITS`` bits; as many rows at most as the bitmap has words."""
    low = F.col("hash").bitwiseAND((1 << BITS) - 1)
    words = items.select(F.shiftright(low, 6).alias("word"), F.expr("shiftleft(1L, cast(hash & 63 as int))").alias("bit"))
    out = np.zeros(1 << (BITS - 6), np.uint64)
    for r in words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toLocalIterator():
        out[r["word"]] = np.uint64(r["bits"] % (1 << 64))
    return out.astype("<u8").view(np.uint8)


def _run(windows: list[tuple[int, list[tuple[str, str]]]], size: int, need: int) -> tuple[int, int, bool] | None:
    """``n_windows, n_tokens, exact`` of the longest run of a line that counts.

    ``windows``: start and pairs ``i`` (item's value), ``d`` (document's). Those with equal pairs only are a verbatim copy and
    always count, whatever lies between. A run with other pairs counts if each item value stands for one document value in it and
    its windows cover ``need`` tokens.
    """
    windows = sorted(windows)
    equal = [all(i == d for i, d in pairs) for _, pairs in windows]
    same = [start for (start, _), e in zip(windows, equal) if e]
    best = (len(same), same[-1] - same[0] + size) if same else (0, 0)
    means: dict[str, dict[str, int]] = {}  # of the run's item values, each document value's number of windows
    twice = covered = left = 0
    for k, (start, pairs) in enumerate(windows):
        covered += min(size, start - windows[k - 1][0]) if k > left else size
        for i, d in set(pairs):
            own = means.setdefault(i, {})
            own[d] = own.get(d, 0) + 1
            twice += own[d] == 1 and len(own) == 2
        while twice:  # the first windows go until each value stands for one again
            for i, d in set(windows[left][1]):
                own = means[i]
                own[d] -= 1
                if not own[d]:
                    del own[d]
                    twice -= len(own) == 1
            left += 1
            covered = covered - min(size, windows[left][0] - windows[left - 1][0]) if left <= k else 0
        if left <= k and covered >= need:
            best = max(best, (k - left + 1, start - windows[left][0] + size))
    return (*best, all(equal)) if best[0] else None


@by_batch
def _runs(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Lines ``key, item, size, need, windows`` to ``key, item, n_windows, n_tokens, exact`` of those that are leaks."""
    out = []
    for key, item, size, need, windows in zip(*(c.to_pylist() for c in batch.columns)):
        run = _run([(w["start"], [(p["i"], p["d"]) for p in w["pairs"]]) for w in windows], size, need)
        if run:
            out.append((key, item, *run))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[n] for r in out], kind) for n, kind in enumerate(kinds)], names=["key", "item", "n_windows", "n_tokens", "exact"])


def _leaks(rows: DataFrame, benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``key, item_id, n_windows, n_tokens, exact`` of rows ``rid, text`` and the items they hold."""
    bench = packed(benchmark, item_col, text_col)
    items = bench.select("rid", F.col("c1").cast("string").alias("text")).mapInArrow(_scan([], None, True), _COLUMNS)
    items = stage(items)
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())
    ids = bench.select(F.col("rid").alias("item"), F.col("c0").alias("item_id"))
    found = rows.select("rid", "text").mapInArrow(_scan(sizes, _bitmap(items), False), _COLUMNS)
    mine = items.select(
        F.col("key").alias("item"), "hash", "shape", "form", "size", F.col("start").alias("item_start"), F.col("slots").alias("item_slots"),
        F.least("tokens", F.lit(RUN)).alias("need"))
    hits = stage(found.join(mine, ["hash", "shape", "form", "size"]).select(
        "key", "item", "form", "size", "need", "start", (F.col("start") - F.col("item_start")).alias("line"),
        F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d")).alias("pairs")))
    lines = hits.groupBy("key", "item", "form", "size", "need", "line").agg(F.collect_list(F.struct("start", "pairs")).alias("windows"))
    runs = lines.select("key", "item", "size", "need", "windows").mapInArrow(
        _runs, "key bigint, item bigint, n_windows bigint, n_tokens int, exact boolean")
    leaks = runs.groupBy("key", "item").agg(
        F.max("n_windows").alias("n_windows"), F.max("n_tokens").alias("n_tokens"), F.max("exact").alias("exact"))
    return leaks.join(ids, "item").select("key", "item_id", "n_windows", "n_tokens", "exact")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    bounded_batches(docs.sparkSession, 3)  # the words of a whole batch are numbered at once
    rows = packed(docs, id_col, text_col)
    return rows.select("rid", "row", F.col("c0").alias("id"), F.col("c1").cast("string").alias("text"))


def leaked_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``id, item_id, n_windows, n_tokens, exact``: each document with each benchmark item of which it holds a passage.

    ``n_windows``: windows of the longest run of a line; ``n_tokens``: template tokens from its first to its last; ``exact``: all
    slots of a line have the item's own values. An item with fewer than ``WINDOW`` template tokens must be held whole; windows
    with fewer than ``LITERAL`` words (other than all words, if shorter) must have the item's own numbers and units. Null and empty texts hold nothing; rows of equal or null ids are
    reported each. Empty tables give no rows.
    """
    rows = _rows(docs, id_col, text_col)
    leaks = _leaks(rows, benchmark, item_col, item_text_col)
    return leaks.join(rows.select(F.col("rid").alias("key"), "id"), "key").select("id", "item_id", "n_windows", "n_tokens", "exact")


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a passage of the benchmark."""
    rows = _rows(docs, id_col, text_col)
    bad = _leaks(rows, benchmark, "item_id", "text").select(F.col("key").alias("rid")).distinct()
    return unpacked(rows.join(bad, "rid", "left_anti"), docs.columns, **{id_col: F.col("id"), text_col: F.col("text")})
