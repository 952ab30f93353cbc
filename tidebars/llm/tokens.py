"""Token ids by the tokenizers library, with a memory of words, and files in the shared folder."""

from __future__ import annotations

import json
import os
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

from tidebars.llm.common import CodeTable, split_words
from tidebars.session import shared_dir


#: Fixed value: the pattern by which the tokenizer file splits words.
LETTER_RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII punctuation but the apostrophe, which may begin a contraction
SENTENCE_ENDS = r"([.!?]\"?|\.\)|。)$"


def _byte_level() -> list[str]:
    """The character by which byte-level tokenizers write each byte: visible ones as they are, the others from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


BYTE_LEVEL = _byte_level()


def per_process(key: tuple, make: Callable):
    """A value kept in the Python worker for its next tasks."""
    held = sys.modules.setdefault("_tidebars_held", types.ModuleType("_tidebars_held")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


class Encoder:
    """Ids of whole texts, equal to encoding the text at once with ``add_special_tokens=False``.

    Texts are cut at ASCII white space, over which the tokenizer neither merges nor normalises, and Arrow numbers the
    different words of a batch. Where the tokenizer is known to set runs of letters, digits and punctuation ``apart``, a word is
    split further into its body and the punctuation after it, and ASCII words are put in lower case. What is left is encoded by
    the library once, while the task remembers it.
    """

    def __init__(self, path: str, limit: int = 200_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.normalize = self.tokenizer.normalizer.normalize_str if self.tokenizer.normalizer else str
        self.apart = self._sets_letters_apart(path)
        self.table = CodeTable(self._encode, limit)

    def __enter__(self) -> "Encoder":
        return self

    def __exit__(self, *_) -> None:
        """What was remembered goes at the end of a task; the tokenizer stays in the process."""
        self.table.clear()

    @staticmethod
    def _sets_letters_apart(path: str) -> bool:
        """Whether the file names the steps for which the split is exact."""
        with open(path, encoding="utf-8") as file:
            steps = json.load(file)
        split, level = [*(steps.get("pre_tokenizer") or {}).get("pretokenizers", []), {}, {}][:2]
        return (
            [n.get("type") for n in (steps.get("normalizer") or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
            and split.get("pattern") == {"Regex": LETTER_RUNS} and split.get("invert") and split.get("behavior") == "Removed"
            and level.get("type") == "ByteLevel" and not level.get("use_regex") and not level.get("add_prefix_space"))

    def _encode(self, words: list[str]) -> list[list[int]]:
        """Runs of letters, which the tokenizer doesn't split, go to the library's model at once, normalised by the library."""
        tokenize, normalize, level = self.model.tokenize, self.normalize, BYTE_LEVEL.__getitem__
        out, other = [], []
        for i, word in enumerate(words):
            if self.apart and word.isalpha():
                if word.isascii():
                    out.append([t.id for t in tokenize(word.lower())])
                    continue
                word = normalize(word)
                if word.isalpha():
                    out.append([t.id for t in tokenize("".join(map(level, word.encode())))])
                    continue
            other.append(i)
            out.append([])
        found = self.tokenizer.encode_batch_fast([words[i] for i in other], add_special_tokens=False)
        for i, e in zip(other, found):
            out[i] = e.ids
        return out

    def _parts(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Body and marks of each word."""
        nothing = pa.array([""] * len(words), pa.string())
        if not self.apart:
            return words, nothing
        body = pc.ascii_rtrim(words, characters=MARKS)
        marks = pc.replace_substring_regex(words, r"(?s)^.*[^!-&(-/:-@\[-`{-~]", "")
        # the body must end in a letter or digit, else it may be one run with the marks; Latin ones, as others may end in a mark
        # once normalised. Added tokens stay whole.
        split = pc.and_(pc.match_substring_regex(body, r"[0-9A-Za-zÀ-ÖØ-öø-ÿ]$"), pc.invert(pc.match_substring(words, "<|")))
        body, marks = pc.if_else(split, body, words), pc.if_else(split, marks, nothing)
        return pc.if_else(pc.string_is_ascii(body), pc.ascii_lower(body), body), marks

    def _codes(self, words: pa.Array) -> np.ndarray:
        """The table's numbers of words."""
        known = words.dictionary_encode()
        return self.table.codes([known.dictionary.to_pylist()])[0][np.asarray(known.indices)]

    def batch(self, texts: pa.Array, end: int, sentences: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of a column's texts in a row (null: empty), each with ``end`` after them; where each text begins, and the end of
        all; and, if asked for, the places after sentence ends."""
        known, at, offsets = split_words(texts)
        self.table.trim()
        body, marks = (self._codes(p) for p in self._parts(known))
        length = (self.table.length[body] + self.table.length[marks])[at]
        ends = np.concatenate([[0], np.cumsum(length)])
        first = ends[offsets] + np.arange(len(offsets))
        flat = np.full(int(first[-1]), end, np.uint32)
        inner = np.ones(len(flat), bool)
        inner[first[1:] - 1] = False
        flat[inner] = self.table.spread(np.stack([body, marks], axis=1)[at].ravel())
        stops = np.zeros(0, np.int64)
        if sentences:
            stop = np.asarray(pc.match_substring_regex(known, SENTENCE_ENDS).to_numpy(zero_copy_only=False), bool)
            words = np.flatnonzero(stop[at])
            stops = ends[words + 1] + np.searchsorted(offsets, words, side="right") - 1
        return flat, first, stops

    def ids(self, texts: pa.Array, end: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text: its ids with ``end`` after them, and the places after sentence ends."""
        if len(texts):
            flat, first, stops = self.batch(texts, end)
            cuts = np.searchsorted(stops, first).tolist()
            for a, b, i, j in zip(first[:-1].tolist(), first[1:].tolist(), cuts, cuts[1:]):
                yield flat[a:b], stops[i:j] - a


def encoder(path: str) -> Encoder:
    return per_process(("encoder", path), lambda: Encoder(path))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def new_folder(spark: SparkSession, kind: str) -> str:
    """The name of a folder that doesn't exist yet, on storage that all executors reach."""
    return f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def file_system(uri: str):
    """The pyarrow file system of a path or URI, and the path in it."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


class WholeFile:
    """A file that appears under its name only when complete.

    A repeated task replaces it: its bytes must be the same, or the name the attempt's own.
    """

    def __init__(self, folder: str, file: str):
        self.fs, root = file_system(folder)
        self.fs.create_dir(root, recursive=True)
        self.path, self.part = f"{root}/{file}", f"{root}/_{uuid.uuid4().hex}"
        self.uri = f"{folder}/{file}"
        self.out = self.fs.open_output_stream(self.part, compression=None)
        self.size = 0

    def write(self, data: bytes) -> int:
        """Append; where the data begin."""
        at = self.size
        self.out.write(data)
        self.size += len(data)
        return at

    def close(self) -> str:
        self.out.close()
        self.fs.move(self.part, self.path)
        return self.uri
