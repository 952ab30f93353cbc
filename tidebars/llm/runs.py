"""Words of whole text columns, cut out of the bytes of a batch at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: ASCII capitals to small letters, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts (null: empty) in a row, and where each begins; one more for the end."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def cut_words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[pa.BinaryArray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes that are ``inside``, none across texts: the words, where they begin, and how many each text has."""
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    at = offsets[:-1][offsets[:-1] < len(data)]
    begins[at] = inside[at]
    begin = np.flatnonzero(begins)
    kept = data[inside]
    # the place of a word among the kept bytes: its own place less the bytes left out before it
    ends = np.empty(len(begin) + 1, np.int64)
    ends[:-1] = np.searchsorted(np.flatnonzero(inside), begin)
    ends[-1] = len(kept)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(kept.tobytes())])
    return words, begin, np.diff(np.searchsorted(begin, offsets))


def numbered(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The different words, and the number of each word in their order."""
    known = words.dictionary_encode()
    return known.dictionary, np.asarray(known.indices).astype(np.int64)
