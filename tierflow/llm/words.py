"""Texts of an Arrow batch as one flat array of word codes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Byte maps applied to UTF-8 text: A-Z to lower case, and all that is no word to a space;
#: WHITE keeps the case.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
WHITE = bytes(32 if b in (9, 10, 11, 12, 13) else b for b in range(256))
SPACED = bytes(32 if b in (9, 10, 11, 12, 13) else b for b in LOWER)
ALPHANUMERIC = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in LOWER
)


def mapped(texts: pa.Array, table: bytes) -> pa.StringArray:
    """Every byte of the texts through ``table``; a null becomes an empty text."""
    texts = pc.fill_null(texts, "")
    if pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.string())
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[
        texts.offset : texts.offset + len(texts) + 1
    ]
    data = texts.buffers()[2]
    body = b"" if data is None else data[offsets[0] : offsets[-1]].to_pybytes()
    shifted = (offsets - offsets[0]).astype(np.int32)
    return pa.StringArray.from_buffers(
        len(texts), pa.py_buffer(shifted), pa.py_buffer(body.translate(table))
    )


def split_words(texts: pa.StringArray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Code of every word, the words by code, and where each text's words begin.

    The texts hold no white space but single-byte spaces; empty pieces are no words.
    """
    listed = pc.split_pattern(texts, " ")
    pieces = listed.flatten().dictionary_encode()
    codes = pieces.indices.to_numpy()
    ends = listed.offsets.to_numpy() - listed.offsets[0].as_py()
    words = pieces.dictionary
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    if not real.all():
        used = real[codes]
        ends = np.concatenate([[0], np.cumsum(used)])[ends]
        codes = codes[used]
    return codes, words, ends.astype(np.int64)


def word_hashes(words: pa.Array, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of every word."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(
        (digest(w, seed) for w in words.cast(pa.binary()).to_pylist()),
        np.uint64,
        len(words),
    )


MIX = np.uint64(0x9E3779B97F4A7C15)


def scrambled(values: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values that spreads every input bit."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(32)
    return values


def shingle_hashes(
    hashed: np.ndarray, offsets: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word shingles and where each text's shingles begin.

    ``hashed`` has a hash per word.  A text with fewer words than ``size`` is one
    shingle of all its words, a text without words has none.
    """
    counts = np.diff(offsets)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    begins = offsets_from(made)
    if not begins[-1]:
        return np.empty(0, np.uint64), begins
    where = np.repeat(offsets[:-1] - begins[:-1], made) + np.arange(begins[-1])
    padded = np.concatenate([hashed, np.zeros(size, np.uint64)])
    out = np.zeros(len(where), np.uint64)
    stop = np.repeat(offsets[1:], made)
    whole = np.repeat(counts >= size, made)
    for k in range(size):
        at = where + k
        word = padded[at]
        if not whole.all():
            word = np.where(whole | (at < stop), word, np.uint64(k + 1))
        out = (out ^ word) * MIX
        out ^= out >> np.uint64(29)
    return scrambled(out), begins


def offsets_from(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
