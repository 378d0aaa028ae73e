"""Word shingles of whole texts as sets of 64-bit hashes, vectorised over Arrow batches.

Words are the runs of bytes that are not white space (0x20, 0x09-0x0D) after
lower-casing A-Z.  A word's hash is a polynomial over its bytes, so that a
whole chunk of texts is hashed with a few numpy passes and no loop over words.
A shingle's hash mixes the hashes of its words in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text hashed at once; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240917)
_BYTE = _rng.integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_COEF = _rng.integers(1, 2**63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Bytes that belong to words: all but white space.
SOLID = ~np.isin(np.arange(256), [32, *range(9, 14)])
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each; those of one chunk are kept, longer ones are not."""
    global _powers, _inverse
    if len(_powers) >= n:
        return _powers, _inverse
    size = max(n, CHUNK_BYTES + 1)
    found = []
    for b in (int(_BASE), pow(int(_BASE), -1, 1 << 64)):
        t = np.full(size, np.uint64(b))
        t[0] = 1
        found.append(np.cumprod(t, dtype=np.uint64))
    if n <= CHUNK_BYTES + 1:
        _powers, _inverse = found
    return found[0], found[1]


def chunks(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first row, slice) of consecutive rows with about CHUNK_BYTES of text each."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < len(texts):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + CHUNK_BYTES, side="right")))
        yield at, texts.slice(at, to - at)
        at = to


def word_spans(texts: pa.Array, solid: np.ndarray = SOLID) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes of all rows, begin and end of each word in them, first word of each row and the total).

    solid: for each byte value, after lower-casing, whether it belongs to a word.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    if offsets[-1] == offsets[0]:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint8), none, none, np.zeros(n + 1, np.int64)
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    upper = (raw >= 65) & (raw <= 90)
    low = raw + (upper.astype(np.uint8) << 5)
    inside = solid[low]
    first = np.zeros(len(raw) + 1, bool)  # a row begins here
    first[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return low, s, e, np.searchsorted(s, offsets).astype(np.int64)


def span_hashes(low: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span."""
    if not len(s):
        return np.zeros(0, np.uint64)
    pw, inv = _tables(len(low) + 1)
    total = np.zeros(len(low) + 1, np.uint64)
    np.cumsum(_BYTE[low] * pw[: len(low)], out=total[1:])
    h = (total[e] - total[s]) * inv[s]
    return mix64(h + (e - s).astype(np.uint64) * _COEF[63])


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each row and the total): rows in order."""
    low, s, e, first = word_spans(texts)
    return span_hashes(low, s, e), first


def gram_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of `width` words, across row borders too."""
    if len(words) < width:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        h += mix64(words[i : len(words) - width + 1 + i] + _COEF[i]) * _COEF[i]
    return mix64(h)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Per row, in order: the sorted distinct hashes of its shingles of `width` words.

    A row with fewer words has one shingle, its whole sequence; one without
    words (or null) an empty set.
    """
    for _, part in chunks(texts):
        words, first = word_hashes(part)
        counts = np.diff(first)
        h = gram_hashes(words, width)
        for a, c in zip(first[:-1].tolist(), counts.tolist()):
            if c >= width:
                x = np.sort(h[a : a + c - width + 1])
                yield x[np.concatenate(([True], x[1:] != x[:-1]))]
            elif c:
                x = np.uint64(c)
                for i in range(c):
                    x = x + mix64(words[a + i : a + i + 1] + _COEF[i]) * _COEF[i]
                yield mix64(x + _COEF[62])
            else:
                yield np.zeros(0, np.uint64)


def set_signature(s: np.ndarray) -> tuple[int, int]:
    """128 bits that two equal sets share and two others don't, but by a chance of 2**-128."""
    a = int(mix64(s ^ _COEF[60]).sum(dtype=np.uint64)) if len(s) else 0
    b = int(np.bitwise_xor.reduce(mix64(s + _COEF[61]))) if len(s) else 0
    return a - (1 << 63), b - (1 << 63)
