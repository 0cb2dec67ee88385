"""Words of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of bytes other than blank and the five control characters from
tab to carriage return.  As these are ASCII, words can be found in UTF-8 bytes.
Hashes are polynomials over random byte values modulo 2^64, mixed at the end.
Long words have a cryptographic digest instead, as two different strings of a
thousand letters can be equal under every such polynomial.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RANDOM = np.random.default_rng(20240229)
_BYTE_VALUE = _RANDOM.integers(1, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 2**64)

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32

# Texts are handled in slices of about this many bytes, so that the arrays of
# eight bytes for each byte of text stay small.
SLICE_BYTES = 2_000_000

# Words of more bytes than this have a digest.
LONG_WORD = 64

_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        _powers[base] = known
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a text column: first row, end row, their UTF-8 bytes, and row offsets in these.

    A null counts as empty.  A single long text is never cut.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(ends, ends[row] + most, side="right")) - 1)
        yield row, end, data[ends[row] : ends[end]], ends[row : end + 1] - ends[row]
        row = end


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the position of each text's first word (one more entry at the end)."""
    inside = ~_SEPARATOR[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """A 64-bit hash of each word; with fold, of the word with A to Z in lower case."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    letters = _FOLD[data] if fold else data
    values = _BYTE_VALUE[letters]
    values *= _powers_of(_BASE, len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values, out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _powers_of(_BASE_INVERSE, len(data))[starts]
    hashes = mix(hashes + (ends - starts).astype(np.uint64))
    long = np.flatnonzero(ends - starts > LONG_WORD)
    for i, a, b in zip(long.tolist(), starts[long].tolist(), ends[long].tolist()):
        hashes[i] = int.from_bytes(hashlib.blake2b(letters[a:b].tobytes(), digest_size=8).digest(), "little")
    return hashes


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n consecutive words, in order; texts are not told apart here."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) - n + 1, dtype=np.uint64)
    for i in range(n):
        total = total * np.uint64(_BASE) + hashes[i : len(hashes) - n + 1 + i]
    return mix(total + np.uint64(n))


def within_texts(first_word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the runs of n words that lie inside one text, and their texts."""
    counts = np.maximum(np.diff(first_word) - n + 1, 0)
    texts = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(counts) - counts
    return np.arange(len(texts)) - before[texts] + first_word[:-1][texts], texts
