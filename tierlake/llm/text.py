"""Vectorised word hashing of UTF-8 text batches.

A batch is one byte buffer plus document offsets (the layout of an Arrow string
column). Words are maximal runs of bytes other than the separators; their 64-bit
hashes come from prefix sums over the whole buffer, so there is no Python code
per word and a very long text costs only its bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
# Separators for plain words: the spaces and all other ASCII that is no letter or digit.
_NOT_PLAIN = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _inverse(odd: int) -> np.uint64:
    x = odd
    for _ in range(6):
        x = x * (2 - odd * x) % 2**64
    return np.uint64(x)


_BASE_INV = _inverse(int(_BASE))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """SplitMix64 finaliser: a seeded bijection of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((seed * 0xD1342543DE82EF95 + 0x9E3779B97F4A7C15) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BYTE_HASH = mix(_LOWER.astype(np.uint64), seed=77)
_EXACT_BYTE_HASH = mix(np.arange(256, dtype=np.uint64), seed=77)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 … base**(n-1) modulo 2**64, by doubling; the longest table is kept."""
    kept = _POWERS.get(int(base))
    if kept is None or len(kept) < n:
        kept = np.ones(max(n, 1 << 20), np.uint64)
        filled, step = 1, base
        with np.errstate(over="ignore"):
            while filled < len(kept):
                k = min(filled, len(kept) - filled)
                kept[filled:filled + k] = kept[:k] * step
                filled += k
                step = step * step
        _POWERS[int(base)] = kept
    return kept[:n]


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    start = int(offsets[0]) if len(offsets) else 0
    end = int(offsets[-1]) if len(offsets) else 0
    return raw[start:end], (offsets - start if len(offsets) else np.zeros(1, np.int64))


# Per byte: 1 an ASCII letter, 2 ASCII punctuation other than the apostrophe, else 0.
_KIND = np.zeros(256, np.uint8)
_KIND[[c for c in range(128) if chr(c).isalpha()]] = 1
_KIND[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = 2


def word_bounds(raw: np.ndarray, offsets: np.ndarray, split_kinds: bool = False, plain: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word; words never cross a document border.

    ``split_kinds`` also cuts between an ASCII letter and ASCII punctuation
    (apostrophe aside); ``plain`` takes all ASCII but letters and digits as separators."""
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = ~(_NOT_PLAIN if plain else _IS_SPACE)[raw]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(raw))]
    if split_kinds:
        kind = _KIND[raw]
        cuts = np.concatenate([cuts, np.flatnonzero(kind[1:] + kind[:-1] == 3) + 1])
    begins[cuts] |= inside[1:-1][cuts]
    ends[cuts - 1] |= inside[1:-1][cuts - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hash of each byte span (A-Z folded to a-z when ``lower``)."""
    table = _BYTE_HASH if lower else _EXACT_BYTE_HASH
    prefix = np.zeros(len(raw) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(table[raw] * powers(_BASE, len(raw)), out=prefix[1:])
        h = prefix[ends] - prefix[starts]
        del prefix
        h *= powers(_BASE_INV, len(raw) + 1)[starts]
        return mix(h + (ends - starts).astype(np.uint64))


def words_of(column: pa.Array, lower: bool = True, split_kinds: bool = False, plain: bool = False):
    """(raw bytes, word starts, word ends, word hashes, first word of each document).

    The last array has one entry more than there are documents.
    """
    raw, offsets = buffer_of(column)
    starts, ends = word_bounds(raw, offsets, split_kinds, plain)
    hashes = span_hashes(raw, starts, ends, lower)
    return raw, starts, ends, hashes, np.searchsorted(starts, offsets)


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every window of ``width`` consecutive entries (Karp-Rabin by prefix sums)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = out * _BASE + hashes[k:k + n]
        return mix(out, seed=width)


def shingle_sets(hashes: np.ndarray, first: np.ndarray, width: int):
    """Yield the sorted distinct shingle hashes of each document.

    Fewer words than ``width``: the whole sequence is one shingle; no words: none.
    """
    windows = rolling(hashes, width)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= width:
            yield np.unique(windows[a:b - width + 1])
        elif b > a:
            yield rolling(hashes[a:b], int(b - a))
        else:
            yield np.zeros(0, np.uint64)


def slices(column_batch: pa.RecordBatch, max_bytes: int = 1 << 20):
    """Cut a record batch so that each piece's ``text`` holds about ``max_bytes`` at most
    (a single longer text makes a piece of its own)."""
    text = column_batch.column("text")
    sizes = np.asarray(pc.binary_length(text).fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    at = 0
    while at < len(sizes):
        end = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), max_bytes, side="right")))
        yield column_batch.slice(at, end - at)
        at = end
