"""Numpy views of a batch of texts: bytes, word spans, and hashes of spans.

Nothing here knows Spark.  The functions take one Arrow string column (or a
slice of it) and work on its UTF-8 buffer, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that the vectorised helpers look at in one go.
CHUNK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def lower_ascii_table() -> np.ndarray:
    """Byte table that maps A-Z to a-z and leaves the rest."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = lower_ascii_table()
#: Bytes of a word in ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes; a longer row gets a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    if len(_powers["up"]) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            row = np.full(n, base, np.uint64)
            row[0] = 1
            _powers[name] = np.cumprod(row)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


class Rolling:
    """Hashes of any spans of a sequence, from one running sum."""

    def __init__(self, values: np.ndarray):
        self.up, self.down = powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * self.up[:-1], out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word of (lower-cased) bytes; none spans two rows."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = is_word[data]
    first = np.zeros(n, bool)
    first[offsets[:-1][offsets[:-1] < n]] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | first))
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, ~inside[1:] | first[1:]
    ends = np.flatnonzero(inside & after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def one_row_windows(rows: np.ndarray, n: int) -> np.ndarray:
    """Positions where n consecutive words belong to one row."""
    if len(rows) < n:
        return np.zeros(0, np.int64)
    return np.flatnonzero(rows[: len(rows) - n + 1] == rows[n - 1 :])
