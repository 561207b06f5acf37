"""Vectorised word access to Arrow string columns, shared by the text operators.

A word is a run of bytes between separators, found over whole batches with numpy; nothing here loops over words or
documents. Hashes are 64-bit and depend only on a word's bytes, so they agree between executors and runs.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
#: Bytes of text that are worked on at once. A longer document is worked on alone and whole.
SLICE_BYTES = 2 << 20

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
#: ASCII signs separate words too; bytes from 0x80 belong to letters.
SIGNS = np.ones(256, bool)
SIGNS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Code points of scripts that put no spaces between words, with their punctuation: each is a word by itself.
_UNSPACED = ((0xE00, 0xFFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F), (0x2E80, 0x312F), (0x31A0, 0xA4CF), (0xA980, 0xA9FF), (0xAA60, 0xAA7F), (0xF900, 0xFAFF), (0xFE30, 0xFE4F), (0xFF00, 0xFFEF), (0x16FE0, 0x18DFF), (0x1AFF0, 0x1B2FF), (0x20000, 0x3FFFF))
_LETTER, _SOLO, _SIGN = range(3)
#: Two characters of such a script count as one word.
SOLO_WEIGHT = 0.5

_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: np.uint64 = BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    key = int(base)
    have = _powers.get(key)
    if have is None or len(have) < n:
        full = np.full(max(n, 1 << 16), base, np.uint64)
        full[0] = 1
        have = np.multiply.accumulate(full)
        if n <= 4 * SLICE_BYTES:
            _powers[key] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of uint64 (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums: see ``span_hash``."""
    out = np.empty(len(values) + 1, np.uint64)
    out[0] = 0
    np.cumsum(values * powers(len(values)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] that doesn't depend on where the span lies."""
    return (prefix[end] - prefix[start]) * powers(len(prefix), _INVERSE)[start]


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type != pa.large_string():
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of text, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), np.int64))
        at = 0
        while at < batch.num_rows:
            done = size[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(size, done + limit, side="right")))
            yield batch.slice(at, end - at)
            at = end


@cache
def _classes() -> np.ndarray:
    """Of each code point from 0x80: a letter of a word, a word by itself, or (punctuation, spaces, controls) a sign."""
    out = np.zeros((2, 0x110000), np.uint8)
    for low, high in _UNSPACED:
        out[:, low : high + 1] = _SOLO
    signs = [c for c in range(0x80, 0x20000) if unicodedata.category(chr(c)) in ("Cc", "Zs", "Zl", "Zp", "Pc", "Pd", "Pe", "Pf", "Pi", "Po", "Ps")]
    out[1, signs] = _SIGN
    return out


def _beyond_ascii(data: np.ndarray, signs: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, size, class) of each character from 0x80."""
    lead = np.flatnonzero(data >= 0xC0)
    head = data[lead].astype(np.int64)
    size = 2 + (head >= 0xE0) + (head >= 0xF0)
    code = head & (0x7F >> size)
    for k in range(1, 4):
        more = size > k
        follow = data[np.minimum(lead + k, len(data) - 1)] & 0x3F
        code = np.where(more, code << 6 | follow, code)
    return lead, size, _classes()[int(signs)][np.minimum(code, 0x10FFFF)]


@dataclass
class Words:
    """Words of a batch in reading order. ``first[d]:first[d + 1]`` are the words of row d."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    row: np.ndarray
    #: What each word counts: 1, a character of a script without spaces ``SOLO_WEIGHT``, and the pieces of a split word
    #: their bytes' share of ``split_over``.
    weight: np.ndarray | None = None

    def hashes(self) -> np.ndarray:
        prefix = prefix_hash(self.data.astype(np.uint64) + np.uint64(1))
        return mix(span_hash(prefix, self.start, self.end))


def tokenise(column: pa.Array, signs: bool = False, lower: bool = False, split_over: int = 0, characters: bool = False, weigh: bool = False) -> Words:
    """Words of each row. signs: punctuation separates words too. split_over: longer words fall into single bytes.

    characters: of scripts without spaces each character is a word, and longer words than ``split_over`` fall into
    characters; with ``signs``, punctuation beyond ASCII separates words too. weigh: also gives each word's weight, by
    which a word that is split still counts as its size goes: a byte more or less makes no difference.
    """
    data, offs = string_buffers(column)
    if lower:
        data = _LOWER[data]
    inside = ~(SIGNS if signs else SPACES)[data]
    n = len(data)
    solo, width = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if characters and n:
        lead, size, kind = _beyond_ascii(data, signs)
        sign = kind == _SIGN
        inside[np.repeat(lead[sign], size[sign]) + ranges(size[sign])] = False
        solo, width = lead[kind == _SOLO], size[kind == _SOLO]
    opens, closes = inside.copy(), inside.copy()
    if n:
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        filled = np.flatnonzero(np.diff(offs))
        heads, tails = offs[filled], offs[filled + 1] - 1
        opens[heads], closes[tails] = inside[heads], inside[tails]
    if solo.size:
        after, before = (solo + width)[solo + width < n], (solo - 1)[solo > 0]
        opens[after], closes[before] = inside[after], inside[before]
        opens[solo], closes[solo + width - 1] = True, True
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    tops = None
    if split_over and len(start) and (long := np.flatnonzero(end - start > split_over)).size:
        size = end[long] - start[long]
        pieces = np.repeat(start[long], size) + ranges(size)
        tops = pieces + 1
        if characters:
            pieces = pieces[data[pieces] & 0xC0 != 0x80]
            tops = np.sort(np.concatenate([np.setdiff1d(pieces, start[long]), end[long]]))
        start = np.sort(np.concatenate([np.delete(start, long), pieces]))
        end = np.sort(np.concatenate([np.delete(end, long), tops]))
    first = np.searchsorted(start, offs)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    weight = None
    if weigh:
        weight = np.ones(len(start))
        weight[np.searchsorted(start, solo)] = SOLO_WEIGHT
        if tops is not None:
            at = np.searchsorted(start, pieces)
            weight[at] = (end[at] - start[at]) / split_over
    return Words(data, offs, start, end, first, row, weight)


def ranges(count: np.ndarray) -> np.ndarray:
    """0..count[0]-1, 0..count[1]-1 and so on, in one array."""
    total = int(count.sum())
    ends = np.cumsum(count)
    return np.arange(total) - np.repeat(ends - count, count)
