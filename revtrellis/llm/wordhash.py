"""Vectorised words and fingerprints: words of many texts in one numpy pass, hashes of runs of words or bytes.

All sums and products are modulo 2**64. A run's polynomial hash is a difference of prefix sums times the inverse
power of its start, so every window of a text costs a few vector operations, whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

U = np.uint64
CHUNK = 1 << 20

_BYTES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**64 - 1, 256, dtype=np.uint64) | U(1)
BASES = (0x9E3779B97F4A7C17, 0xC2B2AE3D27D4EB4B)


def _table(separators: set[int]) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(separators)] = True
    return out


#: Words are runs of anything but white space.
SPACE = _table({0x20, *range(0x09, 0x0E)})
#: Words are runs of digits, small letters and anything beyond ASCII.
PUNCTUATION = _table({*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)})
#: Small letters for A-Z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse."""
    kept = _POWERS.get(base)
    if kept is None or len(kept[0]) < n:
        size = max(n, CHUNK + 1)
        both = []
        for b in (base, pow(base, -1, 2**64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.cumprod(p, dtype=np.uint64))
        kept = (both[0], both[1])
        if size <= 4 * CHUNK:
            _POWERS[base] = kept
    return kept[0][:n], kept[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(32))
    h *= U(0xD6E8FEB86659FD93)
    h ^= h >> U(29)
    h *= U(0xA0761D6478BD642F)
    h ^= h >> U(32)
    return h


def run_hashes(values: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """Hash of every run of `length` consecutive values (uint64)."""
    n = len(values)
    if n < length:
        return np.zeros(0, np.uint64)
    up, down = powers(BASES[which], n)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up, out=prefix[1:])
    return mix((prefix[length:] - prefix[:-length]) * down[: n - length + 1])


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTES[data]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` consecutive values, by doubling."""
    if len(values) < width:
        return values[:0]
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[: len(values) - (width - done)], values[width - done :]) if width > done else values


def sliding_max(values: np.ndarray, width: int) -> np.ndarray:
    return ~sliding_min(~values, width)


@dataclass
class Words:
    """Words of consecutive whole texts. `first[i]` is the index of the first word of text lo + i; it has one entry more than there are texts."""

    lo: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    offsets: np.ndarray

    def same_text(self, length: int) -> np.ndarray:
        """For each run of `length` words: does it lie in one text?"""
        n = len(self.hashes)
        if n < length:
            return np.zeros(0, bool)
        text = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        return text[: n - length + 1] == text[length - 1 :]


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        lo = int(starts[at])
        end = max(int(np.searchsorted(ends, lo + CHUNK, "right")), at + 1)
        hi = int(ends[end - 1])
        up, down = powers(BASES[0], hi - lo + 1)
        prefix = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTES[data[lo:hi]] * up[:-1], out=prefix[1:])
        s, e = starts[at:end] - lo, ends[at:end] - lo
        out[at:end] = (prefix[e] - prefix[s]) * down[s]
        at = end
    return mix(out)


def words_of(texts: list[bytes], separators: np.ndarray, fold: np.ndarray | None = None) -> Iterator[Words]:
    """Words of the texts, a group of whole texts of about CHUNK bytes at a time."""
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) < CHUNK):
            size += len(texts[hi]) + 1
            hi += 1
        group = texts[lo:hi]
        data = np.frombuffer(b"\n".join([b"", *group, b""]), np.uint8)
        if fold is not None:
            data = fold[data]
        edge = np.flatnonzero(np.diff(separators[data].view(np.int8)))
        starts, ends = edge[0::2] + 1, edge[1::2] + 1
        offsets = np.zeros(len(group) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in group], out=offsets[1:])
        offsets += 1
        yield Words(lo, data, starts, ends, _word_hashes(data, starts, ends), np.searchsorted(starts, offsets), offsets)
        lo = hi
