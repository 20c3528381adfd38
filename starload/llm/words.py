"""Words, word hashes and window hashes of many texts at once, with numpy.

A word is a match of ``[^\\x20\\x09-\\x0D]+``. On UTF-8 bytes that is a run of
bytes outside six ASCII values, so texts need no decoding. A word's hash is a
polynomial over its bytes modulo 2**64, taken as a difference of prefix sums,
then mixed; different words of a text share a hash with a chance of about 2**-64
for each pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from .common import runs

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CHUNK_BYTES = 1 << 18

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads each input bit over the 64 output bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


class _Powers:
    """Powers of the base and its inverse, grown on demand."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            if n > 4 * CHUNK_BYTES:  # one very long text: not kept
                return cls.made(n)
            cls.up, cls.down = cls.made(max(n, CHUNK_BYTES + 1))
        return cls.up[:n], cls.down[:n]

    @staticmethod
    def made(n: int) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for base in (_BASE, _INVERSE):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        return out[0], out[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte span, length included."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _Powers.of(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


@dataclass
class Chunk:
    """Some consecutive texts of a batch."""

    first: int  # row of the first text
    data: np.ndarray  # bytes of the texts, one behind the other
    at: np.ndarray  # byte offset of each text in data, and the end
    starts: np.ndarray  # of the words
    ends: np.ndarray
    word_at: np.ndarray  # number of each text's first word, and the end

    @property
    def n(self) -> int:
        return len(self.at) - 1


def chunks(data: memoryview, offsets, lower: bool = False, most: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Whole texts in chunks of about ``most`` bytes, with their words."""
    for lo, hi in runs(offsets, most):
        at = np.asarray(offsets[lo : hi + 1], dtype=np.int64)
        buf = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if at[-1] > at[0] else np.zeros(0, np.uint8)
        at = at - at[0]
        if lower:
            buf = LOWER[buf]
        inside = ~SPACE[buf]
        first = np.ones(len(buf), bool)  # a word may start where a space or another text ends
        if len(buf):
            first[1:] = ~inside[:-1]
            first[at[:-1][at[:-1] < len(buf)]] = True
        last = np.ones(len(buf), bool)
        last[:-1] = first[1:] | ~inside[1:]
        starts = np.flatnonzero(inside & first)
        ends = np.flatnonzero(inside & last) + 1
        yield Chunk(lo, buf, at, starts, ends, np.searchsorted(starts, at))


def windows(hashes: np.ndarray, word_at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of ``width`` words that lies in one text, and the
    number of each text's first window (and the end). A text of fewer words has none."""
    n_words = np.diff(word_at)
    n = np.maximum(n_words - width + 1, 0)
    window_at = np.concatenate(([0], np.cumsum(n)))
    total = int(window_at[-1])
    if not total:
        return np.zeros(0, np.uint64), window_at
    first = np.arange(total) + np.repeat(word_at[:-1] - window_at[:-1], n)
    h = np.zeros(total, np.uint64)
    for k in range(width):
        h = (h + hashes[first + k]) * np.uint64(0x9FB21C651E98DF25)
        h ^= h >> np.uint64(32)
    return mix(h), window_at


def shingle_sets(chunk: Chunk, width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its ``width``-word shingles;
    with fewer words the whole sequence as one; without words empty."""
    hashes = span_hashes(chunk.data, chunk.starts, chunk.ends)
    win, win_at = windows(hashes, chunk.word_at, width)
    for i in range(chunk.n):
        lo, hi = chunk.word_at[i], chunk.word_at[i + 1]
        if hi - lo >= width:
            yield np.unique(win[win_at[i] : win_at[i + 1]])
        elif hi > lo:
            h = np.uint64(hi - lo)
            with np.errstate(over="ignore"):
                for x in hashes[lo:hi]:
                    h = np.uint64((int(h) + int(x)) * 0x9FB21C651E98DF25 % (1 << 64))
                    h ^= h >> np.uint64(29)
            yield np.array([h], np.uint64)
        else:
            yield np.zeros(0, np.uint64)
