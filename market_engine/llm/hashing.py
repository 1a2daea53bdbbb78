"""Vectorised hashing of the words of a batch of texts, for operators that run in tasks.

All of it works on the UTF-8 bytes of an Arrow string column with numpy; nothing loops over words.
Hashes depend on the bytes alone, so any worker gives the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15
#: Numbers of powers that are kept: twice as many words as a group of short texts has.
_KEPT = 1 << 20
#: Bytes of text whose words are held at a time; a longer text is held alone.
GROUP_BYTES = 1 << 20

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64; kept for the next call up to a few MB."""
    have = _powers.get(base)
    if have is not None and len(have) >= n:
        return have[:n]
    out = np.full(max(n, _KEPT // 8), base, np.uint64)
    out[0] = 1
    np.cumprod(out, out=out)
    if len(out) <= _KEPT:
        _powers[base] = out
    return out[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null texts are empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def doc_groups(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts of up to GROUP_BYTES together, or one longer text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + GROUP_BYTES, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte places of all words, and the number of words before each text."""
    word = ~SEPARATOR[data]
    begins, stops = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    stops[:-1] &= ~word[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    begins[inner] = word[inner]
    stops[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


#: Masks that keep the first 0 to 8 bytes of a little-endian number.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


def _lanes(lane: np.ndarray, at: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Two mixes of 8-byte lanes with their places in the word, one to be added and one to be XORed."""
    place = mix(at + np.uint64(salt))
    return mix(lane ^ place), mix((lane + place) * _SPREAD)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: int = 0) -> np.ndarray:
    """64-bit hash of every word, from its bytes eight at a time, each eight mixed with its place before they are
    combined in two ways. ``kind`` gives independent hashes."""
    salt = (_BASE * (2 * kind + 1)) & (1 << 64) - 1
    padded = np.append(np.ascontiguousarray(data), np.zeros(8, np.uint8))
    eight = np.ndarray(len(data) + 1, np.dtype("<u8"), padded, strides=(1,))
    length = ends - starts
    total, other = _lanes(eight[starts] & _FIRST[np.minimum(length, 8)], np.zeros(1, np.uint64), salt)
    long = np.flatnonzero(length > 8)
    if len(long):
        more = (length[long] - 1) // 8
        begin = np.cumsum(more) - more
        at = np.arange(1, int(more.sum()) + 1) - np.repeat(begin, more)
        left = np.repeat(length[long], more) - 8 * at
        lane = eight[np.repeat(starts[long], more) + 8 * at] & _FIRST[np.minimum(left, 8)]
        add, xor = _lanes(lane, at.astype(np.uint64), salt)
        total[long] += np.add.reduceat(add, begin)
        other[long] ^= np.bitwise_xor.reduceat(xor, begin)
    return mix(total + mix(other + length.astype(np.uint64)))


class Spans:
    """128-bit BLAKE2b digests of word sequences [i, j): of the words themselves, joined by one space."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        length = ends - starts
        begin = np.cumsum(length + 1) - (length + 1)
        text = np.full(int(length.sum()) + len(length), 32, np.uint8)
        step = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        text[np.repeat(begin, length) + step] = data[np.repeat(starts, length) + step]
        self.text, self.begin, self.end = text.tobytes(), begin, begin + length

    def digests(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Rows of two 64-bit numbers; every sequence has at least one word."""
        text = self.text
        found = [blake2b(text[a:b], digest_size=16).digest() for a, b in zip(self.begin[i].tolist(), self.end[j - 1].tolist())]
        return np.frombuffer(b"".join(found), np.uint64).reshape(-1, 2)


class Sequences:
    """Hashes of word sequences [i, j) in O(1) each, from prefix sums; ``seed`` gives independent ones."""

    def __init__(self, words: np.ndarray, seed: int):
        base = (_BASE * (2 * seed + 3)) | 1
        base &= (1 << 64) - 1
        n = len(words)
        self.seed = np.uint64(seed)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(words + np.uint64(seed * 0x632BE59BD9B4E019 & (1 << 64) - 1)) * powers(base, n), out=self.sums[1:])
        self.back = powers(inverse(base), n + 1)

    def hash(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return mix((self.sums[j] - self.sums[i]) * self.back[i] + (j - i).astype(np.uint64))

    def all(self, k: int) -> np.ndarray:
        """Hashes of all sequences of k words."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:n]) * self.back[:n] + np.uint64(k))


def sliding_argmin(x: np.ndarray, w: int) -> np.ndarray:
    """For every run of w values the place of the smallest, the leftmost of equals."""
    n = len(x) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    at, span = np.arange(len(x)), 1
    while span < w:
        step = min(span, w - span)
        left, right = at[:-step], at[step:]
        at = np.where(x[left] <= x[right], left, right)
        span += step
    return at
