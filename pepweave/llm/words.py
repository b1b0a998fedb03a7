"""Words of many texts at once: boundaries and 64-bit hashes over the UTF-8 bytes of an Arrow batch, in numpy.

All separators used here are ASCII, so byte classes decide exactly as code point classes do.
"""

from __future__ import annotations

import numpy as np
import xxhash

_BASE, _SEED = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Bytes hashed at once; bounds the temporary arrays. Cuts are made between words only.
PIECE = 1 << 21
#: Longer words go to XXH64 one by one.
LONG = 64
#: Masks of the first 0 .. 8 bytes of a little-endian number.
_FIRST = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], np.uint64)

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
NOT_BLANK = ~BLANK
#: [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F] after lower-casing: digits, letters, and all beyond ASCII.
WORDISH = np.zeros(256, bool)
WORDISH[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def bounds(raw: np.ndarray, offsets: np.ndarray, wordish: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and for each row the index of its first word (n + 1 values)."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = wordish[raw]
    first = np.empty_like(inside)
    first[0] = True
    first[1:] = ~inside[:-1]
    cuts = offsets[(offsets > 0) & (offsets < len(raw))]
    first[cuts] = True
    last = np.empty_like(inside)
    last[-1] = True
    last[:-1] = ~inside[1:]
    last[cuts - 1] = True
    starts = np.flatnonzero(inside & first)
    ends = np.flatnonzero(inside & last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes; equal words have equal hashes, other seeds give independent ones.

    Eight bytes at a time go through mix, which is a bijection, so words of one length up to eight bytes never collide.
    """
    n = len(starts)
    out = np.zeros(n, np.uint64)
    begin = np.full(1, seed, np.uint64) * _SEED
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE, "right")))
        lo, hi = starts[i], ends[j - 1]
        piece = raw[lo:hi]
        if lower:
            piece = LOWER[piece]
        s, lens = starts[i:j] - lo, ends[i:j] - starts[i:j]
        room = np.concatenate([piece, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(piece) + 1,), "<u8", room.data, strides=(1,))
        h = mix(lens.astype(np.uint64) * _BASE + begin)
        h = mix(h ^ (eight[s] & _FIRST[np.minimum(lens, 8)]))
        at, k = np.flatnonzero(lens > 8), 8
        while len(at) and k < LONG:
            h[at] = mix((h[at] + _BASE) ^ (eight[s[at] + k] & _FIRST[np.minimum(lens[at] - k, 8)]))
            k += 8
            at = at[lens[at] > k]
        for w in np.flatnonzero(lens > LONG).tolist():
            h[w] = xxhash.xxh64_intdigest(piece[s[w] : s[w] + lens[w]].tobytes(), 7 + seed)
        out[i:j] = h
        i = j
    return out


def grams(words: np.ndarray, k: int, factor: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """A hash of each run of k words; the last k - 1 places are left out, rows are not told apart."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    # polynomials of length a + b from those of lengths a and b
    power, poly, size = factor, words, 1
    out, have = None, 0
    while True:
        if k & size:
            out = poly if out is None else out[: len(words) - have - size + 1] * np.uint64(power) + poly[have : len(words) - size + 1]
            have += size
        if 2 * size > k:
            return mix(out)
        poly = poly[: len(words) - 2 * size + 1] * np.uint64(power) + poly[size:]
        power, size = power * power % 2**64, 2 * size


def grams_at(words: np.ndarray, places: np.ndarray, k: int, factor: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """What grams() has at these places."""
    out = words[places].copy()
    for j in range(1, k):
        out = out * np.uint64(factor) + words[places + j]
    return mix(out)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each w consecutive values."""
    have, out = 1, x
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[: len(out) - step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out


def slices(offsets: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Row ranges of at most limit bytes, or of one row."""
    out, i, n = [], 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        out.append((i, j))
        i = j
    return out


def starts_within(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Mask over word indices 0..total-n: True where n consecutive words lie in one row. first: n_rows + 1 values."""
    size = total - n + 1
    if size <= 0:
        return np.zeros(0, bool)
    counts = np.diff(first)
    left = np.repeat(first[1:], counts)[:size] - np.arange(size)  # words from here to the row's end
    return left >= n
