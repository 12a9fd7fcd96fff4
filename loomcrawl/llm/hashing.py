"""Hashes of all words of a text at once, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

_P = 0x9E3779B97F4A7C15
_M = np.uint64(0xD6E8FEB86659FD93)
#: Bytes hashed at once; a longer text is cut at white space.
_PART = 1 << 18
#: Words of more bytes are hashed one at a time.
_LONG = 64
_powers: list[np.ndarray] = []


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64, for prefix sums that can be shifted back."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, _PART + 1)
        _powers[:] = [np.cumprod(np.where(np.arange(n) > 0, np.uint64(p), np.uint64(1)), dtype=np.uint64) for p in (_P, pow(_P, -1, 1 << 64))]
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _M
    h = (h ^ (h >> np.uint64(29))) * _M
    return h ^ (h >> np.uint64(32))


def range_hashes(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of values[a:b] for each pair; equal sequences have equal hashes wherever they stand."""
    up, down = power_tables(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], dtype=np.uint64, out=total[1:])
    return mix((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64))


def edges(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end byte of every word."""
    black = ~((b == 32) | ((b >= 9) & (b <= 13)))
    edge = np.flatnonzero(np.diff(np.concatenate(([False], black, [False])).astype(np.int8)))
    return edge[::2], edge[1::2]


def lanes(text: bytes) -> np.ndarray:
    """The eight bytes from each place of a text on, as one number; zeros follow the text."""
    return np.ndarray(len(text) + 1, "<u8", text + bytes(8), strides=(1,))


def lane(of: np.ndarray, s: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The numbers at s with no more than the `left` bytes that a word still has."""
    short = (np.maximum(8 - left, 0) * 8).astype(np.uint64)
    return of[s] << short >> short


def _part_words(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    s, e = edges(np.frombuffer(text, np.uint8))
    size, of = e - s, lanes(text)
    h = size.astype(np.uint64) * np.uint64(_P)
    at, k = np.arange(len(s)), 0
    while len(at):
        h[at] = mix(h[at] ^ lane(of, s[at] + k, size[at] - k))
        k += 8
        at = at[size[at] > k]
        if k >= _LONG:  # few words; one at a time
            h[at] = [xxhash.xxh64_intdigest(text[x:y]) for x, y in zip(s[at].tolist(), e[at].tolist())]
            break
    return h, s, e


def words(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of every word of a text in UTF-8."""
    found, base = [], 0
    while len(text) > _PART:
        cut = max(text.rfind(b" ", 0, _PART), text.rfind(b"\n", 0, _PART))
        if cut <= 0:  # a word longer than a part
            ends = [k for k in (text.find(b" ", _PART), text.find(b"\n", _PART)) if k > 0]
            cut = min(ends, default=len(text))
        h, s, e = _part_words(text[:cut])
        found.append((h, s + base, e + base))
        base, text = base + cut, text[cut:]
    h, s, e = _part_words(text)
    found.append((h, s + base, e + base))
    return tuple(np.concatenate(c) for c in zip(*found))
