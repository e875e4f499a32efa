"""Word shingle sets of many texts at once, as sorted 64-bit hashes."""

from __future__ import annotations

from functools import lru_cache
from hashlib import blake2b, shake_256

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes hashed at a time, which keeps the arrays in the cache.
CHUNK = 1 << 19
#: Bytes of a word up to which words are hashed together, eight bytes a step.
LONG = 512


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words without visible structure."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_PART = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


_LOW = np.uint64((1 << 32) - 1)


@lru_cache(maxsize=2)
def _numbers(key: bytes) -> np.ndarray:
    """What a key stands for: 32-bit numbers, four for each eight bytes of a word of up to LONG, and more for its size and the end."""
    return np.frombuffer(shake_256(key).digest(4 * (4 * (LONG // 8) + 8)), "<u4").astype(np.uint64)


def _word_hashes(raw: bytes, key: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, start of each word) of bytes; a word is a run of bytes other than white space.

    Two sums of products of a word's halves of eight bytes, each with the key's
    number for its place added: without the key no two words can be made to meet,
    and for any two of them a sum is equal under one key in 2^32.
    """
    inside = np.empty(len(raw) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(_SPACE[np.frombuffer(raw, np.uint8)], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, size = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray(len(raw) + 1, "<u8", raw + bytes(8), strides=(1,))
    of_key = _numbers(key)
    ends, k = of_key[:8], of_key[8:].reshape(-1, 4)
    one = (size.astype(np.uint64) + ends[0] & _LOW) * ends[1]
    two = (size.astype(np.uint64) + ends[2] & _LOW) * ends[3]
    rest, at = np.flatnonzero(size <= LONG), 0
    while len(rest):
        part = eight[start[rest] + at] & _PART[np.minimum(size[rest] - at, 8)]
        low, high = part & _LOW, part >> np.uint64(32)
        a, b, c, d = k[at // 8]
        one[rest] += (low + a & _LOW) * (high + b & _LOW)
        two[rest] += (low + c & _LOW) * (high + d & _LOW)
        at += 8
        rest = rest[size[rest] > at]
    value = mixed(mixed(one ^ (ends[4] << np.uint64(32) | ends[5])) + two)
    for i in np.flatnonzero(size > LONG).tolist():
        value[i] = int.from_bytes(blake2b(raw[start[i] : start[i] + size[i]], digest_size=8, key=key).digest(), "little")
    return value, start


def shingle_sets(texts: list[bytes | None], width: int = 4, key: bytes = b"") -> list[np.ndarray]:
    """For each UTF-8 text the sorted distinct hashes of its `width`-word shingles.

    A-Z are lower-cased and words are runs of other characters than space and
    U+0009 to U+000D. Fewer words than `width` are one shingle; no word, or a null
    text, is an empty set. Hashes under one `key`, of up to 64 bytes, can be compared.
    """
    out: list[np.ndarray] = []
    held: list[bytes] = []
    size = 0
    for text in texts:
        text = text or b""
        if held and size + len(text) + 1 > CHUNK:
            out += _sets(held, width, key)
            held, size = [], 0
        held.append(text)
        size += len(text) + 1
    return out + (_sets(held, width, key) if held else [])


def _sets(texts: list[bytes], width: int, key: bytes) -> list[np.ndarray]:
    words, start = _word_hashes((b" ".join(texts) + b" ").lower(), key)
    ends = np.cumsum([len(t) + 1 for t in texts])
    bounds = np.searchsorted(start, np.concatenate([[0], ends]))
    joined = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        joined = mixed(joined * _BASE ^ words[k : k + len(joined)])
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        n = b - a
        if n >= width:
            got = np.sort(joined[a : b - width + 1])
            out.append(got[np.append(True, got[1:] != got[:-1])])
        elif n:
            value = np.full(1, n, np.uint64)
            for w in words[a:b]:
                value = mixed(value * _BASE ^ w)
            out.append(value)
        else:
            out.append(np.zeros(0, np.uint64))
    return out
