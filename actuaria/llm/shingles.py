"""Hashed word shingles of whole texts, computed over arrays of bytes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_rng = np.random.default_rng(20240229)
#: A random number for each byte, the same for A-Z and a-z; white space marks word ends.
BYTE_VALUES = _rng.integers(1, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_VALUES[65:91] = BYTE_VALUES[97:123]
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, *range(9, 14)]] = True
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


#: Bytes that are summed at once: what a worker keeps does not grow with the longest text.
CHUNK = 1 << 18


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0 to n of the base and of its inverse."""
    up = np.full(n + 1, BASE, dtype=np.uint64)
    down = np.full(n + 1, BASE_INVERSE, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word, A-Z lower-cased; first word of each text, and the total)."""
    joined = b" ".join(texts) + b" "
    buffer = np.frombuffer(joined, dtype=np.uint8)
    space = SPACE[buffer]
    bounds = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        bounds = np.concatenate([[0], bounds])
    starts, ends = bounds[0::2], bounds[1::2]
    up, down = _powers(CHUNK)
    # Sums up to each word's begin and end, chunk by chunk: what came before is carried as one number.
    before, after, back = (np.empty(len(starts), dtype=np.uint64) for _ in range(3))
    carried, factor, inverse = np.zeros(1, dtype=np.uint64), up[:1], down[:1]
    for low in range(0, len(buffer), CHUNK):
        part = buffer[low : low + CHUNK]
        sums = np.concatenate([carried, carried + factor * np.cumsum(BYTE_VALUES[part] * up[: len(part)])])
        begun = slice(*np.searchsorted(starts, [low, low + CHUNK]))
        ended = slice(*np.searchsorted(ends, [low + 1, low + CHUNK + 1]))
        before[begun], back[begun] = sums[starts[begun] - low], down[starts[begun] - low] * inverse
        after[ended] = sums[ends[ended] - low]
        carried, factor, inverse = sums[-1:], factor * up[-1:], inverse * down[-1:]
    hashes = mix((after - before) * back + (ends - starts).astype(np.uint64))
    offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    return hashes, np.searchsorted(starts, offsets)


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The sorted distinct hashes of the ``size``-word shingles of each text.

    A text with fewer words has its whole sequence as one; one without words none.
    """
    hashes, first = word_hashes(texts)
    n = len(hashes)
    factors = [mix(np.array([k + 1], dtype=np.uint64))[0] | np.uint64(1) for k in range(size)]
    if n >= size:
        sums = np.zeros(n - size + 1, dtype=np.uint64)
        for k, factor in enumerate(factors):
            sums += hashes[k : n - size + 1 + k] * factor
        shingles = mix(sums)
    else:
        shingles = np.zeros(0, dtype=np.uint64)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= size:
            own = np.unique(shingles[a : b - size + 1])
        elif b > a:
            total = (hashes[a:b] * np.array(factors[: b - a])).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)
            own = mix(total ^ np.uint64(0xA5A5A5A5A5A5A5A5))
        else:
            own = np.zeros(0, dtype=np.uint64)
        out.append(own)
    return out
