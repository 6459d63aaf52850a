"""SetSketch registers of sets of 64-bit hashes, in numpy.

Register i of a set is floor(1 - log_b(x)), cut off to [0, q + 1], where x is the least of the set's exponential
values under the i-th hash: minima on an exponentially spaced scale. Sketches of unions are the maxima of registers.
With base b near 1 two registers are equal with a probability close to the sets' Jaccard similarity J, so that bands
of registers serve as keys; and of two sketches J follows by maximum likelihood from how many registers are greater,
equal and less, the sizes of the sets being known.
"""

from __future__ import annotations

from math import log

import numpy as np

BASE = 1.001
RATE = 20.0
CUT = 65_534
ROWS_PER_BAND = 5
BANDS = 30
REGISTERS = ROWS_PER_BAND * BANDS
_AT_ONCE = 4096
_GRID = 64


def _odd_numbers(seed: int, count: int) -> np.ndarray:
    drawn = np.random.Generator(np.random.PCG64(seed)).integers(0, 2**63, count, dtype=np.uint64)
    return drawn << np.uint64(1) | np.uint64(1)


_FACTORS, _SHIFTS = _odd_numbers(1, REGISTERS)[:, None], _odd_numbers(2, REGISTERS)[:, None]
_WORD_FACTORS, _BAND_FACTORS, _BAND_SEEDS = _odd_numbers(3, 64), _odd_numbers(4, ROWS_PER_BAND), _odd_numbers(5, BANDS)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def shingle_hashes(word_hashes: np.ndarray, length: int) -> np.ndarray:
    """Distinct hashes, ascending, of all runs of `length` words; of the whole sequence if it is shorter."""
    length = min(length, len(word_hashes))
    if not length:
        return word_hashes
    count = len(word_hashes) - length + 1
    total = np.full(count, length, np.uint64)
    for k in range(length):
        total += word_hashes[k:k + count] * _WORD_FACTORS[k]
    return np.unique(mixed(total))


def registers(hashes: np.ndarray) -> np.ndarray:
    least = np.full(REGISTERS, 2**64 - 1, np.uint64)
    for start in range(0, len(hashes), _AT_ONCE):
        part = hashes[None, start:start + _AT_ONCE] * _FACTORS
        part += _SHIFTS
        np.minimum(least, part.min(axis=1), out=least)
    share = (least.astype(np.float64) + 1.0) / 2.0**64
    x = -np.log1p(-np.minimum(share, 1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1 - np.log(x) / log(BASE)), 0, CUT + 1).astype(np.uint16)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One signed 64-bit key per band."""
    rows = sketch.reshape(BANDS, ROWS_PER_BAND).astype(np.uint64)
    return mixed((rows * _BAND_FACTORS).sum(axis=1, dtype=np.uint64) + _BAND_SEEDS).view(np.int64)


def _step(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1) / BASE) / log(BASE)


def estimate(first: np.ndarray, second: np.ndarray, n_first: np.ndarray, n_second: np.ndarray) -> np.ndarray:
    """Maximum-likelihood J for each row of two register matrices, the sizes of the sets being known."""
    more = (first > second).sum(axis=1)[:, None]
    less = (first < second).sum(axis=1)[:, None]
    same = first.shape[1] - more - less
    u = (n_first / (n_first + n_second))[:, None]
    v = 1 - u
    j = np.linspace(0, 1, _GRID)[None, :] * np.minimum(u / v, v / u)
    above, below = _step(np.maximum(u - v * j, 0)), _step(np.maximum(v - u * j, 0))

    def weighed(count, chance):
        return np.where(count > 0, count * np.log(np.maximum(chance, 1e-9)), 0.0)

    chance = weighed(more, above) + weighed(less, below) + weighed(same, 1 - above - below)
    return j[np.arange(len(j)), chance.argmax(axis=1)]
