"""64-bit hashes of words and of runs of words, by numpy over whole texts."""

from __future__ import annotations

import numpy as np

_U = np.uint64


def odd(n: int, seed: int, bits: int) -> np.ndarray:
    """n odd numbers of so many bits."""
    return np.random.default_rng(seed).integers(0, 1 << bits, n, dtype=np.uint64) | _U(1)


_BYTE = odd(256, 11, 64)
_P = 0x9E3779B97F4A7C15
_PINV = pow(_P, -1, 1 << 64)
KEPT_POWERS = 1 << 20
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power_table(n: int, p: int) -> np.ndarray:
    x = np.full(n, p, np.uint64)
    x[0] = 1
    return np.cumprod(x)


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > KEPT_POWERS:  # made for one text and let go
        return _power_table(n, _P), _power_table(n, _PINV)
    if len(_powers[0]) < n:
        n = 1 << n.bit_length()
        _powers[:] = [_power_table(n, _P), _power_table(n, _PINV)]
    return _powers[0], _powers[1]


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words of a text, parted by x20 and x09 to x0D, and the byte at which each begins."""
    low = np.frombuffer(raw, np.uint8)
    n = len(low)
    inside = np.zeros(n + 2, np.int8)
    inside[1:-1] = ~((low == 32) | ((low >= 9) & (low <= 13)))
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.empty(0, np.uint64), start
    power, inverse = _powers_to(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[low] * power[:n], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64)), start
