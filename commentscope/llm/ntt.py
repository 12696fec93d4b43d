"""Exact convolution of many rows at once by number-theoretic transforms.

Values are residues of primes p < 2^30 for which 2^k divides p - 1. Products with a fixed factor w are taken
with the precomputed quotient ``w * 2^32 // p``, so no division is needed; values stay below 4p while a
transform runs. Arrays are (length, rows): a butterfly works on whole runs of memory.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: (prime, a generator of its multiplicative group): 7 * 2^26 + 1, 5 * 2^25 + 1 and 45 * 2^24 + 1.
PRIMES = ((469762049, 3), (167772161, 3), (754974721, 11))

_32 = np.uint64(32)


@lru_cache(maxsize=256)
def _roots(prime: int, generator: int, half: int, inverse: bool) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0 to half - 1 of a root of unity of order 2 * half, with their quotients, as columns."""
    root = pow(generator, (prime - 1) // (2 * half), prime)
    if inverse:
        root = pow(root, prime - 2, prime)
    powers = np.ones(half, np.uint64)
    done = 1
    while done < half:  # doubling: the second half is the first times a power
        powers[done:2 * done] = powers[:done] * np.uint64(pow(root, done, prime)) % np.uint64(prime)
        done *= 2
    return powers[:, None], ((powers << _32) // np.uint64(prime))[:, None]


def _times(x: np.ndarray, w, quotient, p: np.uint64) -> np.ndarray:
    """x * w modulo p, below 2p, for x below 2^32."""
    q = x * quotient
    q >>= _32
    q *= p
    out = x * w
    out -= q
    return out


def _less(x: np.ndarray, bound: np.uint64) -> None:
    """Takes ``bound`` off where x reaches it: a smaller x would wrap around and lose the minimum."""
    np.minimum(x, x - bound, out=x)


def forward(a: np.ndarray, prime: int, generator: int) -> None:
    """Transform the columns of a in place, in bit-reversed order; values come and go below 4p."""
    n, rows = a.shape
    p, two = np.uint64(prime), np.uint64(2 * prime)
    half = n // 2
    while half:
        w, quotient = _roots(prime, generator, half, False)
        v = a.reshape(n // (2 * half), 2, half, rows)
        low, high = v[:, 0], v[:, 1]
        _less(low, two)
        _less(high, two)
        difference = low - high
        difference += two
        low += high
        high[...] = _times(difference, w, quotient, p)
        half //= 2


def backward(a: np.ndarray, prime: int, generator: int) -> None:
    """Undo ``forward`` up to the factor n, in place; values come and go below 4p."""
    n, rows = a.shape
    p, two = np.uint64(prime), np.uint64(2 * prime)
    half = 1
    while half < n:
        w, quotient = _roots(prime, generator, half, True)
        v = a.reshape(n // (2 * half), 2, half, rows)
        low, high = v[:, 0], v[:, 1]
        _less(low, two)
        moved = _times(high, w, quotient, p)
        np.subtract(low, moved, out=high)
        high += two
        low += moved
        half *= 2


def correlation(block: np.ndarray, window: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """For every row the sums of ``block[t] * window[d + t]`` modulo the prime, for d from 0 to B - 1.

    ``block`` is (B, rows), ``window`` (2B, rows), both of residues; the window's last entry is not used.
    """
    width, rows = block.shape
    n, p = 2 * width, np.uint64(prime)
    turned = np.zeros((n, rows), np.uint64)
    turned[:width] = block[::-1]
    other = window.astype(np.uint64)
    other[-1] = 0
    forward(turned, prime, generator)
    forward(other, prime, generator)
    turned %= p
    other %= p
    turned *= other
    turned %= p
    backward(turned, prime, generator)
    scale = pow(n, prime - 2, prime)
    return _times(turned[width - 1:n - 1], np.uint64(scale), np.uint64((scale << 32) // prime), p) % p
