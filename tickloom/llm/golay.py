"""The perfect binary Golay code (23, 12, 7) on arrays of 23-bit words.

Every word lies within 3 bits of exactly one codeword, its *home*. A word 3 bits from home lies 4 bits from five more
codewords; a nearer one from none. Two facts make keys of this:

* words at most 2 bits apart have a codeword within 4 bits of both (the home of a word halfway between them);
* words 1 bit apart with different homes are 3 bits from their own and 4 from each other's, so it is enough that one
  side names the other's home: the side with the larger home does.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

BITS = 23
#: Fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101


def _remainder(x: int) -> int:
    for i in range(BITS - 1, 10, -1):
        if x >> i & 1:
            x ^= GENERATOR << (i - 11)
    return x


_PARITY = np.array([_remainder(m << 11) for m in range(1 << 12)], np.uint32)
_UNIT = [_remainder(1 << i) for i in range(BITS)]
#: syndrome -> the error of weight 3 or less, and the five of weight 4 (-1: none).
_NEAR = np.zeros(1 << 11, np.uint32)
_FAR = np.full((1 << 11, 5), -1, np.int64)


def _tables() -> None:
    count = [0] * (1 << 11)
    for weight in range(5):
        for places in combinations(range(BITS), weight):
            syndrome, error = 0, 0
            for p in places:
                syndrome ^= _UNIT[p]
                error |= 1 << p
            if weight < 4:
                _NEAR[syndrome] = error
            else:
                _FAR[syndrome, count[syndrome]] = error
                count[syndrome] += 1


_tables()


def home(words: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword within 3 bits."""
    w = words.astype(np.uint32)
    return (w ^ _NEAR[_PARITY[w >> 11] ^ (w & 2047)]) >> 11


def within_four(words: np.ndarray) -> np.ndarray:
    """(n, 6) indices of all codewords within 4 bits, the home first; -1 where there are fewer."""
    w = words.astype(np.int64)
    far = _FAR[_PARITY[w >> 11] ^ (w & 2047)]
    others = np.where(far < 0, -1, (w[:, None] ^ far) >> 11)
    return np.concatenate([home(words).astype(np.int64)[:, None], others], axis=1)


def one_apart(words: np.ndarray) -> np.ndarray:
    """(n, 6) indices such that words 1 bit apart or equal have one in common: the home, and smaller ones within 4 bits."""
    near = within_four(words)
    near[:, 1:][near[:, 1:] > near[:, :1]] = -1
    return near
