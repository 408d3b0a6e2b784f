"""Words and byte windows of many texts at once, as NumPy arrays of positions and 64-bit hashes."""

from __future__ import annotations

import numpy as np

BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASE, _SEED = 0x9E3779B97F4A7C15 | 1, 20240229


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all bits (in place)."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A random number for each byte, and odd multipliers for the places of a window.
TABLE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(_SEED))
PLACES = mix64(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2^64."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 1 << 16)
        inverse = pow(_BASE, -1, 1 << 64)
        made = []
        for base in (_BASE, inverse):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            made.append(np.cumprod(p))
        _powers = tuple(made)
    return _powers


def prefix_hashes(raw: np.ndarray) -> np.ndarray:
    """Polynomial prefix hashes: those of raw[a:b] are (out[b] - out[a]) * inverse power a."""
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(TABLE[raw] * powers(len(raw))[0][: len(raw)], out=out[1:])
    return out


class Words:
    """The words between ASCII white space of some texts: word i is raw[starts[i]:stops[i]], text t has words first[t] to first[t + 1]."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        joined = b" ".join([*texts, b""]) or b" "
        self.raw = np.frombuffer(joined.lower() if lower else joined, np.uint8)
        self.edges = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)])
        word = ~BLANK[self.raw]
        change = np.flatnonzero(np.diff(word.view(np.int8), prepend=0, append=0))
        self.starts, self.stops = change[::2], change[1::2]
        self.first = np.searchsorted(self.starts, self.edges)

    def hashes(self) -> np.ndarray:
        prefix = prefix_hashes(self.raw)
        h = (prefix[self.stops] - prefix[self.starts]) * powers(len(self.raw) + 1)[1][self.starts]
        return mix64(h + (self.stops - self.starts).astype(np.uint64))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of `size` consecutive elements; window i begins at element i, over the borders of texts too."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n] * PLACES[0]
    for k in range(1, size):
        out += hashes[k : k + n] * PLACES[k]
    return mix64(out)


def short_window(hashes: np.ndarray) -> np.ndarray:
    """One hash for a whole sequence of fewer elements than a window has."""
    parts = np.append(hashes, np.uint64(len(hashes))) * np.append(PLACES[: len(hashes)], PLACES[-1])
    return mix64(parts.sum(dtype=np.uint64, keepdims=True))
