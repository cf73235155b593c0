"""Hashes of words and of runs of words, for tasks in Python."""

import numpy as np
import xxhash

U64 = np.uint64
# Words remembered per worker; results do not depend on it.
CACHE_WORDS = 200_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finalizer of SplitMix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """64-bit numbers as doubles in [0, 1)."""
    return (x >> U64(11)).astype(float) * 2.0**-53


class WordHasher:
    """64-bit hashes of the words of a text; words lie between ASCII white space."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, text) -> np.ndarray:
        words = text.encode().split() if isinstance(text, str) else []
        known = self.known
        try:
            found = [known[w] for w in words]
        except KeyError:
            if len(known) > CACHE_WORDS:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            found = [known[w] for w in words]
        return np.array(found, dtype=U64)


class RunHasher:
    """Hashes of any run of words from sums of powers: equal runs, equal hashes.

    With x odd, hash(a, b) = x^-a * sum of h(i) x^i over a <= i < b, modulo 2^64.
    """

    def __init__(self, base: int):
        self.base, self.inverse = base | 1, pow(base | 1, -1, 1 << 64)
        self.up, self.down = np.ones(1, dtype=U64), np.ones(1, dtype=U64)

    def _grow(self, n: int) -> None:
        while len(self.up) < n:  # doubling: x^(m+i) = x^m * x^i
            m = len(self.up)
            step, back = pow(self.base, m, 1 << 64), pow(self.inverse, m, 1 << 64)
            self.up = np.concatenate([self.up, self.up * U64(step)])
            self.down = np.concatenate([self.down, self.down * U64(back)])

    def sums(self, words: np.ndarray) -> np.ndarray:
        self._grow(len(words) + 1)
        out = np.zeros(len(words) + 1, dtype=U64)
        np.cumsum(mix(words) * self.up[: len(words)], out=out[1:])
        return out

    def runs(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.down[start])
