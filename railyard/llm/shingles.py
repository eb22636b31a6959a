"""Word shingles of many texts at once, as 64-bit hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 20  # bytes of text that are hashed together
# fixed values: ASCII white space parts words, A-Z are lower-cased
SPACES = b" \t\n\x0b\x0c\r"
_draw = np.random.RandomState(20240229)
LETTER = _draw.randint(1, 1 << 62, 256, np.uint64)
LETTER[65:91] = LETTER[97:123]
SPACE = np.isin(np.arange(256), np.frombuffer(SPACES, np.uint8))
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
PLACE = _draw.randint(1, 1 << 62, 64, np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingler:
    """Distinct hashes of the n-word shingles of each text, sorted.

    With fewer words, the whole sequence is one shingle; without words there is none. A word
    is hashed as a polynomial over its bytes from running sums over the whole chunk.
    """

    def __init__(self, n: int):
        self.n, self.powers, self.inverses = n, None, None

    def _powers(self, size: int):
        if self.powers is None or len(self.powers) < size:
            size = max(size, CHUNK + (CHUNK >> 2))
            ones = np.full(size, BASE)
            ones[0] = 1
            self.powers = np.cumprod(ones)
            ones = np.full(size, INVERSE)
            ones[0] = 1
            self.inverses = np.cumprod(ones)
        return self.powers, self.inverses

    def sets(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        chunk, size = [], 0
        for text in texts:
            if chunk and size + len(text) > CHUNK:
                yield from self._chunk(chunk)
                chunk, size = [], 0
            chunk.append(text)
            size += len(text) + 1
        if chunk:
            yield from self._chunk(chunk)

    def _chunk(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        n = self.n
        raw = np.frombuffer(b" ".join(texts), np.uint8)
        edges = np.flatnonzero(np.diff(np.concatenate(([1], SPACE[raw].view(np.int8), [1]))))
        starts, ends = edges[::2], edges[1::2]
        powers, inverses = self._powers(len(raw) + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(LETTER[raw] * powers[: len(raw)])))
        words = mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))
        first = np.cumsum([0, *(len(t) + 1 for t in texts)])
        at = np.searchsorted(starts, first)  # first word of each text
        whole = max(0, len(words) - n + 1)
        runs = np.zeros(whole, np.uint64)
        for j in range(n):
            runs += words[j : j + whole] * PLACE[j]
        runs = mix(runs)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b - a >= n:
                yield np.unique(runs[a : b - n + 1])
            elif b > a:
                few = (words[a:b] * PLACE[: b - a]).sum(dtype=np.uint64)
                yield mix(few[None] + PLACE[40 + b - a] if few.ndim == 0 else few)
            else:
                yield np.zeros(0, np.uint64)


def node_of(shingles: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), signed=True)
