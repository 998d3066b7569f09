"""64-bit hashes of all words of whole texts, without a Python object per word.

The bytes of many texts lie in one array. Running sums of (random number of the byte) * B^place give
every word's polynomial hash as a difference, which the inverse power of its start makes
independent of the place; a final mix spreads it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import xxhash

_RANDOM = np.random.default_rng(20240501)
_OF_BYTE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_NEXT_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes hashed at once, so that the arrays stay in cache; a longer word is hashed whole all the same.
BLOCK = 1 << 18
#: Bytes of a word beyond which its hash is no polynomial: those of long strings can be made to meet.
LONG = 256


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers."""
    h = h ^ (h >> np.uint64(29))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class WordHasher:
    """Hashes of words `[^\\x20\\x09-\\x0D]+`, with A-Z in lower case if asked for."""

    def __init__(self, lower: bool = True):
        self.lower = lower
        self._grow(BLOCK + 1)

    def _grow(self, n: int) -> None:
        self._power, self._back = (
            np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, b, dtype=np.uint64)]), dtype=np.uint64) for b in (_BASE, _INVERSE)
        )

    def words(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, starts, ends, running sums) of the words of bytes that end in a blank."""
        data = np.frombuffer(raw, np.uint8)
        if len(data) > len(self._power):
            self._grow(len(data))
        edge = np.flatnonzero(np.diff(_BLANK[data].view(np.int8), prepend=np.int8(1)))
        return data, edge[::2], edge[1::2], np.cumsum(_OF_BYTE[data] * self._power[: len(data)])

    def hashes(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Hashes of the spans of bytes from `start` to `end`."""
        before = np.where(start > 0, total[start - 1], np.uint64(0))
        out = mix((total[end - 1] - before) * self._back[start])
        for i in np.flatnonzero(end - start > LONG):
            out[i] = xxhash.xxh3_64_intdigest(data[start[i] : end[i]].tobytes())
        return out

    def _hash(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(starts, hashes) of the words of bytes that end in a blank."""
        data, start, end, total = self.words(raw)
        return start, self.hashes(data, start, end, total)

    def pieces(self, raw: bytes) -> Iterator[bytes]:
        """A long text cut at blanks."""
        at = 0
        while len(raw) - at > 2 * BLOCK:
            cut = _NEXT_BLANK.search(raw, at + BLOCK)
            cut = cut.start() if cut else len(raw)
            yield raw[at:cut] + b" "
            at = cut
        yield raw[at:] + b" "

    def all(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The hashes of each text's words, in order; null and blank texts have none."""
        held: list[bytes] = []
        size = 0
        for text in texts:
            raw = (text or "").encode("utf-8", "surrogatepass")
            raw = raw.lower() if self.lower else raw
            if len(raw) > BLOCK:
                yield from self._flush(held)
                held, size = [], 0
                yield np.concatenate([self._hash(p)[1] for p in self.pieces(raw)])
                continue
            if size + len(raw) + 1 > BLOCK:
                yield from self._flush(held)
                held, size = [], 0
            held.append(raw)
            size += len(raw) + 1
        yield from self._flush(held)

    def _flush(self, held: list[bytes]) -> Iterator[np.ndarray]:
        if not held:
            return
        start, hashes = self._hash(b"\n".join(held) + b"\n")
        ends = np.searchsorted(start, np.cumsum([len(r) + 1 for r in held]))
        at = 0
        for end in ends.tolist():
            yield hashes[at:end]
            at = end
