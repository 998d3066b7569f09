"""Counts over whole texts that several operators share."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

BLANKS = "\t\n\x0b\x0c\r "
#: The symbols that count as such.
SYMBOLS = "#*$%&|<>"


def words_of(text: str) -> list[str]:
    """Maximal runs of characters other than space and U+0009 to U+000D."""
    for c in "\t\n\x0b\x0c\r":
        if c in text:
            text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def _crc(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass"))


class WordNumbers(dict):
    """Word → number, in order of first use, with a hash of each word; both start anew when full.

    Full is by words or by their characters, whichever comes first, so words of any length fit a worker.
    Only between texts: one text's numbers stay valid, and its own words are held as long as it is.
    """

    LIMIT, LIMIT_CHARS = 1 << 18, 1 << 22

    def __init__(self, hash_of=_crc, dtype=np.uint32) -> None:
        super().__init__()
        self._hash = np.zeros(1 << 16, dtype=dtype)
        self._hash_of = hash_of
        self._fresh: list = []
        self._chars = 0

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self._fresh.append(word)
        return n

    def of(self, words: list) -> np.ndarray:
        """Numbers of the words; `hashes` takes them until the next call that finds the table full."""
        if len(self) > self.LIMIT or self._chars > self.LIMIT_CHARS:
            self.clear()
            self._hash, self._chars = np.zeros(1 << 16, dtype=self._hash.dtype), 0
        numbers = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        if self._fresh:
            first = len(self) - len(self._fresh)
            while len(self) > len(self._hash):
                self._hash = np.concatenate([self._hash, np.zeros_like(self._hash)])
            self._hash[first : len(self)] = np.fromiter(map(self._hash_of, self._fresh), dtype=self._hash.dtype, count=len(self._fresh))
            self._chars += sum(map(len, self._fresh))
            self._fresh = []
        return numbers

    def hashes(self, numbers: np.ndarray) -> np.ndarray:
        """Hash of each numbered word."""
        return self._hash[numbers]


def window_codes(numbers: np.ndarray, window: int) -> np.ndarray:
    """A number for each window of `window` words; equal windows, and only those, have equal numbers."""
    n = len(numbers) - window + 1
    if numbers.max() >> (63 // window) == 0:
        code, bits = numbers[:n].copy(), 63 // window
        for i in range(1, window):
            code = (code << bits) | numbers[i : i + n]
        return code
    # more distinct words than bits: prefixes are numbered anew before each further word
    kinds, local = np.unique(numbers, return_inverse=True)
    code = local[:n]
    for i in range(1, window):
        code = np.unique(code * len(kinds) + local[i : i + n], return_inverse=True)[1]
    return code


def repeated_words(numbers: np.ndarray, window: int = 3) -> int:
    """Words inside windows of `window` words that occur twice or more, the first ones included."""
    if len(numbers) <= window:
        return 0
    code = window_codes(numbers, window)
    ordered = np.sort(code)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    hit = np.isin(code, np.unique(twice))
    edge = np.zeros(len(numbers) + 1, dtype=np.int64)
    np.add.at(edge, np.flatnonzero(hit), 1)
    np.add.at(edge, np.flatnonzero(hit) + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def duplicate_lines(text: str) -> tuple[int, int]:
    """(lines with a word that equal an earlier line, lines with a word)."""
    lines = [x for x in text.split("\n") if x and x.strip(BLANKS)]
    return len(lines) - len(set(lines)), len(lines)


@dataclass
class Stats:
    """Counts of one text."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_lines: int
    n_repeat_words: int


def stats_of(text: str, numbers: np.ndarray) -> Stats:
    """Counts of a whole text whose words have these numbers."""
    dup, lines = duplicate_lines(text)
    return Stats(
        len(numbers),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        dup,
        lines,
        repeated_words(numbers),
    )
