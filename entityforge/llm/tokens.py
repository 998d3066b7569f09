"""Token ids of whole texts by a public tokenizer, with the ids of each word kept in a cache.

The cache is a few NumPy arrays (sorted 64-bit word hashes, places and ids), bounded in words and
ids, so that a worker's memory does not depend on how long or how many the corpus's words are. Two
words of a corpus share a hash with a chance of some (words in the cache) / 2^64 per distinct word.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
from collections.abc import Iterator

import numpy as np

from entityforge.llm.wordhash import BLOCK, WordHasher

#: Words, and ids of words, that one worker keeps; beyond either, those that were not asked for again go.
CACHE_WORDS, CACHE_IDS = 400_000, 3_000_000
#: Words encoded in one call, and in one text of the call.
CALL_WORDS, PART_WORDS = 4096, 512
#: A control character that stands between words in such a call.
MARK = "\x01"
#: How the vocabulary marks a piece that ends a word.
WORD_END = "</w>"
#: Marks that often follow a word; each is a pre-token of its own after a letter.
TAILS = b",."
#: Combining marks that make one letter with a small or a capital ASCII letter only, but not with both.
_ONE_CASE = re.compile("[̱̈̊̌]")

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*b"abcdefghijklmnopqrstuvwxyz", *b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = True


class WordTokenizer:
    """Ids of texts by a `tokenizers` file whose pre-tokenizer never joins text across ASCII white space.

    Then a text's ids are those of its blank-separated words one after another. Each distinct word
    is encoded once; words that the cache lacks are encoded together, with a mark between them.
    Whether a file is of this kind is read from the file; texts of any other are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self._model = Tokenizer.from_file(path)
        parts = json.loads(self._model.to_str())
        self._by_words = _keeps_words_apart(parts)
        self._lowers = any(n["type"] == "Lowercase" for n in _steps(parts["normalizer"], "normalizers"))
        mark = self._ids(MARK)
        self._mark = mark[0] if len(mark) == 1 else -1
        vocabulary = self._model.get_vocab(with_added_tokens=True)
        top = max(vocabulary.values())
        self._kind = np.uint16 if top < 1 << 16 else np.uint32
        self._ends = np.zeros(top + 1, dtype=bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self._hasher = WordHasher(lower=False)
        self._tail_ids = [np.array(self._ids(chr(c)), dtype=self._kind) for c in TAILS]
        self._keep(np.zeros(0, dtype=bool))

    def _ids(self, text: str) -> list[int]:
        return self._model.encode(text, add_special_tokens=False).ids

    def _joined(self, words: list[str], between: str, mark: list[int]) -> np.ndarray:
        """Ids of words with something between them that has the ids `mark`; some words in one text of the call."""
        parts = [between.join(words[i : i + PART_WORDS]) for i in range(0, len(words), PART_WORDS)]
        found = [e.ids + mark for e in self._model.encode_batch_fast(parts, add_special_tokens=False)]
        ids = np.fromiter(itertools.chain.from_iterable(found), dtype=self._kind)
        return ids[: len(ids) - len(mark)] if found else ids

    def _keep(self, keep: np.ndarray) -> None:
        """Drops all words but these; the ids of `TAILS` always come first."""
        lead = np.concatenate(self._tail_ids)
        if keep.any():
            ids, sizes = self._gather(self._start[keep], self._size[keep])
            self._keys, self._size = self._keys[keep], self._size[keep]
            self._flat, self._used = np.concatenate([lead, ids]), len(lead) + len(ids)
            self._start = (len(lead) + np.cumsum(sizes) - sizes).astype(np.int32)
        else:
            self._keys, self._size, self._start = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
            self._flat, self._used = lead, len(lead)
        self._again = np.zeros(len(self._keys), dtype=bool)

    def _spans(self, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The words in another order, their ids one after another, and the number of ids of each."""
        letters = [w for w in words if w.isalpha()]
        # a run of letters is one pre-token, whose last piece alone has the word end
        ids = self._joined(letters, " ", [])
        stops = np.flatnonzero(self._ends[ids]) + 1
        if len(stops) != len(letters) or (len(stops) and stops[-1] != len(ids)):
            letters, ids, stops = [], ids[:0], stops[:0]
        taken = set(letters)
        mixed = [w for w in words if w not in taken and MARK not in w]
        more = self._joined(mixed, f" {MARK} ", [self._mark] if self._mark >= 0 else [])
        marks = np.flatnonzero(more == self._mark)
        if self._mark < 0 or len(marks) != max(len(mixed) - 1, 0):
            mixed, more, marks = [], more[:0], marks[:0]
        taken |= set(mixed)
        odd = [w for w in words if w not in taken]
        rest = [np.array(self._ids(w), dtype=self._kind) for w in odd]
        sizes = [np.diff(stops, prepend=0), np.diff(np.append(marks, len(more)), prepend=-1) - 1 if mixed else marks, list(map(len, rest))]
        without = np.delete(more, marks) if mixed else more
        return letters + mixed + odd, np.concatenate([ids, without, *rest]), np.concatenate(sizes).astype(np.int32)

    def _learn(self, words: list[str], keys: np.ndarray) -> None:
        """Adds words with these hashes."""
        of = dict(zip(words, keys.tolist()))
        words, ids, sizes = self._spans(list(of))
        if self._used + len(ids) > len(self._flat):
            self._flat = np.concatenate([self._flat[: self._used], np.zeros(max(len(ids), self._used // 2), self._kind)])
        self._flat[self._used : self._used + len(ids)] = ids
        start = (self._used + np.cumsum(sizes) - sizes).astype(np.int32)
        self._used += len(ids)
        keys = np.fromiter(map(of.__getitem__, words), dtype=np.uint64, count=len(words))
        order = np.argsort(keys)
        at = np.searchsorted(self._keys, keys[order])
        self._keys, self._start, self._size = (
            np.insert(old, at, new[order]) for old, new in ((self._keys, keys), (self._start, start), (self._size, sizes))
        )
        self._again = np.insert(self._again, at, False)

    def _places(self, raw: bytes, start: np.ndarray, end: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Where the table has the words of these spans; those that it lacks are learned."""
        distinct, first, back = np.unique(keys, return_index=True, return_inverse=True)
        at = np.searchsorted(self._keys, distinct)
        known = np.zeros(len(distinct), dtype=bool)
        if len(self._keys):
            known = self._keys[np.minimum(at, len(self._keys) - 1)] == distinct
            self._again[at[known]] = True
        fresh = np.flatnonzero(~known)
        for i in range(0, len(fresh), CALL_WORDS):
            some = first[fresh[i : i + CALL_WORDS]]
            self._learn([raw[s:e].decode("utf-8", "surrogatepass") for s, e in zip(start[some].tolist(), end[some].tolist())], keys[some])
        return (np.searchsorted(self._keys, distinct) if len(fresh) else at)[back]

    def _gather(self, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these places one after another, and their sizes."""
        upto = np.cumsum(sizes, dtype=np.int64)
        total = int(upto[-1]) if len(upto) else 0
        return self._flat[np.arange(total) + np.repeat(starts - (upto - sizes), sizes)], sizes

    def _block(self, raws: list[bytes]) -> list[np.ndarray]:
        """Ids of the words of each of some texts."""
        if len(self._keys) > CACHE_WORDS or self._used > CACHE_IDS:
            few = self._again.sum() * 2 <= CACHE_WORDS and self._size[self._again].sum() * 2 <= CACHE_IDS
            self._keep(self._again if few else self._again & False)
        raw = b"\n".join(raws) + b"\n"
        data, start, end, total = self._hasher.words(raw)
        count = np.searchsorted(start, np.cumsum([len(r) + 1 for r in raws]))
        # a run of ASCII letters before one comma or full stop is two pre-tokens
        others = np.cumsum(~_LETTER[data], dtype=np.int32)
        last = data[end - 1]
        tail = np.full(len(end), -1)
        for i, c in enumerate(TAILS):
            tail[last == c] = i
        split = (tail >= 0) & (end - start > 1)
        split[split] = others[end[split] - 2] == np.where(start[split] > 0, others[start[split] - 1], 0)
        stop = end - split
        at = self._places(raw, start, stop, self._hasher.hashes(data, start, stop, total))
        size, begin = self._size[at], self._start[at]
        items = np.repeat(np.arange(len(at)), 1 + split)
        second = np.append(False, items[1:] == items[:-1])
        tails = np.array([len(t) for t in self._tail_ids])
        sizes = np.where(second, tails[tail[items]], size[items])
        begins = np.where(second, (np.cumsum(tails) - tails)[tail[items]], begin[items])
        ids, _ = self._gather(begins, sizes)
        of_word = size + np.where(split, tails[tail], 0)
        upto = np.append(0, np.cumsum(of_word, dtype=np.int64))[np.append(0, count)]
        return [ids[a:b] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist())]

    def _bytes(self, text: str) -> bytes:
        raw = text.encode("utf-8", "surrogatepass")
        # the spelling of added tokens counts, and so does the case below some combining marks
        small = self._lowers and "<|" not in text and (len(raw) == len(text) or not _ONE_CASE.search(text))
        return raw.lower() if small else raw

    def encode_all(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, whole, without special tokens added; a text longer than a block is read in pieces."""
        if not self._by_words:
            yield from (np.array(self._ids(t), dtype=self._kind) for t in texts)
            return
        held: list[bytes] = []
        size = 0
        for text in texts:
            raw = self._bytes(text)
            if size + len(raw) >= BLOCK and held:
                yield from self._block(held)
                held, size = [], 0
            if len(raw) > BLOCK:
                yield np.concatenate([self._block([piece])[0] for piece in self._hasher.pieces(raw)])
                continue
            held.append(raw)
            size += len(raw) + 1
        if held:
            yield from self._block(held)


def _steps(part: dict | None, name: str) -> list[dict]:
    return [] if part is None else part[name] if part["type"] == "Sequence" else [part]


def _keeps_words_apart(parts: dict) -> bool:
    """Whether the first thing that cuts text is a split that takes runs without white space and drops the rest."""
    cuts = _steps(parts["pre_tokenizer"], "pretokenizers")
    first = cuts[0] if cuts else {"type": ""}
    letters = first.get("pattern", {}).get("Regex", "") if first["type"] == "Split" else ""
    drops = first.get("behavior") == "Removed" and first.get("invert") and "[^\\s" in letters and " " not in letters
    plain = all(n["type"] in ("NFC", "Replace", "Lowercase") for n in _steps(parts["normalizer"], "normalizers"))
    return bool(drops and plain and parts["model"].get("end_of_word_suffix") == WORD_END)


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    """One tokenizer per worker and file."""
    return WordTokenizer(path)
