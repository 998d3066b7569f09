"""Packing of tokenised documents into sequences: dominance reduction, then best fit.

Bins are planned on the histogram of piece lengths, of which there are at most as many as a
sequence has tokens, whatever the corpus. The plan is a list of patterns with multiplicities; the
pieces themselves only get a rank in the order of length, and a rank finds its place in the plan.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityforge.llm.columns import Columns, as_columns, map_columns, names
from entityforge.llm.ranking import ordered_table, with_prefix
from entityforge.llm.scratch import Scratch
from entityforge.llm.tokens import tokenizer

#: A pattern: lengths in one sequence, and how many sequences look like that.
Pattern = tuple[tuple[int, ...], int]


class _Lengths:
    """Multiset of lengths with ordered lookups."""

    def __init__(self, counts: dict[int, int]):
        self.count = {s: n for s, n in counts.items() if n > 0}
        self.sizes = sorted(self.count)

    def take(self, size: int, n: int) -> None:
        self.count[size] -= n
        if not self.count[size]:
            del self.count[size]
            del self.sizes[bisect_right(self.sizes, size) - 1]

    def largest_within(self, room: int) -> int:
        """The largest length of at most `room`, else 0."""
        i = bisect_right(self.sizes, room)
        return self.sizes[i - 1] if i else 0

    def smallest(self, n: int) -> list[int]:
        """The n smallest, repeats counted; fewer if there are no more."""
        out: list[int] = []
        for s in self.sizes:
            out += [s] * min(self.count[s], n - len(out))
            if len(out) == n:
                break
        return out

    def best_pair(self, room: int) -> int:
        """The largest sum of two that is at most `room`, else 0."""
        lo, hi, best = 0, bisect_right(self.sizes, room) - 1, 0
        while lo <= hi:
            a, b = self.sizes[lo], self.sizes[hi]
            if a + b > room:
                hi -= 1
            elif lo == hi and self.count[a] < 2:
                break
            else:
                best = max(best, a + b)
                lo += 1
        return best


def dominance_reduction(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Fixes sequences that some optimal packing has; returns them and the lengths that stay.

    The longest piece is looked at first. A set with it is fixed where it dominates every other
    feasible set with it: alone where nothing else fits; with the piece that fills the sequence
    exactly; with the longest that fits where no two others fit, or where at most two fit and no
    two add up to more. Each rule holds as pieces go, so equal pieces are fixed together. Sweeps are
    repeated until none fixes anything.
    """
    left = _Lengths(counts)
    fixed: list[Pattern] = []
    changed = True
    while changed:
        changed = False
        for size in reversed(list(left.sizes)):
            while (n := left.count.get(size, 0)) > 0:
                left.take(size, 1)
                room = capacity - size
                partner = left.largest_within(room)
                others = left.smallest(3)
                rule = partner == room or sum(others[:2]) > room or len(others) < 2
                if not rule and (len(others) < 3 or sum(others) > room):
                    rule = partner >= left.best_pair(room)
                if not partner:
                    if n > 1:
                        left.take(size, n - 1)
                    fixed.append(((size,), n))
                elif rule:
                    left.take(partner, 1)
                    more = n - 1 if partner != size else (n - 2) // 2
                    more = min(more, left.count.get(partner, 0)) if partner != size else more
                    if more and partner == size:
                        left.take(size, 2 * more)
                    elif more:
                        left.take(size, more)
                        left.take(partner, more)
                    fixed.append(((size, partner), 1 + more))
                else:
                    left.count[size] = n
                    if n == 1:
                        left.sizes.insert(bisect_right(left.sizes, size), size)
                    break
                changed = True
    return fixed, dict(left.count)


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best fit, longest first, for all pieces of a length at once."""
    rooms: list[int] = []
    open_: dict[int, list[Pattern]] = {}

    def put(room: int, pattern: tuple[int, ...], n: int) -> None:
        if n:
            if room not in open_:
                rooms.insert(bisect_right(rooms, room), room)
                open_[room] = []
            open_[room].append((pattern, n))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            i = bisect_right(rooms, size - 1)
            if i < len(rooms):
                room = rooms[i]
                pattern, n = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    del rooms[i]
            else:
                room, pattern, n = capacity, (), left
            each = room // size
            full = min(n, left // each)
            put(room - each * size, pattern + (size,) * each, full)
            left -= full * each
            rest = n - full
            if rest and 0 < left < each:
                put(room - left * size, pattern + (size,) * left, 1)
                left, rest = 0, rest - 1
            if pattern:
                put(room, pattern, rest)
    return [p for room in rooms for p in open_[room]]


def plan(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Sequences for all pieces: those fixed by dominance, then best fit for the rest."""
    fixed, rest = dominance_reduction(counts, capacity)
    return fixed + best_fit(rest, capacity)


def places(patterns: list[Pattern], counts: dict[int, int]) -> np.ndarray:
    """The plan by rank: rows (first rank, sequence of that rank, offset), ranks in order of length.

    From one row to the next, a rank more is a sequence more.
    """
    begin, rank = {}, 0
    for size in sorted(counts):
        begin[size], rank = rank, rank + counts[size]
    rows, sequence = [], 0
    for pattern, n in patterns:
        offset = 0
        for size in pattern:
            rows.append((begin[size], sequence, offset))
            begin[size] += n
            offset += size
        sequence += n
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 3)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Pieces of at most `capacity` tokens of every text, followed by `end_id`.

    Only a longer text is cut, into pieces of `capacity` and a shorter last one. A null text is
    empty: one piece of one token. Returns doc_id, piece, start, length, ids_crc32 (of the ids as
    little-endian unsigned 32-bit numbers) and, if asked for, `ids` in that form.
    """
    schema = PIECES + (", ids binary" if with_ids else "")

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        words = tokenizer(tokenizer_path)
        for batch in batches:
            rows = []
            texts = [t or "" for t in batch["text"]]
            for doc_id, found in zip(batch["doc_id"], words.encode_all(texts)):
                ids = np.append(found, np.uint32(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    raw = part.tobytes()
                    rows.append((doc_id, piece, start, len(part), zlib.crc32(raw), *([raw] if with_ids else [])))
            yield as_columns(rows, names(schema))

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_columns(slim, run, schema, keep_tokenizer=True)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Packs the pieces of all texts into as few sequences of `capacity` tokens as the plan finds.

    Returns the pieces with sequence_id and offset (place in the sequence). Repeated rows are packed
    each on its own; null ids are kept; an empty table gives no rows. Texts of any length are read
    whole, block by block. Pieces of one length, id and number are interchangeable: which of them gets
    which place is not defined. Columns other than doc_id and text are not read. Only the histogram of lengths, at most `capacity` numbers, reaches the driver.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "pack")
    pieces = scratch.write(tokenize_pieces(docs, tokenizer_path, capacity, end_id), "pieces")
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    at = spark.sparkContext.broadcast(places(plan(counts, capacity), counts))
    ranked = with_prefix(ordered_table(scratch, pieces, ["length", "doc_id", "piece"], "ranked"), {"rank": F.lit(1)})
    scratch.keep_only("ranked")

    def placed(batches: Iterator[Columns]) -> Iterator[Columns]:
        table = at.value
        for batch in batches:
            rank = np.array(batch["rank"], dtype=np.int64)
            i = np.searchsorted(table[:, 0], rank, side="right") - 1
            batch["sequence_id"] = table[i, 1] + rank - table[i, 0]
            batch["offset"] = table[i, 2]
            yield batch

    schema = PIECES + ", sequence_id long, offset long"
    return map_columns(ranked.select(*pieces.columns, "rank"), placed, schema)
