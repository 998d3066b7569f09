"""Exact n-gram Jaccard join with set-relation skipping, down to connected components.

Equal sets are one set. Sets that share their smallest hash are compared with one of them, the
leader; those that link with it form its class, of which overlap and difference with the leader are
known from then on. The index lists of prefix tokens hold one entry per class and task, a block with
its ranges of sizes and positions, and pairs of blocks whose ranges rule a link out are skipped.
Only leaders of classes are compared; what their members can have in common follows from the
leaders' overlap and the members' differences, and only where that leaves a link open, and nothing
else has linked the classes, are members compared.

Exactness: any total order of tokens makes the prefix filter exact. Here rare tokens come first;
which tokens are frequent is counted over all documents, part by part, and only steers the order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityforge.llm.columns import Columns, as_columns, map_columns, names
from entityforge.llm.components import connected_components
from entityforge.llm.scratch import PARTITION_BYTES, Scratch, is_small, small_or_shuffled
from entityforge.llm.wordhash import WordHasher, mix

WORDS = 5
#: Tokens counted at once, and the count from which a token is ordered by frequency.
COUNTED_TOKENS, FREQUENT = 2_000_000, 3
#: Tokens ordered by frequency at most, 16 MB; beyond, the order is a little worse and results the same.
ORDERED_TOKENS = 1 << 20
#: Low bits of a token that tell, without a search, that it is not among those.
SIEVE = (1 << 21) - 1
#: Classes of one index list up to which one task pairs them, and entries of a block, which is skipped as one.
LIST_CLASSES, BLOCK = 2048, 32
#: Entries of lists with much in common that one task holds about, and pairs of one set that one task compares about.
TASK_ENTRIES, TASK_PAIRS = 100_000, 2048
#: Pairs of one set from which they are no longer counted side by side in a task.
BUSY_PAIRS = 1 << 17
#: Counted sets from which the list of a token is dealt to several tasks, and pairs of entries tested at once.
HOT_TOKEN, AT_ONCE = 50_000, 1 << 17
#: Turns that spare the last one pairs, by what they connect: with how many others of a list each class
#: is compared; 0: with the one that has fewest rare tokens.
WIDTHS = (0, 16, 64)
#: Pairs that a task remembers to have sent, 16 MB; the cluster drops those that are sent again.
SENT_PAIRS = 1_000_000
#: Stands for a null id.
NO_ID = -(1 << 63)

_P = np.uint64(0x9E3779B97F4A7C15)


def links(nx, ny, overlap):
    """100 * intersection >= 80 * union, for numbers, arrays or columns."""
    return overlap * 9 >= (nx + ny) * 4


class Shingles:
    """Sorted distinct 64-bit hashes of the word n-grams of whole texts."""

    def __init__(self, words: int = WORDS):
        self.words, self.hasher = words, WordHasher()

    def all(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The set of each text: A-Z in lower case; with fewer words, the whole sequence is one n-gram."""
        for h in self.hasher.all(texts):
            if not len(h):
                yield np.zeros(0, dtype=np.int64)
                continue
            n = min(self.words, len(h))
            code = h[: len(h) - n + 1] + np.uint64(n)
            for i in range(1, n):
                code = code * _P + h[i : len(h) - n + 1 + i]
            code = np.sort(mix(code).view(np.int64))
            yield code[np.append(True, code[1:] != code[:-1])]


def print_of(tokens: np.ndarray) -> int:
    """A 64-bit fingerprint of a set."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def check_of(tokens: np.ndarray) -> int:
    """A second, independent fingerprint: together 128 bits."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes(), seed=0x5EED) - (1 << 63)


def mark_of(tokens: np.ndarray, clashing: frozenset[int]) -> int:
    """What identifies a set: its fingerprint, or the second one where different sets share the first."""
    mark = print_of(tokens)
    return check_of(tokens) if mark in clashing else mark


SCAN = "kind int, doc long, key long, n int, print long, check long, least long"


def scan(docs: DataFrame) -> DataFrame:
    """Kind 0: one row per document with its key and its set's size, fingerprints and least token. Kind 1: tokens
    that a part of a task's distinct sets holds more than once, as `print`, with the count as `n`."""

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        shingles, seen, held, size = Shingles(), set(), [], 0

        def counted() -> Columns:
            token, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.int64),) * 2
            token, n = token[n > 1], n[n > 1]
            nothing = np.zeros(len(token), dtype=np.int64)
            return {"kind": np.ones(len(token), np.int32), "doc": nothing, "key": nothing, "n": n.astype(np.int32), "print": token, "check": nothing, "least": nothing}

        for batch in batches:
            rows = []
            for doc, key, tokens in zip(batch["doc"], batch["key"], shingles.all(batch["text"])):
                if not len(tokens):
                    rows.append((0, doc, key, 0, 0, 0, 0))
                    continue
                mark = print_of(tokens)
                rows.append((0, doc, key, len(tokens), mark, check_of(tokens), int(tokens[0])))
                if mark not in seen:
                    seen.add(mark)
                    held.append(tokens)
                    size += len(tokens)
                    if size >= COUNTED_TOKENS:
                        yield counted()
                        seen, held, size = set(), [], 0
            yield as_columns(rows, names(SCAN))
        yield counted()

    return map_columns(docs, run, SCAN)


SENT = "group long, salt int, lead boolean, x_leads boolean, set long, tokens binary"
OVERLAPS = "x long, y long, nx int, ny int, overlap int"


class _Sets:
    """All distinct sets, by the key of a row that has each; their tokens are made from the texts when asked for."""

    def __init__(self, scratch: Scratch, base: DataFrame, sets: DataFrame, clashing: frozenset[int]):
        self.scratch, self.base, self.sets, self.clashing = scratch, base, sets, clashing

    def overlaps(self, pairs: DataFrame, name: str) -> DataFrame:
        """(x, y, nx, ny, overlap) of each of the distinct pairs (x, y) of sets, a table.

        Of a pair, the set that is in more pairs on its side leads: the other one's tokens travel to it,
        and a set that is in very many pairs is sent once to each of the tasks that its pairs are dealt to.
        """
        scratch, clashing = self.scratch, self.clashing
        pairs = scratch.write(pairs.select("x", "y"), f"{name}_pairs")
        few = is_small(pairs)

        def aside(df: DataFrame, what: str) -> DataFrame:
            """A table of two rows a pair at most, for a join: broadcast where pairs are counted and few."""
            return F.broadcast(df) if few else small_or_shuffled(scratch.write(df, f"{name}_{what}"))

        # few pairs take one task, without a shuffle
        pairs = pairs.coalesce(1) if few else pairs
        beside = lambda df: df.withColumns({f"d{c}": F.count("*").over(Window.partitionBy(c)) for c in ("x", "y")})
        busy = {} if few else {c: pairs.groupBy(F.col(c).alias(f"_{c}")).agg(F.count("*").alias(f"b{c}")).filter(F.col(f"b{c}") > BUSY_PAIRS) for c in ("x", "y")}
        busy = {c: scratch.write(df, f"{name}_busy_{c}") for c, df in busy.items()}
        if any(df.limit(1).count() for df in busy.values()):
            # sets in very many pairs are counted by partial sums, and so outrank all others; those are counted among themselves
            met = pairs
            for c, df in busy.items():
                met = met.join(small_or_shuffled(df), F.col(c) == F.col(f"_{c}"), "left")
            calm = met.filter("bx is null and by is null").select("x", "y")
            loud = met.filter("bx is not null or by is not null").select("x", "y", *[F.coalesce(f"b{c}", F.lit(0)).cast("long").alias(f"d{c}") for c in ("x", "y")])
            pairs = beside(calm).unionByName(loud)
        else:
            pairs = beside(pairs)
        x_leads = F.struct("dx", "x") >= F.struct(F.col("dy").alias("dx"), F.col("y").alias("x"))
        led = pairs.select(
            F.when(x_leads, F.col("x")).otherwise(F.col("y")).alias("group"), F.when(x_leads, F.col("y")).otherwise(F.col("x")).alias("set"),
            F.ceil(F.greatest("dx", "dy") / TASK_PAIRS).cast("int").alias("salts"), x_leads.alias("x_leads"),
        )
        salt = F.pmod(F.xxhash64("set"), F.col("salts")).cast("int")
        asked = led.select("set", F.struct("group", salt.alias("salt"), F.lit(False).alias("lead"), "x_leads").alias("ask"))
        leads = led.select("group", "salts", F.col("group").alias("set")).distinct()
        leads = leads.select("set", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "group")
        leads = leads.select("set", F.struct("group", "salt", F.lit(True).alias("lead"), F.lit(True).alias("x_leads")).alias("ask"))
        # a set that does not lead is in no more pairs than twice the root of all pairs
        asks = asked.unionByName(leads)
        asks = (asks.coalesce(1) if few else asks).groupBy("set").agg(F.collect_list("ask").alias("asks"))
        wanted = aside(asks, "asks")
        keyed = aside(self.sets.select("set", "key").join(wanted, "set").select(F.col("key").alias("_key"), "set", "asks"), "keyed")

        def send(batches: Iterator[Columns]) -> Iterator[Columns]:
            shingles, sent = Shingles(), set()
            for batch in batches:
                rows = []
                for wanted_set, key, asks, tokens in zip(batch["set"], batch["_key"], batch["asks"], shingles.all(batch["text"])):
                    # rows may repeat id and text
                    if key not in sent and len(tokens) and mark_of(tokens, clashing) == wanted_set:
                        sent.add(key)
                        raw = tokens.tobytes()
                        rows += [(a["group"], a["salt"], a["lead"], a["x_leads"], wanted_set, raw) for a in asks]
                for at in range(0, len(rows), 2000):
                    yield as_columns(rows[at : at + 2000], names(SENT))

        def compare(batches: Iterator[Columns]) -> Iterator[Columns]:
            place, lead, own, last = None, None, 0, None
            for batch in batches:
                rows = []
                for group, salt, leads, x_leads, other, raw in zip(*(batch[k] for k in names(SENT))):
                    if (group, salt, leads, x_leads, other) == last:  # of rows that repeat id and text
                        continue
                    last = (group, salt, leads, x_leads, other)
                    tokens = np.frombuffer(raw, np.int64)
                    if leads:
                        place, lead, own = (group, salt), tokens, group
                    elif place == (group, salt):
                        small, large = (tokens, lead) if len(tokens) < len(lead) else (lead, tokens)
                        at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                        shared = int((large[at] == small).sum())
                        rows.append((own, other, len(lead), len(tokens), shared) if x_leads else (other, own, len(tokens), len(lead), shared))
                yield as_columns(rows, names(OVERLAPS))

        texts = self.base.join(keyed, F.col("key") == F.col("_key")).select("_key", "set", "asks", "text")
        dealt = map_columns(texts, send, SENT).repartition(scratch.parts, "group", "salt")
        dealt = dealt.sortWithinPartitions("group", "salt", F.col("lead").desc(), "x_leads", "set")
        found = scratch.write(map_columns(dealt, compare, OVERLAPS), f"{name}_overlaps")
        scratch.drop(*(f"{name}_{k}" for k in ("asks", "keyed")))
        return found


POSTING = "token long, salt int, class long, n_min int, rare int, n_max int, left int"
LIVE = POSTING + ", least long"


def _postings(docs: DataFrame, classes: DataFrame, frequent: tuple[np.ndarray, np.ndarray], clashing: frozenset[int]) -> DataFrame:
    """Prefix tokens of all sets, one entry per token, class and batch; a set that `classes`
    (_key, _member, class) do not name is its own class.

    `left`: how much of a member's set lies at or behind the token, at most. Tokens that are not
    frequent come first, by hash; then frequent ones by count. `rare`: how many of the former a member
    has, at least; the fewer, the more of a set can be found elsewhere.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        shingles, (often, count) = Shingles(), shared.value
        sieve = np.zeros(SIEVE + 1, dtype=bool)
        sieve[often & SIEVE] = True
        hot, parts_of = often[count >= HOT_TOKEN], -(-count[count >= HOT_TOKEN] // HOT_TOKEN)

        def salts_of(token: np.ndarray, cls: np.ndarray) -> np.ndarray:
            """0, or 1 and more for tokens of so many sets that their lists are dealt to several tasks."""
            out = np.zeros(len(token), dtype=np.int32)
            if len(hot):
                at = np.minimum(np.searchsorted(hot, token), len(hot) - 1)
                is_hot = hot[at] == token
                out[is_hot] = 1 + (mix(cls[is_hot].view(np.uint64)) % parts_of[at[is_hot]].astype(np.uint64)).astype(np.int32)
            return out

        for batch in batches:
            parts, sizes, owner, few = [], [], [], []
            seen: set[tuple[int, int]] = set()
            for tokens, member, known in zip(shingles.all(batch["text"]), batch["_member"], batch["class"]):
                n = len(tokens)
                if not n:
                    continue
                mark = mark_of(tokens, clashing)
                cls = known if member == mark else mark
                if (mark, cls) in seen:
                    continue
                seen.add((mark, cls))
                maybe, rare = np.flatnonzero(sieve[tokens & SIEVE]), n
                if len(maybe):
                    at = np.minimum(np.searchsorted(often, tokens[maybe]), len(often) - 1)
                    weight = np.zeros(n, dtype=np.int64)
                    weight[maybe] = np.where(often[at] == tokens[maybe], count[at], 0)
                    tokens = tokens[np.lexsort((tokens, weight))]
                    rare = int((weight == 0).sum())
                parts.append(tokens[: n - (4 * n + 4) // 5 + 1])
                sizes.append(n)
                few.append(rare)
                owner.append(cls)
            if not parts:
                continue
            lengths = np.array([len(p) for p in parts])
            token, n, rare = np.concatenate(parts), np.repeat(sizes, lengths), np.repeat(few, lengths)
            place = np.arange(len(token)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            cls, left = np.repeat(np.array(owner, dtype=np.int64), lengths), n - place
            order = np.lexsort((token, cls))
            token, cls, n, left, rare = token[order], cls[order], n[order], left[order], rare[order]
            first = np.flatnonzero(np.append(True, (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])))
            yield {
                "token": token[first], "salt": salts_of(token[first], cls[first]), "class": cls[first], "n_min": np.minimum.reduceat(n, first).astype(np.int32), "rare": np.minimum.reduceat(rare, first).astype(np.int32),
                "n_max": np.maximum.reduceat(n, first).astype(np.int32), "left": np.maximum.reduceat(left, first).astype(np.int32),
            }

    placed = docs.join(small_or_shuffled(classes), F.col("key") == F.col("_key"), "left").select("text", "_member", "class")
    return map_columns(placed, run, POSTING)


def _may_link(a: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of blocks are not connected yet and hold sizes and positions that allow a link.

    Nine times the smaller of an int32 count stays below 2^31 for sets of up to 2 * 10^8 tokens.
    """
    near = (a["n_max"][i] * 5 >= a["n_min"][j] * 4) & (a["n_max"][j] * 5 >= a["n_min"][i] * 4)
    most = np.minimum(a["left"][i], a["left"][j])
    return near & (most * 9 >= (a["n_min"][i] + a["n_min"][j]) * 4) & (a["root"][i] != a["root"][j])


def _starts(a: dict[str, np.ndarray], *keys: str) -> np.ndarray:
    """Where entries begin that differ from the one before in some key."""
    differs = np.zeros(max(len(a[keys[0]]) - 1, 0), dtype=bool)
    for k in keys:
        differs |= a[k][1:] != a[k][:-1]
    return np.flatnonzero(np.append(True, differs)) if len(a[keys[0]]) else np.zeros(0, np.int64)


def _shared(a: dict[str, np.ndarray]) -> np.ndarray:
    """Which entries are of a list of two or more; parts of a hot token's list count as such."""
    size = np.diff(np.append(_starts(a, "token", "salt"), len(a["token"])))
    return (np.repeat(size, size) > 1) | (a["salt"] > 0)


def _live_lists(scratch: Scratch, postings: DataFrame) -> DataFrame:
    """Entries of the index lists that hold more than one class, one per class, with the least class of the list."""

    def run(batches: Iterator[dict[str, np.ndarray]]) -> Iterator[dict[str, np.ndarray]]:
        for a in _whole_lists(batches, "token", "salt"):
            order = np.flatnonzero(_shared(a))
            if not len(order):
                continue
            order = order[np.lexsort((a["class"][order], a["salt"][order], a["token"][order]))]
            a = {k: v[order] for k, v in a.items()}
            first = _starts(a, "token", "salt", "class")
            a = {k: f.reduceat(a[k], first) for k, f in zip(names(POSTING), (np.minimum,) * 5 + (np.maximum,) * 2)}
            keep = _shared(a)
            a = {k: v[keep] for k, v in a.items()}
            if len(a["token"]):
                first = _starts(a, "token", "salt")
                yield a | {"least": np.repeat(a["class"][first], np.diff(np.append(first, len(a["token"]))))}

    ordered = postings.repartition(scratch.parts, "token", "salt").sortWithinPartitions("token", "salt")
    return map_columns(ordered, run, LIVE, arrays=True)


def _whole_lists(batches: Iterator[dict[str, np.ndarray]], *keys: str) -> Iterator[dict[str, np.ndarray]]:
    """Batches in which entries that agree in `keys` follow each other, cut so that no such run spans two."""
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        if not len(batch[keys[0]]):
            continue
        a = {k: np.concatenate([held[k], v]) if held else v for k, v in batch.items()}
        cut = int(_starts(a, *keys)[-1])
        held = {k: v[cut:] for k, v in a.items()}
        if cut:
            yield {k: v[:cut] for k, v in a.items()}
    if held and len(held[keys[0]]):
        yield held


def _block_pairs(a: dict[str, np.ndarray], first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of entries of one list that are not connected and may link; lists begin at `first`, ordered by size.

    Lists are cut into blocks of `BLOCK` entries. A pair of blocks is skipped as one where their ranges
    of sizes, or how much of their sets lies at or behind the token, rule out a link, or where all of
    their classes are connected already; only entries of the other pairs of blocks are looked at.
    """
    size = np.diff(np.append(first, len(a["token"])))
    count = -(-size // BLOCK)
    of_list = np.repeat(np.arange(len(first)), count)
    number = np.arange(len(of_list)) - np.repeat(np.cumsum(count) - count, count)
    start = first[of_list] + number * BLOCK
    length = np.minimum(start + BLOCK, (first + size)[of_list]) - start
    low, high, left = np.minimum.reduceat(a["n_min"], start), np.maximum.reduceat(a["n_max"], start), np.maximum.reduceat(a["left"], start)
    root, top = np.minimum.reduceat(a["root"], start), np.maximum.reduceat(a["root"], start)
    # each block with itself and those after it in its list
    partners = count[of_list] - number
    for some in _portions(partners):
        i = np.repeat(some, partners[some])
        j = i + np.arange(len(i)) - np.repeat(np.cumsum(partners[some]) - partners[some], partners[some])
        near = (high[i] * 5 >= low[j] * 4) & (high[j] * 5 >= low[i] * 4) & (np.minimum(left[i], left[j]) * 9 >= (low[i] + low[j]) * 4)
        near &= ~((root[i] == top[i]) & (root[j] == top[j]) & (root[i] == root[j]))
        i, j = i[near], j[near]
        area = length[i] * length[j]
        for part in _portions(area):
            at = np.arange(int(area[part].sum())) - np.repeat(np.cumsum(area[part]) - area[part], area[part])
            wide = np.repeat(length[j[part]], area[part])
            x, y = np.repeat(start[i[part]], area[part]) + at // wide, np.repeat(start[j[part]], area[part]) + at % wide
            ok = np.flatnonzero(x < y)
            ok = ok[_may_link(a, x[ok], y[ok])]
            yield x[ok], y[ok]


def _portions(weight: np.ndarray) -> Iterator[np.ndarray]:
    """Indexes in order, some at a time, so that their weights add up to about `AT_ONCE`."""
    upto = np.cumsum(weight)
    at = 0
    while at < len(weight):
        end = max(int(np.searchsorted(upto, (upto[at - 1] if at else 0) + AT_ONCE, side="right")), at + 1)
        yield np.arange(at, end)
        at = end


def _ordered_pairs(a: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of classes of these entries, x < y."""
    one, two = a["class"][i], a["class"][j]
    x, y = np.minimum(one, two), np.maximum(one, two)
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    first = np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])) if len(x) else np.zeros(0, dtype=bool)
    return x[first], y[first]


class _Sent:
    """Pairs that a task has sent, a bounded number of them, by 128 bits."""

    def __init__(self):
        self.marks = self.more = np.zeros(0, dtype=np.uint64)

    def new(self, a: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> Columns:
        """The pairs of classes of these entries, x < y, each once, without those sent before."""
        x, y = _ordered_pairs(a, i, j)
        u, v = x.view(np.uint64), y.view(np.uint64)
        marks, more = mix(u * _P + v), u + v * _P
        fresh = np.ones(len(x), dtype=bool)
        if len(self.marks):
            at = np.minimum(np.searchsorted(self.marks, marks), len(self.marks) - 1)
            fresh = (self.marks[at] != marks) | (self.more[at] != more)
        if fresh.any():
            held = len(self.marks) if len(self.marks) < SENT_PAIRS else 0
            marks, more = np.concatenate([self.marks[:held], marks[fresh]]), np.concatenate([self.more[:held], more[fresh]])
            order = np.argsort(marks)
            self.marks, self.more = marks[order], more[order]
        return {"x": x[fresh], "y": y[fresh]}


def _heavy(scratch: Scratch, lists: DataFrame, name: str) -> DataFrame:
    """`least` of lists that together hold very many entries, and how many tasks those are dealt to."""
    heavy = lists.groupBy("least").agg(F.count("*").alias("_n")).filter(F.col("_n") > TASK_ENTRIES)
    heavy = heavy.select(F.col("least").alias("_least"), F.ceil(F.col("_n") / TASK_ENTRIES).cast("int").alias("_parts"))
    return small_or_shuffled(scratch.write(heavy, f"{name}_heavy"))


def _dealt(scratch: Scratch, lists: DataFrame, heavy: DataFrame) -> DataFrame:
    """Lists with one `least` have much in common and go to one task, which sends a pair once; where they
    hold very many entries, to several, by token. The cluster drops pairs that two tasks send."""
    part = F.coalesce(F.pmod(F.xxhash64("token", "salt"), F.col("_parts")).cast("int"), F.lit(0)).alias("part")
    marked = lists.join(heavy, F.col("least") == F.col("_least"), "left").select(*names(POSTING), "root", "least", part)
    return marked.repartition(scratch.parts, "least", "part").sortWithinPartitions("least", "part", "token", "salt")


def _pairs(scratch: Scratch, lists: DataFrame, heavy: DataFrame, width: int | None, turn: int) -> DataFrame:
    """Pairs of classes of a list that are not connected and may link, x < y.

    Width 0: the class with the fewest rare tokens, which has most in common with others, with each
    other. A width: each class with the next `width` in an order that depends on the turn and the
    class alone, so that lists with the same classes make the same pairs. None: all.
    """
    salt = np.uint64((2 * turn + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)

    def run(batches: Iterator[dict[str, np.ndarray]]) -> Iterator[Columns]:
        sent = _Sent()
        for a in _whole_lists(batches, "token", "salt"):
            spread = mix(a["class"].view(np.uint64) ^ salt)
            within = {0: (a["class"], a["rare"]), None: (a["class"], a["n_min"])}.get(width, (spread,))
            order = np.lexsort((*within, a["salt"], a["token"]))
            a = {k: v[order] for k, v in a.items()}
            first = _starts(a, "token", "salt")
            if width is None:
                for i, j in _block_pairs(a, first):
                    yield sent.new(a, i, j)
                continue
            of_list = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(a["token"]))))
            if width == 0:
                centre, i = first[of_list], np.arange(len(of_list))
                ok = np.flatnonzero(_may_link(a, centre, i))
                yield sent.new(a, centre[ok], ok)
                continue
            # entry i meets the one d places on, as long as any two share a list
            d, i = 1, np.arange(len(of_list) - 1)
            while len(i) and d <= width:
                i = i[i + d < len(of_list)]
                i = i[of_list[i] == of_list[i + d]]
                ok = i[_may_link(a, i, i + d)]
                if len(ok):
                    yield sent.new(a, ok, ok + d)
                d += 1

    laid = _dealt(scratch, lists, heavy).select(*names(POSTING), "root")
    return map_columns(laid, run, "x long, y long", arrays=True).distinct()


class _Verifier:
    """Compares pairs of sets, each pair once."""

    def __init__(self, scratch: Scratch, sets: _Sets):
        self.scratch, self.sets, self.done, self.turn = scratch, sets, None, 0

    def verify(self, pairs: DataFrame) -> None:
        """Adds the pairs that were not compared before to `done` (x, y, nx, ny, overlap)."""
        self.turn += 1
        if self.done is not None:
            pairs = pairs.join(self.done.select("x", "y"), ["x", "y"], "left_anti")
        made = self.sets.overlaps(pairs, f"turn{self.turn}")
        self.done = made if self.done is None else self.done.unionByName(made)

    def links(self) -> DataFrame:
        """(u, v) of all compared pairs that link."""
        return self.done.filter(links(F.col("nx"), F.col("ny"), F.col("overlap"))).select(F.col("x").alias("u"), F.col("y").alias("v"))


def doc_of(id_col: str) -> Column:
    """The id, `NO_ID` for null."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))


def row_key(id_col: str, text_col: str) -> Column:
    """A hash of id and text, by which rows meet what is known of them: ids may be null or repeat."""
    return F.xxhash64(doc_of(id_col), F.col(text_col).cast("string"))


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Two rows link when their sets of distinct 5-word shingles have 100 * intersection >= 80 * union;
    component_id is the smallest id reachable by links, the row's own included. Texts without words
    and null texts link with nothing. Repeated rows are kept; rows that share an id, or have none,
    are linked by their texts alone, and a null id is the smallest. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    rooted = _rooted_rows(scratch, docs, id_col, text_col)
    shared = rooted.filter("n > 0").groupBy("root").agg(F.min("doc").alias("least_doc"), F.count("*").alias("k")).filter("k > 1")
    shared = small_or_shuffled(scratch.write(shared.select(F.col("root").alias("_root"), "least_doc"), "shared"))
    scratch.keep_only("rooted", "shared")
    out = rooted.join(shared, (F.col("root") == F.col("_root")) & (F.col("n") > 0), "left")
    real = lambda c: F.when(c != NO_ID, c)
    return out.select(
        real(F.col("doc")).alias(id_col), F.col("n").cast("long").alias("n_shingles"), real(F.coalesce("least_doc", "doc")).alias("component_id")
    )


def spare_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two tables (_doc, _key) of `doc_of` and `row_key`: rows that go, so that of each component the one with
    the smallest id, then key, is left; and rows that are left but repeated, of which all but one go too."""
    scratch = Scratch(docs.sparkSession, "spare")
    rooted = _rooted_rows(scratch, docs, id_col, text_col).filter("n > 0")
    lead = rooted.groupBy("root").agg(F.min(F.struct("doc", "key")).alias("_lead"), F.count("*").alias("_k")).filter("_k > 1")
    lead = small_or_shuffled(scratch.write(lead.select(F.col("root").alias("_root"), "_lead"), "lead"))
    row = rooted.join(lead, F.col("root") == F.col("_root")).select(F.col("doc").alias("_doc"), F.col("key").alias("_key"), (F.struct("doc", "key") == F.col("_lead")).alias("_leads"))
    gone = scratch.write(row.filter("not _leads").select("_doc", "_key").distinct(), "gone")
    again = scratch.write(row.filter("_leads").groupBy("_doc", "_key").count().filter("count > 1").select("_doc", "_key"), "again")
    scratch.keep_only("gone", "again")
    return gone, again


def link_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_links) of every row: how many other rows link with it.

    Rows without words link with nothing; copies of one set link with each other and are counted, not paired; ids
    may be null or repeat, and empty input gives no rows. Links exist inside components only. Each component has a
    pivot, the set with most rows, and every set x of it is compared with that pivot p: two sets share at least
    |x & p| + |y & p| - |p| tokens and at most what is left of one beyond the other's part of p. With
    s(x) = 9 |x & p| - 4 |x|, a link is sure where s(x) + s(y) >= 9 |p|; such links are counted from sums over the
    values of s, without pairs. Sets with 2 s(x) >= 9 |p| are sure to link with each other, so the index lists skip
    their pairs block by block; of all other pairs only those that the bounds leave open are compared.
    """
    scratch, open_ = Scratch(docs.sparkSession, "links"), Scratch(docs.sparkSession, "open")
    scanned = _scanned(scratch, docs, id_col, text_col)
    base, rows, frequent, clashing = scanned
    rooted = _rooted_rows(scratch, docs, id_col, text_col, scanned)
    scratch.keep_only("scan", "rooted")
    open_.parts = scratch.parts

    # sets of components with more than one, and what each shares with its pivot
    sets = rows.filter("n > 0").groupBy("set", "n").agg(F.min("key").alias("key"), F.count("*").alias("copies"))
    root_of = rooted.select(F.col("key").alias("_key"), "root").distinct()
    sets = open_.write(sets.join(root_of, F.col("key") == F.col("_key")).drop("_key"), "sets")
    pivots = sets.groupBy("root").agg(F.count("*").alias("k"), F.max_by(F.struct("set", "n"), F.struct("copies", "set")).alias("p")).filter("k > 1")
    pivots = small_or_shuffled(open_.write(pivots.select(F.col("root").alias("_root"), F.col("p.set").alias("pivot"), F.col("p.n").alias("n_pivot")), "pivots"))
    many = open_.write(sets.join(pivots, F.col("root") == F.col("_root")).drop("_root"), "many")
    known = _Sets(open_, base, sets, clashing)
    shared = known.overlaps(many.filter("set != pivot").select(F.col("pivot").alias("x"), F.col("set").alias("y")), "pivot")
    shared = shared.select(F.col("y").alias("_set"), "overlap")
    own = many.join(shared, F.col("set") == F.col("_set"), "left").withColumn("overlap", F.coalesce("overlap", "n").cast("long"))
    score, need = F.col("overlap") * 9 - F.col("n") * 4, F.col("n_pivot").cast("long") * 9
    placed = open_.write(own.select("set", "key", "n", "copies", "pivot", "overlap", score.alias("score"), need.alias("need")), "placed")

    # sure links, by the values of the score: a row per value, and one per value asked for
    cells = open_.write(placed.groupBy("pivot", "score", "need").agg(F.sum("copies").alias("k")), "cells")
    asked = cells.select("pivot", (F.col("need") - F.col("score")).alias("value"), F.lit(0).cast("long").alias("k"), "score")
    given = cells.select("pivot", F.col("score").alias("value"), "k", F.lit(None).cast("long").alias("score"))
    upto = Window.partitionBy("pivot").orderBy(F.col("value").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    sure = given.unionByName(asked).withColumn("sure", F.sum("k").over(upto)).filter("score is not null")
    sure = sure.select(F.col("pivot").alias("_pivot"), F.col("score").alias("_score"), "sure")
    is_core = F.col("score") * 2 >= F.col("need")
    counted = placed.join(sure, (F.col("pivot") == F.col("_pivot")) & (F.col("score") == F.col("_score")))
    counted = counted.select("set", (F.col("sure") - F.when(is_core, F.col("copies")).otherwise(0)).alias("others"))

    # pairs that the bounds leave open, from index lists of the components that are not all core
    mixed = small_or_shuffled(open_.write(placed.filter(~is_core).select(F.col("pivot").alias("_pivot")).distinct(), "mixed"))
    listed = open_.write(placed.join(mixed, F.col("pivot") == F.col("_pivot"), "left_semi").withColumn("mark", F.when(is_core, F.col("pivot")).otherwise(F.col("set"))), "listed")
    texts = base.join(small_or_shuffled(listed.select(F.col("key").alias("_listed"))), F.col("key") == F.col("_listed"), "left_semi")
    nothing = docs.sparkSession.createDataFrame([], "_key long, _member long, class long")
    live = _live_lists(open_, _postings(texts, nothing, frequent, clashing))
    live = live.join(small_or_shuffled(listed.select(F.col("set").alias("_set"), F.col("mark").alias("root"))), F.col("class") == F.col("_set")).drop("_set")
    maybe = _all_pairs(open_, open_.write(live, "live"), "all")
    facts = [F.col(c) for c in ("set", "pivot", "n", "overlap", "score", "need")]
    x, y = (small_or_shuffled(listed.select(*[c.alias(f"{side}_{name}") for c, name in zip(facts, ("set", "pivot", "n", "o", "score", "need"))])) for side in "xy")
    met = maybe.join(x, F.col("x") == F.col("x_set")).join(y, F.col("y") == F.col("y_set"))
    most = F.least(F.col("x_o") + F.col("y_n") - F.col("y_o"), F.col("y_o") + F.col("x_n") - F.col("x_o"))
    met = met.filter((F.col("x_pivot") == F.col("y_pivot")) & (F.col("x_score") + F.col("y_score") < F.col("x_need")) & links(F.col("x_n"), F.col("y_n"), most))
    compared = known.overlaps(met.select("x", "y"), "met")
    linked = compared.filter(links(F.col("nx"), F.col("ny"), F.col("overlap")))
    both = linked.select(F.col("x").alias("u"), F.col("y").alias("v")).unionByName(linked.select(F.col("y").alias("u"), F.col("x").alias("v")))
    found = both.join(sets.select("set", "copies"), F.col("v") == F.col("set")).groupBy("u").agg(F.sum("copies").alias("others"))

    others = counted.unionByName(found.select(F.col("u").alias("set"), "others")).groupBy(F.col("set").alias("_of")).agg(F.sum("others").alias("others"))
    total = sets.join(others, F.col("set") == F.col("_of"), "left").select(F.col("set").alias("_set"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("_links"))
    total = small_or_shuffled(open_.write(total.filter("_links > 0"), "total"))
    out = rows.join(total, (F.col("set") == F.col("_set")) & (F.col("n") > 0), "left")
    scratch.keep_only("scan")
    open_.keep_only("total")
    return out.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias(id_col), F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"))


def _scanned(
    scratch: Scratch, docs: DataFrame, id_col: str, text_col: str
) -> tuple[DataFrame, DataFrame, tuple[np.ndarray, np.ndarray], frozenset[int]]:
    """(doc, key, text) and (doc, key, n, set, least) of every row, frequent tokens with their counts, and the
    fingerprints that different sets share: of n sets some n^2 / 2^65, none below 10^9."""
    base = docs.select(doc_of(id_col).alias("doc"), row_key(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    scanned = scratch.write(scan(base), "scan")
    rows = scanned.filter("kind = 0")
    # a fifth of all tokens is in index lists, at some 25 bytes
    tokens = rows.agg(F.sum(F.col("n").cast("long"))).first()[0] or 0
    scratch.parts = max(scratch.parts, -(-tokens * 5 // PARTITION_BYTES))
    shared = rows.filter("n > 0").groupBy("print").agg(F.min("check").alias("a"), F.max("check").alias("b")).filter("a < b")
    clashing = frozenset(r["print"] for r in shared.select("print").toLocalIterator())
    mark = F.when(F.col("print").isin(*clashing), F.col("check")).otherwise(F.col("print")) if clashing else F.col("print")
    rows = rows.select("doc", "key", "n", mark.alias("set"), "least")
    top = scanned.filter("kind = 1").groupBy("print").agg(F.sum("n").alias("n")).filter(F.col("n") >= FREQUENT)
    top = top.orderBy(F.col("n").desc(), "print").limit(ORDERED_TOKENS).toArrow()
    token, count = top["print"].to_numpy(), top["n"].to_numpy()
    order = np.argsort(token)
    return base, rows, (token[order].astype(np.int64), count[order].astype(np.int64)), clashing


def _rooted_rows(scratch: Scratch, docs: DataFrame, id_col: str, text_col: str, scanned: tuple | None = None) -> DataFrame:
    """(doc, key, n, root) of every row, a table; rows with n > 0 and one root are a component. `scanned` is what `_scanned` gave of them."""
    base, rows, frequent, clashing = scanned or _scanned(scratch, docs, id_col, text_col)

    # distinct sets, and leaders of sets that share their least token
    sets = scratch.write(rows.filter("n > 0").groupBy("set", "n", "least").agg(F.min("key").alias("key")), "sets")
    known = _Sets(scratch, base, sets, clashing)
    buckets = sets.groupBy("least").agg(F.min("set").alias("leader"), F.count("*").alias("k")).filter("k > 1")
    buckets = small_or_shuffled(scratch.write(buckets.select(F.col("least").alias("_least"), "leader"), "buckets"))
    inside = sets.join(buckets, F.col("least") == F.col("_least")).filter("set != leader")
    compared = known.overlaps(inside.select(F.col("leader").alias("x"), F.col("set").alias("y")), "inside")
    member = compared.filter(links(F.col("nx"), F.col("ny"), F.col("overlap"))).select(
        F.col("y").alias("set"), F.col("x").alias("class"), F.col("ny").alias("n"), "overlap"
    )
    members = scratch.write(member, "members")

    # index lists of all classes
    of_set = small_or_shuffled(members.select(F.col("set").alias("_member"), "class"))
    owned = rows.join(of_set, F.col("set") == F.col("_member")).select(F.col("key").alias("_key"), "_member", "class").distinct()
    owned = scratch.write(owned, "owned")
    live = scratch.write(_live_lists(scratch, _postings(base, owned, frequent, clashing)), "live")

    # leaders against leaders: first few of each list, and in the end all that is not connected yet
    verifier, roots, so_far, heavy = _Verifier(scratch, known), None, 0, _heavy(scratch, live, "live")

    def lists() -> DataFrame:
        if roots is None:
            return live.withColumn("root", F.col("class"))
        of = small_or_shuffled(roots).select(F.col("node").alias("_node"), F.col("root").alias("_root"))
        return live.join(of, F.col("class") == F.col("_node"), "left").withColumn("root", F.coalesce("_root", "class")).drop("_node", "_root")

    for turn, width in enumerate(WIDTHS):
        verifier.verify(_pairs(scratch, lists(), heavy, width, turn))
        count = verifier.links().count()
        if (count - so_far) * 50 <= count:  # few links are left to find; the pairs of all lists find them
            break
        so_far = count
        roots = connected_components(scratch, verifier.links(), f"turn{turn}")
    apart = lists().groupBy("token").agg(F.min("root").alias("_a"), F.max("root").alias("_b"), F.mode("root", True).alias("_most"))
    apart = scratch.write(apart.filter("_a < _b").select(F.col("token").alias("_token"), "_most"), "apart")
    # lists with one largest component have much in common
    open_lists = lists().join(small_or_shuffled(apart), F.col("token") == F.col("_token")).withColumn("least", F.col("_most"))
    verifier.verify(_all_pairs(scratch, open_lists, "rest"))
    leaders, linked = verifier.done, verifier.links()
    roots = connected_components(scratch, linked, "first")
    more = _member_links(scratch, known, leaders, members, roots)
    if more is not None:
        roots = connected_components(scratch, linked.unionByName(more), "second")

    # from sets to documents
    top_of = small_or_shuffled(roots.select(F.col("node").alias("_node"), "root"))
    classed = rows.join(of_set, F.col("set") == F.col("_member"), "left").withColumn("_class", F.coalesce("class", "set"))
    rooted = classed.join(top_of, F.col("_class") == F.col("_node"), "left").select("doc", "key", "n", F.coalesce("root", "_class").alias("root"))
    return scratch.write(rooted, "rooted")


def _all_pairs(scratch: Scratch, lists: DataFrame, name: str) -> DataFrame:
    """Pairs of classes of a list that are not connected and may link, x < y, of lists of any length."""
    entries = scratch.write(lists.select(*names(POSTING), "root", "least"), f"{name}_lists")
    long_ = entries.groupBy("token").agg(F.count("*").alias("_n"), F.max("salt").alias("_salt")).filter((F.col("_n") > LIST_CLASSES) | (F.col("_salt") > 0))
    long_ = scratch.write(long_.select(F.col("token").alias("_token")), f"{name}_long")
    heavy = _heavy(scratch, entries, name)
    if not long_.limit(1).count():
        return _pairs(scratch, entries, heavy, None, 0)
    in_long = F.col("token") == F.col("_token")
    of_long = small_or_shuffled(long_)
    pairs = _pairs(scratch, entries.join(of_long, in_long, "left_anti"), heavy, None, 0)
    return pairs.unionByName(_long_list_pairs(scratch, entries.join(of_long, in_long, "left_semi"), name)).distinct()


def _long_list_pairs(scratch: Scratch, entries: DataFrame, name: str) -> DataFrame:
    """Pairs from lists that no single task should hold.

    A list is cut into blocks of `LIST_CLASSES` entries of like sizes. Blocks whose ranges rule out a
    link, or whose classes are all connected, are skipped as in `_block_pairs`; each other pair of
    blocks goes to a task, so that the work is dealt out however long one list is.
    """
    like = F.floor(F.log(F.col("n_min")) / F.log(F.lit(1.25))).cast("int")
    entries = entries.withColumn("like", like)
    parts = entries.groupBy("token", "like").agg(F.ceil(F.count("*") / LIST_CLASSES).cast("int").alias("_parts"))
    block = F.struct("like", F.pmod(F.xxhash64("class"), F.col("_parts")).cast("int").alias("part")).alias("block")
    cut = scratch.write(entries.join(parts, ["token", "like"]).select("*", block).drop("like", "_parts", "least"), f"{name}_cut")
    ranges = [F.min("n_min").alias("low"), F.max("n_max").alias("high"), F.max("left").alias("left"), F.min("root").alias("root"), F.max("root").alias("top")]
    blocks = scratch.write(cut.groupBy("token", "block").agg(*ranges), f"{name}_blocks")
    a, b = (blocks.select(*[F.col(c).alias(f"{side}_{c}") for c in blocks.columns]) for side in "ab")
    near = (F.col("a_high") * 5 >= F.col("b_low") * 4) & (F.col("b_high") * 5 >= F.col("a_low") * 4)
    near &= F.least("a_left", "b_left") * 9 >= (F.col("a_low") + F.col("b_low")) * 4
    near &= ~((F.col("a_root") == F.col("a_top")) & (F.col("b_root") == F.col("b_top")) & (F.col("a_root") == F.col("b_root")))
    met = a.join(b, (F.col("a_token") == F.col("b_token")) & (F.col("a_block") <= F.col("b_block")) & near)
    unit = F.xxhash64("a_token", "a_block", "b_block").alias("unit")
    sides = F.when(F.col("a_block") == F.col("b_block"), F.array("a_block")).otherwise(F.array("a_block", "b_block"))
    units = met.select(F.col("a_token").alias("token"), unit, F.explode(sides).alias("block"))
    units = scratch.write(units, f"{name}_units")

    def run(batches: Iterator[dict[str, np.ndarray]]) -> Iterator[Columns]:
        sent = _Sent()
        for a in _whole_lists(batches, "unit"):
            order = np.lexsort((a["n_min"], a["token"], a["unit"]))
            a = {k: v[order] for k, v in a.items()}
            for i, j in _block_pairs(a, _starts(a, "unit", "token")):
                yield sent.new(a, i, j)

    laid = cut.join(units, ["token", "block"]).select("unit", *names(POSTING), "root")
    laid = laid.repartition(scratch.parts, "unit").sortWithinPartitions("unit")
    return map_columns(laid, run, "x long, y long", arrays=True).distinct()


def _member_links(scratch: Scratch, known: _Sets, leaders: DataFrame, members: DataFrame, roots: DataFrame) -> DataFrame | None:
    """Links between classes whose leaders do not link and that nothing else connects; None if no pair is open.

    A member x of class c has at most |x - c| tokens beyond c, so members x, y of classes c, d share at
    most overlap(c, d) + |x - c| + |y - d|. Where that allows a link, members meet the other leader,
    and then each other within the bounds that those overlaps give.
    """
    extra = members.select("class", "n", (F.col("n") - F.col("overlap")).alias("beyond"))
    ranges = extra.groupBy("class").agg(F.min("n").alias("n_least"), F.max("beyond").alias("most_beyond"))
    ranges = small_or_shuffled(scratch.write(ranges, "ranges"))
    root_of = small_or_shuffled(roots)

    def side(df: DataFrame, key: str, n: str) -> DataFrame:
        r = ranges.select(F.col("class").alias("_c"), F.col("n_least").alias("_least"), F.col("most_beyond").alias("_beyond"))
        t = root_of.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
        df = df.join(r, F.col(key) == F.col("_c"), "left").join(t, F.col(key) == F.col("_n"), "left")
        return df.select(
            *[c for c in df.columns if not c.startswith("_")], F.least(F.col(n), F.col("_least")).alias(f"{key}_least"),
            F.coalesce("_beyond", F.lit(0)).alias(f"{key}_beyond"), F.coalesce("_r", F.col(key)).alias(f"{key}_root"), F.col("_c").isNotNull().alias(f"{key}_many"),
        )

    apart = leaders.filter(~links(F.col("nx"), F.col("ny"), F.col("overlap")))
    open_ = side(side(apart, "x", "nx"), "y", "ny")
    reach = links(F.col("x_least"), F.col("y_least"), F.col("overlap") + F.col("x_beyond") + F.col("y_beyond"))
    open_ = open_.filter((F.col("x_many") | F.col("y_many")) & (F.col("x_root") != F.col("y_root")) & reach)
    open_ = scratch.write(open_.select("x", "y", "overlap"), "open")
    if not open_.limit(1).count():
        return None
    own = members.select("class", "set", "n", "overlap")
    touched = open_.select(F.col("x").alias("class")).unionByName(open_.select(F.col("y").alias("class"))).distinct()
    leads = known.sets.join(touched, F.col("set") == F.col("class"), "left_semi").select(F.col("set").alias("class"), "set", "n", F.col("n").alias("overlap"))
    people = own.join(touched, "class", "left_semi").unionByName(leads).withColumn("beyond", F.col("n") - F.col("overlap"))
    people = scratch.write(people, "people")

    # every member against the other leader
    mine = people.select(F.col("class").alias("_class"), "set", F.col("n").alias("n_set"), "beyond")
    turned = open_.select("x", "y", "overlap").unionByName(open_.select(F.col("y").alias("x"), F.col("x").alias("y"), "overlap"))
    cross = turned.join(mine, F.col("x") == F.col("_class")).select(F.col("x").alias("cx"), F.col("y").alias("cy"), "set", "n_set", "beyond")
    cross = scratch.write(cross, "cross")
    seen = known.overlaps(cross.select(F.col("cy").alias("x"), F.col("set").alias("y")).filter("x != y").distinct(), "cross")
    seen = scratch.write(seen.select(F.col("x").alias("cy"), F.col("y").alias("set"), F.col("nx").alias("n_cy"), F.col("overlap").alias("shared")), "seen")
    cross = scratch.write(cross.join(seen, ["cy", "set"]), "cross_seen")
    hit = cross.filter(links(F.col("n_cy"), F.col("n_set"), F.col("shared"))).select(F.col("cx").alias("u"), F.col("cy").alias("v")).distinct()
    hit = scratch.write(hit, "hit")

    # members against members, within the bounds
    a = cross.select(F.col("cx").alias("p"), F.col("cy").alias("q"), F.col("set").alias("x"), F.col("n_set").alias("nx"), F.col("beyond").alias("bx"), F.col("shared").alias("sx"))
    b = cross.select(F.col("cy").alias("p"), F.col("cx").alias("q"), F.col("set").alias("y"), F.col("n_set").alias("ny"), F.col("beyond").alias("by"), F.col("shared").alias("sy"))
    done = hit.unionByName(hit.select(F.col("v").alias("u"), F.col("u").alias("v")))
    a = a.filter("p < q").join(done.select(F.col("u").alias("p"), F.col("v").alias("q")).distinct(), ["p", "q"], "left_anti")
    bound = F.least(F.col("sx") + F.col("by"), F.col("sy") + F.col("bx"), F.col("nx"), F.col("ny"))
    pairs = a.join(b, ["p", "q"]).filter(links(F.col("nx"), F.col("ny"), bound)).select("p", "q", "x", "y")
    pairs = scratch.write(pairs, "member_pairs")
    met = known.overlaps(pairs.select("x", "y").distinct(), "late").filter(links(F.col("nx"), F.col("ny"), F.col("overlap")))
    late = pairs.join(met.select("x", "y"), ["x", "y"], "left_semi").select(F.col("p").alias("u"), F.col("q").alias("v")).distinct()
    return hit.unionByName(late)
