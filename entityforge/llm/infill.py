"""Fill-in-the-middle rearrangement by a parallel automaton scan.

The automaton reads UTF-8 bytes and knows whether it is inside a run of letters, and how much of a mark it
has seen. A block of bytes, read without knowing what comes before it, gives a function from the state before
it to the state after it, and per state before it the numbers of tokens and marks that start in it. Two
neighbours compose to the same for both, so blocks are reduced as a tree, pieces of a long text in different
tasks, and the tree is then descended from its root to the byte at which a token starts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityforge.llm.columns import Columns, let, map_columns, text_udf
from entityforge.llm.scratch import Scratch, small_or_shuffled

#: The marks of the three parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of a block (a power of two), of what is scanned at a time, and of a text that one task scans by itself.
BLOCK, AT_A_TIME, PIECE = 1024, 1 << 21, 1 << 20
#: States: outside letters, inside letters, after "<", and after "<" and a letter of a mark (so inside letters too).
OUT, IN, OPEN, NAMED = range(4)
STATES = 4


def _tables() -> tuple[np.ndarray, ...]:
    """By byte: next state of each state, tokens and marks that start or end in each, and characters. 0xFF, no byte of UTF-8, fills up."""
    step, token, mark = (np.zeros((256, STATES), dtype=np.uint8) for _ in range(3))
    letters = [*range(65, 91), *range(97, 123)]
    token[:128] = 1
    token[0xC0:0xFF] = 1
    for b in letters:
        step[b] = IN
        token[b] = [1, 0, 1, 0]
    for b in b"PSM":
        step[b, OPEN] = NAMED
    step[ord("<")] = OPEN
    mark[ord(">"), NAMED] = 1
    step[0xFF] = range(STATES)
    chars = np.ones(256, dtype=np.uint8)
    chars[0x80:0xC0] = chars[0xFF] = 0
    return step, token, mark, chars


STEP, TOKEN, MARK, CHARS = _tables()


class Tree:
    """The reduction of some texts' bytes, each text in blocks of its own."""

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        blocks = -(-sizes // BLOCK)
        self.first = np.concatenate([[0], np.cumsum(blocks)])
        laid = np.full(self.first[-1] * BLOCK, 0xFF, dtype=np.uint8)
        for at, text in zip(self.first, texts):
            laid[at * BLOCK : at * BLOCK + len(text)] = np.frombuffer(text, dtype=np.uint8)
        # levels[0] has a row per byte, the last one a row per block
        self.levels = [(STEP[laid], TOKEN[laid], CHARS[laid])]
        marks = MARK[laid]
        while len(self.levels) <= BLOCK.bit_length() - 1:
            step, token, chars = self.levels[-1]
            at = step[0::2] + np.arange(1, len(step), 2, dtype=np.int64)[:, None] * STATES
            both = token[0::2].astype(np.uint16) + token.ravel()[at]
            marks = marks[0::2].astype(np.uint16) + marks.ravel()[at]
            self.levels.append((step.ravel()[at], both, chars[0::2].astype(np.uint16) + chars[1::2]))
        self.marks = marks

    def whole(self, text: int) -> tuple[list[int], list[int], list[int], int]:
        """Of a text: state after it, tokens and marks per state before it, and its characters."""
        step, token, chars = self.levels[-1]
        state, tokens, marks, n = list(range(STATES)), [0] * STATES, [0] * STATES, 0
        for b in range(self.first[text], self.first[text + 1]):
            to, more, met = step[b].tolist(), token[b].tolist(), self.marks[b].tolist()
            for s in range(STATES):
                tokens[s], marks[s] = tokens[s] + more[state[s]], marks[s] + met[state[s]]
            state, n = [to[s] for s in state], n + int(chars[b])
        return state, tokens, marks, n

    def starts(self, wanted: list[tuple[int, int, int]]) -> list[int]:
        """For each (text, state before it, k): characters before the token with k tokens before it; all of them if there is none."""
        before, places, ends = [], [], {}
        step, token, chars = self.levels[-1]
        for w, (text, state, k) in enumerate(wanted):
            n = 0
            for b in range(self.first[text], self.first[text + 1]):
                here = int(token[b, state])
                if k < here:
                    places.append((w, b, state, k))
                    break
                k, n, state = k - here, n + int(chars[b]), int(step[b, state])
            before.append(n)
        if not places:
            return before
        which, node, state, left = (np.array(x, dtype=np.int64) for x in zip(*places))
        extra = np.zeros(len(which), dtype=np.int64)
        for step, token, chars in reversed(self.levels[:-1]):
            node = node * 2
            here = token[node, state].astype(np.int64)
            over = left >= here
            extra += np.where(over, chars[node], 0)
            left = np.where(over, left - here, left)
            state = np.where(over, step[node, state], state)
            node = node + over
        for w, n in zip(which.tolist(), extra.tolist()):
            before[w] += n
        return before


def _portions(texts: list[bytes]) -> Iterator[list[int]]:
    """Places of consecutive texts that are scanned together."""
    some, size = [], 0
    for i, t in enumerate(texts):
        if some and size + len(t) > AT_A_TIME:
            yield some
            some, size = [], 0
        some.append(i)
        size += len(t) + BLOCK
    if some:
        yield some


def _spots(n: int, draws: list[int]) -> list[int]:
    """The two cuts, in tokens."""
    return sorted(d % (n + 1) for d in draws)


def _cut_whole(rows: list) -> list[tuple]:
    """(tokens, marks, characters before both cuts) of texts that a task scans by itself; null stays null."""
    out: list = [(None, None, None, None)] * len(rows)
    known = [(i, r["text"].encode("utf-8", "replace"), [r["h1"], r["h2"]]) for i, r in enumerate(rows) if r["text"] is not None]
    texts = [t for _, t, _ in known]
    for some in _portions(texts):
        tree = Tree([texts[i] for i in some])
        sums = [tree.whole(k) for k in range(len(some))]
        at = tree.starts([(k, OUT, spot) for k, i in enumerate(some) for spot in _spots(sums[k][1][OUT], known[i][2])])
        for k, i in enumerate(some):
            out[known[i][0]] = (sums[k][1][OUT], sums[k][2][OUT], at[2 * k], at[2 * k + 1])
    return out


def _draws(id_: Column, seed: int) -> list[Column]:
    """Four numbers of 32 bits that the id and the seed decide."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


SUMMARY = "id string, k1 long, k2 long, piece int, h1 long, h2 long, state array<int>, tokens array<long>, marks array<long>, chars long"
CUT = "id string, k1 long, k2 long, n long, n_marks long, cut int, piece int, state int, left long, before long"
PLACE = "id string, k1 long, k2 long, n long, n_marks long, cut int, at long"
LONG_KEY = ["id", "k1", "k2"]


def _summaries(parts: Iterator[Columns]) -> Iterator[Columns]:
    """Each piece's function and counts."""
    for rows in parts:
        sums: list = []
        for some in _portions(rows["bytes"]):
            tree = Tree([rows["bytes"][i] for i in some])
            sums += [tree.whole(k) for k in range(len(some))]
        yield {c: rows[c] for c in ("id", "k1", "k2", "piece", "h1", "h2")} | {c: [s[i] for s in sums] for i, c in enumerate(("state", "tokens", "marks", "chars"))}


def _entries(parts: Iterator[Columns]) -> Iterator[Columns]:
    """Of each text's summaries, in order: the piece in which each cut is, and the state and counts before that piece."""
    for rows in parts:
        out: dict[str, list] = {c.split()[0]: [] for c in CUT.split(", ")}
        for i, pieces in enumerate(rows["pieces"]):
            state, before, entered = OUT, [0, 0, 0], []
            for p in pieces:
                entered.append((p["piece"], state, *before))
                before = [before[0] + p["tokens"][state], before[1] + p["marks"][state], before[2] + p["chars"]]
                state = p["state"][state]
            for cut, spot in enumerate(_spots(before[0], [rows["h1"][i], rows["h2"][i]])):
                # the last piece that no more than `spot` tokens precede
                piece, at, tokens, _, chars = next(e for e in reversed(entered) if e[2] <= spot)
                found = (rows["id"][i], rows["k1"][i], rows["k2"][i], before[0], before[1], cut, piece, at, spot - tokens, chars)
                for column, value in zip(out.values(), found):
                    column.append(value)
        yield out


def _within(parts: Iterator[Columns]) -> Iterator[Columns]:
    """The place of each cut in its piece."""
    for rows in parts:
        at = []
        for some in _portions(rows["bytes"]):
            tree = Tree([rows["bytes"][i] for i in some])
            at += tree.starts([(k, rows["state"][i], rows["left"][i]) for k, i in enumerate(some)])
        yield {c: rows[c] for c in ("id", "k1", "k2", "n", "n_marks", "cut")} | {"at": [b + a for b, a in zip(rows["before"], at)]}


def _long_cuts(scratch: Scratch, long: DataFrame) -> DataFrame:
    """Cuts of long texts (id, k1, k2, h1, h2, text), whose pieces different tasks scan."""
    count = F.ceil(F.octet_length("text") / PIECE).cast("int")
    slices = let(F.encode("text", "UTF-8"), lambda b: F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.substring(b, k * PIECE + 1, F.lit(PIECE))))
    pieces = long.select(*LONG_KEY, "h1", "h2", F.posexplode(slices).alias("piece", "bytes"))
    pieces = scratch.write(pieces.repartition(scratch.parts, *LONG_KEY, "piece").dropDuplicates([*LONG_KEY, "piece"]), "pieces")
    sums = scratch.write(map_columns(pieces, _summaries, SUMMARY), "summaries")
    # a text's summaries: a few numbers for each piece of a row that is itself in one task's memory
    texts = sums.groupBy(*LONG_KEY, "h1", "h2").agg(F.sort_array(F.collect_list(F.struct("piece", "state", "tokens", "marks", "chars"))).alias("pieces"))
    cuts = scratch.write(map_columns(texts, _entries, CUT), "entries")
    inside = pieces.select(*LONG_KEY, "piece", "bytes").join(small_or_shuffled(cuts), [*LONG_KEY, "piece"])
    at = map_columns(inside, _within, PLACE)
    pick = lambda cut: F.max(F.when(F.col("cut") == cut, F.col("at")))
    found = at.groupBy(LONG_KEY).agg(F.max("n").alias("n"), F.max("n_marks").alias("n_marks"), pick(0).alias("first"), pick(1).alias("second"))
    found = scratch.write(found, "places")
    scratch.keep_only("places")
    return found


def rearrange(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """Every text cut at two token borders, which its id decides, and put together again with marks.

    Tokens are runs of A-Z and a-z, and every other character. A text stays plain if it is empty or null, holds a
    mark of its own, or its draw is `plain_from` or more of 100; of the others, a draw under `spm_below` of 100
    puts the suffix first. Texts are whole, however long: beyond PIECE bytes, pieces of them are scanned apart.
    Equal rows give equal rows; a null id draws as an empty one. An empty table gives no rows. Other columns,
    whatever their names, are not read.

    Returns id_col, n long (tokens), form string, prefix_chars, middle_chars long (null if plain), output string.
    """
    own = [F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2")]
    rows = docs.select(F.col(id_col).alias("own_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("own_id", F.coalesce(F.col("own_id").cast("string"), F.lit("")).alias("id"), "text", *_draws(F.col("own_id"), seed))
    scan = text_udf(lambda: _cut_whole, "n long, n_marks long, first long, second long")
    short = rows.filter(F.octet_length("text") <= PIECE).withColumn("at", scan(F.struct("text", "h1", "h2")))
    far = rows.filter(F.octet_length("text") > PIECE).withColumns({c: k for c, k in zip(("k1", "k2"), own)})
    places = _long_cuts(Scratch(docs.sparkSession, "infill"), far.select(*LONG_KEY, "h1", "h2", "text"))
    met = far.join(small_or_shuffled(places), LONG_KEY).withColumn("at", F.struct("n", "n_marks", "first", "second"))
    kept = ["own_id", "text", "h3", "h4", "at.*"]
    cut = short.select(kept).unionByName(met.select(kept))
    first, second = F.col("first").cast("int"), F.col("second").cast("int")
    prefix, middle, suffix = F.substring("text", F.lit(1), first), F.substring("text", first + 1, second - first), F.substring("text", second + 1, F.length("text"))
    plain = (F.col("text") == "") | (F.col("n_marks") > 0) | (F.col("h3") % 100 >= plain_from)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_below, "spm").otherwise("psm")
    psm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    spm = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    cut = cut.withColumn("form", form)
    output = F.when(F.col("form") == "plain", F.col("text")).when(F.col("form") == "psm", psm).otherwise(spm)
    only = lambda c: F.when(F.col("form") != "plain", c)
    return cut.select(
        F.col("own_id").alias(id_col), "n", "form", only(F.col("first")).alias("prefix_chars"), only(F.col("second") - F.col("first")).alias("middle_chars"), output.alias("output")
    )


def restored(form: Column, output: Column) -> Column:
    """The text that an output was made of. A part can hold the start of a mark, but no mark: each ends before a "<" or with the output."""
    parts = lambda *order: let(F.split(output, "<[PSM]>", -1), lambda p: F.concat(*[F.get(p, F.lit(k)) for k in order]))
    return F.when(form == "plain", output).when(form == "psm", parts(1, 3, 2)).otherwise(parts(2, 3, 1))
