"""Benchmark decontamination by winnowed fingerprints. Built-in functions only.

Words are hashed, four words in a row make a gram, and of the seven grams of a window of ten words the
least hash is its fingerprint. Equal windows have equal fingerprints, so every span of ten words or more
that a text shares with an item is met when the distinct fingerprints of both sides are joined; a text has
about one fingerprint in four words. Only texts that meet one are looked at again: there each window under
a fingerprint that was met is extended to its ten words and compared. An item of fewer words than a window
is one window, and its own hash is the fingerprint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityforge.llm.columns import let, nested
from entityforge.llm.scratch import Scratch, small_or_shuffled

#: What is between words: ASCII other than digits and, after lower-casing, letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a window, and of a gram; the others of a window's grams are what its least is taken over.
SPAN, GRAM = 10, 4
#: Words of a text whose hits one task puts together.
STRETCH = 1 << 16
TEXT_KEY = ["k1", "k2"]
WINDOW = ["length", "print", "hash"]
CLASS = ["c1", "c2", "c3"]


def _over(values: Column, have: int, want: int, combine: Callable[[Column, Column], Column]) -> Column:
    """Values over `have` neighbours made values over `want`, at each place, by doubling; the last places are not whole."""
    if have == want:
        return values
    step = min(have, want - have)
    wider = let(values, lambda v: F.zip_with(v, F.slice(v, step + 1, F.greatest(F.size(v) - step, F.lit(0))), combine))
    return _over(wider, have + step, want, combine)


def _mixed(values: Column, have: int, want: int) -> Column:
    return _over(values, have, want, lambda a, b: F.xxhash64(a, b))


def _whole(values: Column, hashes: Column, length: int) -> Column:
    """Only the places at which `length` words follow."""
    return F.slice(values, 1, F.greatest(F.size(hashes) - (length - 1), F.lit(0)))


def words_of(text: Column) -> Column:
    """Words of a text whose A-Z are lower-cased; null has none."""
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # all matches at once: extracting them one by one copies the text for each
    return F.array_remove(F.split(low, BETWEEN, -1), "")


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _grams(hashes: Column, length: int) -> Column:
    return _mixed(hashes, 1, GRAM if length == SPAN else length)


def _least(grams: Column, length: int) -> Column:
    """Of grams, the fingerprint of the window at each place."""
    return _over(grams, 1, SPAN - GRAM + 1, lambda a, b: F.least(a, b)) if length == SPAN else grams


def prints_of(words: Column, lengths: list[int]) -> Column:
    """The distinct fingerprints of a text's windows of each of `lengths`."""
    return let(_hashes(words), lambda h: F.array_distinct(F.concat(*[_whole(_least(_grams(h, n), n), h, n) for n in lengths], F.array().cast("array<bigint>"))))


def _windows(hashes: Column, length: int) -> Column:
    """All windows of `length` words: place, length, fingerprint and hash of all words."""

    def both(grams: Column) -> Column:
        whole = _mixed(grams, GRAM, SPAN) if length == SPAN else grams
        return let(whole, lambda all_: F.transform(_whole(_least(grams, length), hashes, length), lambda p, i: F.struct(i.alias("start"), F.lit(length).alias("length"), p.alias("print"), F.get(all_, i).alias("hash"))))

    return let(_grams(hashes, length), both)


def _key_of(text: Column) -> list[Column]:
    """128 bits of a text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def _index(scratch: Scratch, benchmark: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, list[int]]:
    """The distinct windows of all items with their class, the items of each class, and the lengths of windows.

    A class is what windows have in common that occur in the same items, so that a passage of many items
    is one class and no document meets its items once per window.
    """
    item = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    hashed = benchmark.select(item.alias("item"), _hashes(words_of(F.col(text_col))).alias("h")).filter("size(h) > 0")
    own = F.when(F.size("h") >= SPAN, _windows(F.col("h"), SPAN))
    for n in range(1, SPAN):
        own = own.when(F.size("h") == n, _windows(F.col("h"), n))
    windows = scratch.write(hashed.select("item", F.explode(own).alias("w")).select("item", *[f"w.{c}" for c in WINDOW]).distinct(), "windows")
    classed = windows.groupBy(WINDOW).agg(
        F.count("*").alias("c1"), F.bit_xor(F.xxhash64("item")).alias("c2"), F.bit_xor(F.xxhash64(F.lit(1), "item")).alias("c3")
    )
    classed = scratch.write(classed, "classed")
    first = classed.groupBy(CLASS).agg(F.min(F.struct(*WINDOW)).alias("w")).select(*CLASS, *[F.col(f"w.{c}") for c in WINDOW])
    members = scratch.write(first.join(windows, WINDOW).select(*CLASS, "item"), "members")
    # at most SPAN rows
    lengths = sorted(r[0] for r in classed.select("length").distinct().collect())
    return classed, members, lengths


def _hit_words(hits: DataFrame) -> DataFrame:
    """Words under any window, per text: stretches of a text are measured apart, so that no text is one task's."""
    last = F.col("start") + F.col("length") - 1
    cut = hits.select(*TEXT_KEY, "start", "length", F.explode(F.sequence(F.floor(F.col("start") / STRETCH), F.floor(last / STRETCH))).alias("stretch"))
    spans = cut.select(
        *TEXT_KEY, "stretch", F.greatest("start", F.col("stretch") * STRETCH).alias("lo"), F.least(F.col("start") + F.col("length"), (F.col("stretch") + 1) * STRETCH).alias("hi")
    )
    before = Window.partitionBy(*TEXT_KEY, "stretch").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.col("hi") - F.greatest("lo", F.coalesce(F.max("hi").over(before), F.lit(0))), F.lit(0))
    return spans.select(*TEXT_KEY, fresh.alias("fresh")).groupBy(TEXT_KEY).agg(F.sum("fresh").alias("n_hit"))


def _found(scratch: Scratch, rows: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str) -> tuple[DataFrame, DataFrame]:
    """Of `rows` (id, text): id, key and number of words of each; and hits and items of each distinct text that has any."""
    classed, members, lengths = _index(scratch, benchmark, item_col, item_text_col)
    seen = let(words_of(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), prints_of(w, lengths).alias("prints")))
    slim = rows.select("id", *_key_of(F.col("text")), seen.alias("seen")).select("id", *TEXT_KEY, "seen.n_words", "seen.prints")
    slim = scratch.write(slim, "slim")
    prints = scratch.write(classed.select("print").distinct(), "prints")
    met = slim.select(*TEXT_KEY, F.explode("prints").alias("print")).join(small_or_shuffled(prints), "print", "left_semi").select(TEXT_KEY).distinct()
    met = scratch.write(met, "met")
    again = rows.select(*_key_of(F.col("text")), "text").join(small_or_shuffled(met), TEXT_KEY, "left_semi")
    # without any window, lengths are empty and so is `met`
    windows = let(_hashes(words_of(F.col("text"))), lambda h: F.concat(*[_windows(h, n) for n in lengths or [SPAN]]))
    under = again.select(*TEXT_KEY, F.explode(windows).alias("w")).select(*TEXT_KEY, "w.*")
    # copies of a text add up before they are shuffled
    hits = under.join(small_or_shuffled(classed), WINDOW).groupBy(*TEXT_KEY, "start", "length").agg(*[F.max(c).alias(c) for c in CLASS])
    hits = scratch.write(hits, "hits")
    items = hits.select(*TEXT_KEY, *CLASS).distinct().join(small_or_shuffled(members), CLASS).select(*TEXT_KEY, "item").distinct()
    items = items.groupBy(TEXT_KEY).agg(F.sort_array(F.collect_list("item")).alias("items"))
    found = scratch.write(_hit_words(hits).join(items, TEXT_KEY), "found")
    scratch.keep_only("slim", "found")
    return slim.drop("prints"), found


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """For every row of `docs`: its id, its number of words, of words inside any occurrence of an item's window, and those items.

    A null or empty text, or one without words, has 0 words and no items; such an item has no windows. Items
    that share an id are one item with the windows of all of them; a null id is an item written as ''. Rows that
    repeat are each answered. Texts are whole, however long. Empty tables give no rows, or rows without hits.
    Other columns, whatever their names, are not read.

    No text is shuffled unless more than `scratch.SMALL_ROWS` texts meet a fingerprint; the table of the first
    scan has some 2 bytes per word. A row's list of items is as long as the items that the row holds.

    Returns id_col, n_words long, n_hit long, items array<string> (sorted as strings).
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    slim, found = _found(Scratch(docs.sparkSession, "decontaminate"), rows, benchmark, item_col, item_text_col)
    none = F.array().cast("array<string>")
    out = slim.join(small_or_shuffled(found), TEXT_KEY, "left")
    return out.select(F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items"))


def clean_rows(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all of their columns, whose texts hold no window of any item; odd input as in `contamination`."""
    rows = docs.select(F.lit(None).cast("string").alias("id"), F.col(text_col).alias("text"))
    scratch = Scratch(docs.sparkSession, "decontaminate")
    _, found = _found(scratch, rows, benchmark, item_col, item_text_col)
    scratch.keep_only("found")
    keyed = nested(docs).select("row", *_key_of(F.col(f"row.`{text_col}`")))
    return keyed.join(small_or_shuffled(found.select(TEXT_KEY)), TEXT_KEY, "left_anti").select("row.*")
