"""Mixing sources to target weights by pivotal dependent rounding. Built-in functions only.

Every row starts with the expected copies of its source, target / size. Its whole part is fixed;
the fraction is rounded by pivotal steps: two rows with fractions exchange mass, weighted by size,
in a random direction whose odds keep both expectations, until one of them is 0 or 1. Rows are
folded in chunks of `FANOUT` by global rank; the one fraction that a chunk leaves goes up to the
chunk of chunks, and so on. Size-weighted mass is kept at every step, so that a source ends within
one row of its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityforge.llm.columns import nested
from entityforge.llm.ranking import ordered_table, with_prefix
from entityforge.llm.scratch import Scratch, small_or_shuffled

#: Rows of one pivotal fold; the depth of the reduction tree is its logarithm of the row count.
FANOUT = 128
#: Fractions nearer than this to 0 or 1 are whole.
EPSILON = 1e-9
#: Words as `[^\x20\x09-\x0D]+` counts them.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than space and U+0009 to U+000D; null gives 0.

    Every run of other characters shrinks to one letter, so that the length of what is left of the
    blank-free string is the count; no array of words is built.
    """
    shrunk = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.translate(shrunk, BLANKS, "")).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """Targets per source from a table (source, source_size), one row per source.

    Sources in code-point order, null last, weigh `weights` in turn and share the total; a target
    stops at `cap` times its source's size and the excess is shared again by weight. The fixed point
    of that is a water level: with sources by rising size per weight, a source is full when its cap
    lies below its share of what the sources before it left. Both orders are global ranks, so that
    sources may be as many as hosts.
    """
    scratch = Scratch(sizes.sparkSession, "targets")
    named = sizes.select("source", "source_size", F.col("source").isNull().alias("unnamed"))
    numbered = with_prefix(ordered_table(scratch, named, ["unnamed", "source"], "names"), {"n": F.lit(1)})
    turn = F.expr("element_at(array({}), cast(n % {} as int) + 1)".format(", ".join(f"{w}L" for w in weights), len(weights)))
    weighed = numbered.select("source", "source_size", "n", turn.alias("w")).withColumn("each", F.col("source_size") / F.col("w"))
    levels = with_prefix(ordered_table(scratch, weighed, ["each", "n"], "levels"), {"before": F.col("source_size"), "closed": F.col("w")})
    left, open_ = F.col("before_all") - cap * F.col("before"), F.col("closed_all") - F.col("closed")
    levels = levels.withColumns({"left": left, "open": open_}).withColumn("full", F.col("source_size") * cap * F.col("open") <= F.col("w") * F.col("left"))
    level = levels.filter("not full").agg(F.max(F.col("left") / F.col("open"))).first()[0]
    share = F.col("w") * F.lit(level).cast("double")
    return levels.select("source", "source_size", F.when(F.col("full"), (F.col("source_size") * cap).cast("double")).otherwise(share).alias("target"))


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on `parts` alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / float(1 << 53)


def _let(value: Column, body) -> Column:
    """`body(value)`, with `value` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _step(state: Column, item: Column, seed: int) -> Column:
    """One pivotal step between the open fraction of `state`, if any, and `item`."""

    def whole(p: Column) -> Column:
        return F.when(p < EPSILON, 0.0).when(p > 1 - EPSILON, 1.0).otherwise(p)

    def is_open(x: Column) -> Column:
        return (x["p"] > 0.0) & (x["p"] < 1.0)

    def with_limits(v: Column) -> Column:
        i, j = v["i"], v["j"]
        up = F.least(1 - i["p"], j["p"] * j["w"] / i["w"])
        down = F.least(i["p"], (1 - j["p"]) * j["w"] / i["w"])
        return F.struct(i.alias("i"), j.alias("j"), up.alias("up"), down.alias("down"))

    def moved(v: Column) -> Column:
        i, j = v["i"], v["j"]
        rises = _uniform(F.lit(seed), i["rank"], j["rank"]) * (v["up"] + v["down"]) < v["down"]
        return F.struct(i.alias("i"), j.alias("j"), F.when(rises, v["up"]).otherwise(-v["down"]).alias("d"))

    def settled(v: Column) -> Column:
        i, j = v["i"], v["j"]
        return F.struct(i.withField("p", whole(i["p"] + v["d"])).alias("i"), j.withField("p", whole(j["p"] - v["d"] * i["w"] / j["w"])).alias("j"))

    def sorted_out(v: Column) -> Column:
        both = F.array(v["i"], v["j"])
        return F.struct(
            F.concat(state["done"], F.filter(both, lambda x: ~is_open(x))).alias("done"), F.filter(both, is_open).alias("open")
        )

    pair = F.struct(F.get(state["open"], F.lit(0)).alias("i"), item.alias("j"))
    stepped = _let(_let(_let(_let(pair, with_limits), moved), settled), sorted_out)
    first = F.struct(state["done"].alias("done"), F.array(item).alias("open"))
    return F.when(F.size(state["open"]) == 0, first).otherwise(stepped)


ITEM = "struct<rank:bigint,p:double,w:double,doc_id:bigint,print:bigint,size:bigint>"


def _fold(rows: DataFrame, seed: int) -> DataFrame:
    """Folds each (source, chunk) to its settled rows and the fraction that stays open, if any."""
    nothing = F.lit(None).cast(f"array<{ITEM}>")
    empty = F.coalesce(nothing, F.array().cast(f"array<{ITEM}>"))
    start = F.struct(empty.alias("done"), empty.alias("open"))
    listed = rows.groupBy("source", "chunk").agg(F.array_sort(F.collect_list("item")).alias("items"))
    return listed.select("source", "chunk", F.aggregate("items", start, lambda s, x: _step(s, x, seed)).alias("state"))


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    cap: int = 3,
    seed: int = 11,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """Copies of every row so that each source's words come to its target, in expectation exactly.

    Returns one row per input row: doc_id, source, print (hash of the text), size (words; a null
    text has none), source_size, target, copies. `copies` is the whole part of target / source_size
    or one more, so never over `cap`; rows without words get the whole part. A null source is a
    source of its own. Draws depend on the seed and on the row's place in the order of (source,
    hash of id, id, text hash), so reruns agree whatever the partitioning; rows that agree in all of
    these are interchangeable. Empty input gives no rows; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    text = F.col(text_col).cast("string")
    sized = docs.select(
        F.col(source_col).cast("string").alias("source"),
        F.xxhash64(F.lit(seed), F.col(id_col)).alias("_h"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text).alias("print"),
        word_count(text).alias("size"),
    )
    table = ordered_table(scratch, sized, ["source", "_h", "doc_id", "print", "size"], "sized")
    per_source = table.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = scratch.write(source_targets(per_source, weights, cap), "targets")
    n_rows = table.count()
    # a row per source; beyond the checked size the join shuffles, and skewed sources are split by AQE
    small = small_or_shuffled(targets)

    def joined(rows: DataFrame) -> DataFrame:
        other = small.withColumnRenamed("source", "_source")
        ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
        base = F.floor(ratio + EPSILON)
        found = rows.join(other, rows["source"].eqNullSafe(other["_source"])).drop("_source")
        return found.withColumn("base", base).withColumn("fraction", F.when(ratio - base > EPSILON, ratio - base).otherwise(0.0))

    ranked = joined(with_prefix(table, {"rank": F.lit(1)}))
    splits = (F.col("fraction") > 0) & (F.col("size") > 0)
    item = F.struct("rank", F.col("fraction").alias("p"), F.col("size").cast("double").alias("w"), "doc_id", "print", "size").cast(ITEM)
    level = ranked.filter(splits).select("source", F.expr(f"rank div {FANOUT}").alias("chunk"), item.alias("item"))
    parts = [joined(table.select("source", "doc_id", "print", "size")).filter(~splits).withColumn("copies", F.col("base"))]
    span, depth = max(n_rows, 1), 0
    while True:
        span = -(-span // FANOUT)
        folded = scratch.write(_fold(level, seed + depth), f"level{depth}")
        done = folded.select("source", F.explode("state.done").alias("item"))
        still = folded.select("source", "chunk", F.explode("state.open").alias("item"))
        parts.append(_rounded(joined(done.select("source", "item.*")), F.col("p")))
        if span <= 1:
            coin = (_uniform(F.lit(seed - 1), F.col("rank")) < F.col("p")).cast("double")
            parts.append(_rounded(joined(still.select("source", "item.*")), coin))
            break
        level = still.select("source", F.expr(f"chunk div {FANOUT}").alias("chunk"), "item")
        depth += 1
    out = ["doc_id", "source", "print", "size", "source_size", "target", F.col("copies").cast("long").alias("copies")]
    whole = parts[0].select(*out)
    for part in parts[1:]:
        whole = whole.unionByName(part.select(*out))
    return whole


def _rounded(rows: DataFrame, up: Column) -> DataFrame:
    return rows.withColumn("copies", F.col("base") + F.when(up > 0.5, 1).otherwise(0))


def repeat_rows(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of `docs`, each as often as `mixed` (of the same `docs`) says.

    Rows that agree in id, source and text have two counts of copies at most, which differ by one;
    those first in the order of their other columns get the larger, so reruns agree. Null ids,
    sources and texts meet their like. Any other columns are kept as they are, whatever their names.
    """
    per_key = mixed.groupBy(F.col("doc_id").alias("k_id"), F.col("source").alias("k_source"), F.col("print").alias("k_print"))
    least, more = F.min("copies").alias("least"), (F.sum("copies") - F.min("copies") * F.count("*")).alias("more")
    counts = per_key.agg(least, more).filter("least > 0 or more > 0")
    scratch = Scratch(docs.sparkSession, "repeat")
    counts = scratch.write(counts, "counts")
    left = nested(docs).select(
        "row", F.col("row.doc_id").cast("long").alias("id"), F.col("row.source").cast("string").alias("source"),
        F.xxhash64(F.col("row.text").cast("string")).alias("print"),
    )
    same = F.col("id").eqNullSafe(F.col("k_id")) & F.col("source").eqNullSafe(F.col("k_source")) & (F.col("print") == F.col("k_print"))
    # merged at every size, so that a larger input takes no other plan
    joined = left.join(counts.hint("merge"), same)
    evenly = joined.filter("more = 0").withColumn("copies", F.col("least"))
    if counts.filter("more > 0").limit(1).count():
        # rows that share all of the key and differ in copies: their turn is their place in a table of them, which no task has alone
        key = ["k_id", "k_source", "k_print"]
        unevenly = joined.filter("more > 0").select(F.col("row").alias("whole"), *key, "least", "more", F.xxhash64(F.to_json("row")).alias("print"))
        placed = with_prefix(ordered_table(scratch, unevenly, [*key, "print"], "unevenly"), {"place": F.lit(1)}).drop("place_all")
        placed = scratch.write(placed, "placed")
        first = scratch.write(placed.groupBy(*[F.col(k).alias(f"_{k}") for k in key]).agg(F.min("place").alias("_place")), "first_places")
        same = F.lit(True)
        for k in key:
            same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
        placed = placed.join(small_or_shuffled(first), same)
        copies = F.col("least") + (F.col("place") - F.col("_place") < F.col("more")).cast("long")
        evenly = evenly.select("row", "copies").unionByName(placed.select(F.col("whole").alias("row"), copies.alias("copies")))
    times = evenly.filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    return times.select("row.*")
