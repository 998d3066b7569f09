"""Which texts hold which names: one pass of an automaton over the texts, or a join on rare grams for very many names."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from entityforge.session import cut_lineage

#: Distinct names, and their characters, that one automaton holds at most, some 100 MB in a worker; beyond, grams are joined.
NAMES, NAME_CHARS = 50_000, 1_000_000
#: Characters of a gram, at most three, so that a gram is one number of 63 bits.
GRAM = 3
#: Bits of the sieve of grams that names ask for, as a power of two: 2 MB at every number of names.
SIEVE_BITS = 24


def _machine(names: list[str], values: list):
    """An automaton of the names that are not empty; None without any."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for name, value in zip(names, values):
        if name:
            machine.add_word(name, value)
    if not len(machine):
        return None
    machine.make_automaton()
    return machine


def names_in(names: list[str]):
    """A column function: the distinct `names` that a text holds; null gives none."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        everywhere, machine = [""] if "" in names else [], _machine(names, names)
        for batch in batches:
            found = []
            for text in batch.to_pylist():
                held = {name for _, name in machine.iter(text)} if text and machine else set()
                found.append([] if text is None else everywhere + sorted(held))
            yield pa.array(found, type=pa.list_(pa.string()))

    return arrow_udf(run, "array<string>").asNondeterministic()


def _first_of(names: list[str]) -> Callable[[str], int | None]:
    """The smallest place among the `names` that a text holds, as a function of the text.

    A name that holds one of a smaller place can never be the answer and is left out of the automaton, so that
    what a text meets are names of ever smaller place the shorter they are; a text ends at place 0.
    """
    places = {name: place for place, name in reversed(list(enumerate(names)))}
    machine = _machine(list(places), list(places.values()))
    within = lambda text: min((p for _, p in machine.iter(text)), default=None) if machine else None
    kept = [n for n, p in places.items() if within(n) == p]
    machine = _machine(kept, [places[n] for n in kept])
    empty = places.get("")

    def first(text: str) -> int | None:
        best = empty
        for _, place in machine.iter(text) if machine and text else ():
            if best is None or place < best:
                best = place
                if best == 0:
                    break
        return best

    return first


def first_name_in(names: list[str]):
    """A column function: the place of the first of `names` that a text holds; null where there is none."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        first = _first_of(names)
        for batch in batches:
            yield pa.array([None if text is None else first(text) for text in batch.to_pylist()], type=pa.int64())

    return arrow_udf(run, "bigint").asNondeterministic()


def first_text_around(texts: DataFrame, text: str, names: list[str]) -> DataFrame:
    """(place, pos, id): for each of `names`, by its place, the least (pos, id) of the texts that hold it; a row per name and task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine, best = _machine(names, list(range(len(names)))), {}
        always = {names.index("")} if "" in names else set()
        for batch in batches:
            for pos, id_, held in zip(batch["pos"].tolist(), batch["id"], batch["text"]):
                for place in always | ({place for _, place in machine.iter(held)} if machine and held else set()):
                    if place not in best or (pos, id_) < best[place]:
                        best[place] = (pos, id_)
        yield pd.DataFrame({"place": list(best), "pos": [p for p, _ in best.values()], "id": [i for _, i in best.values()]}).astype({"place": "int64", "pos": "int64", "id": "object"})

    return texts.filter(F.col(text).isNotNull()).select("pos", "id", F.col(text).alias("text")).mapInPandas(run, "place bigint, pos bigint, id string")


def distinct_names(rows: DataFrame, name: str) -> list[str] | None:
    """The distinct names if one automaton may hold them, else None."""
    some = [r[0] for r in rows.select(name).filter(F.col(name).isNotNull()).distinct().limit(NAMES + 1).collect()]
    return None if len(some) > NAMES or sum(map(len, some)) > NAME_CHARS else some


def containment_join(left: DataFrame, text: str, right: DataFrame, name: str) -> DataFrame:
    """Pairs whose `text` (left) holds `name` (right), compared as they are; null holds and is held by nothing.

    Counted, few names stream texts past one automaton, each text once; more meet texts by their rarest gram.
    """
    some = distinct_names(right, name)
    if some is None:
        return _by_rarest_gram(left, text, right, name)
    held = left.withColumn("_held", F.explode(names_in(some)(F.col(text))))
    return held.join(right, F.col("_held") == F.col(name)).drop("_held")


def _grams(text: str) -> np.ndarray:
    """All distinct grams of up to GRAM characters as numbers: code points plus 1 are digits of 21 bits, so no two grams share one."""
    digit = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64) + 1
    found, gram = [], np.zeros(len(digit), np.int64)
    for size in range(1, GRAM + 1):
        if len(digit) < size:
            break
        gram = (gram[: len(digit) - size + 1] << 21) | digit[size - 1 :]
        found.append(gram)
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _slot(gram: np.ndarray) -> np.ndarray:
    """Place in the sieve."""
    return ((gram.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)


def _grams_of(sieve: np.ndarray | None = None, whole: bool = False):
    """A column function: a text's distinct grams that the sieve lets through; with `whole`, only those as long as can be."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = []
            for text in batch.to_pylist():
                grams = _grams(text)
                if whole and len(text) >= GRAM:
                    grams = grams[grams >= 1 << (21 * (GRAM - 1))]
                elif whole:
                    grams = grams[-1:]
                if sieve is not None:
                    at = _slot(grams)
                    grams = grams[(sieve[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
                found.append(grams)
            yield pa.array(found, type=pa.list_(pa.int64()))

    return arrow_udf(run, "array<bigint>").asNondeterministic()


def _sieve_of(grams: DataFrame) -> np.ndarray:
    """The bits of all grams, put together by the tasks: at most 2^(SIEVE_BITS - 3) numbers reach the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.zeros(1 << (SIEVE_BITS - 3), np.uint8)
        for batch in batches:
            at = _slot(batch["_gram"].to_numpy(np.int64))
            np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        place = np.flatnonzero(bits)
        yield pd.DataFrame({"place": place.astype(np.int64), "bits": bits[place].astype(np.int64)})

    sieve = np.zeros(1 << (SIEVE_BITS - 3), np.uint8)
    set_ = grams.select("_gram").mapInPandas(run, "place bigint, bits bigint").groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    sieve[set_["place"].to_numpy()] = set_["bits"].to_numpy()
    return sieve


def _held_of():
    """A column function of (text, names): those of the names that the text holds, in one pass over it."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, asked in batches:
            found = []
            for text, names in zip(texts.to_pylist(), asked.to_pylist()):
                machine = _machine(names, names)
                found.append(sorted({name for _, name in machine.iter(text)}) if machine else [])
            yield pa.array(found, type=pa.list_(pa.string()))

    return arrow_udf(run, "array<string>").asNondeterministic()


def _by_rarest_gram(left: DataFrame, text: str, right: DataFrame, name: str) -> DataFrame:
    """A name looks only at texts that hold its gram of fewest texts; only hashes of texts travel until then.

    Names shorter than a gram are grams of their own length; the empty one is held by every text. Texts are
    turned into numbers once, in time that grows with their length alone, and a sieve of the grams that names ask
    for, as large for any number of names, keeps all others from the shuffle. A text and the names that look at
    it are compared in one pass over the text.
    """
    names = right.select(F.col(name).alias("_needle")).filter("_needle <> ''").distinct()
    texts = left.select(F.col(text).alias("_text")).filter("_text is not null").distinct().withColumn("_h", F.xxhash64("_text"))
    grams = cut_lineage(names.select("_needle", F.explode(_grams_of(whole=True)(F.col("_needle"))).alias("_gram")))
    sieve = _sieve_of(grams)
    spots = texts.select("_h", F.explode(_grams_of(sieve)(F.col("_text"))).alias("_gram"))
    spots = cut_lineage(spots.join(grams.select("_gram").distinct(), "_gram", "left_semi"))
    counts = spots.groupBy("_gram").agg(F.count("*").alias("_n"))
    # a name with a gram that no text holds is in no text
    ranked = grams.join(counts, "_gram", "left").groupBy("_needle").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_gram")).alias("_best"))
    picked = ranked.filter("_best.n > 0").select("_needle", F.col("_best._gram").alias("_gram"))
    asked = spots.join(picked, "_gram").groupBy("_h").agg(F.collect_set("_needle").alias("_asked"))
    looked = texts.join(asked, "_h").withColumn("_needle", F.explode(_held_of()(F.col("_text"), F.col("_asked")))).select("_h", "_text", "_needle")
    pairs = left.withColumn("_left_h", F.xxhash64(text)).join(looked, (F.col("_left_h") == F.col("_h")) & (F.col(text) == F.col("_text"))).select(*left.columns, "_needle")
    every = left.filter(F.col(text).isNotNull()).withColumn("_needle", F.lit(""))
    pairs = pairs.unionByName(every.select(*left.columns, "_needle"))
    return pairs.join(right, F.col("_needle") == F.col(name)).drop("_needle")
