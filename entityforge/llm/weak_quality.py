"""Quality classifier from weak labels: no hand labels are used.

Overlapping heuristics vote good, bad or nothing on every text. Expectation-maximisation over the
counts of vote patterns, gathered from all documents, estimates how accurate each heuristic is;
the posteriors of the patterns label a bounded sample, which trains a hashed linear scorer.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityforge.llm.columns import Columns, map_columns, text_udf
from entityforge.llm.hashed import Linear, fit_calibrated, hashes_of
from entityforge.llm.quality_rules import featurise
from entityforge.llm.scratch import Scratch
from entityforge.llm.textstats import WordNumbers, stats_of, words_of

#: Frequent function words of the languages that the heuristics know.
FUNCTION_WORDS = frozenset(
    "the of and to in is that for was on are with as be this by at or from "
    "de la le les et des en un une du dans est que pour qui au avec "
    "der die und das von den zu mit ist nicht auf ein eine dem als "
    "el los las del y se por con no su para es una".split()
)
GOOD, BAD, NONE = "g", "b", "-"
HEURISTICS = 11


def _between(x: float, bad_low: float, low: float, high: float, bad_high: float) -> str:
    """Good from `low` to `high`, bad below `bad_low` or above `bad_high`, no vote between."""
    return GOOD if low <= x <= high else BAD if x < bad_low or x > bad_high else NONE


def votes_of(text: str, words: list[str], numbers: np.ndarray) -> str:
    """One vote of each heuristic on a whole text, as one letter each; a text without words gets none but bad.

    The heuristics that know words of some languages, or how long words are, have no vote on texts
    in other than Latin script, which UTF-8 takes far more bytes than characters for.
    """
    s = stats_of(text, numbers)
    n = len(words)
    if not n:
        return BAD * HEURISTICS
    raw = text.encode("utf-8", "surrogatepass")
    upper = sum(1 for w in words if len(w) > 1 and w.isupper())
    ends = sum(1 for w in words if w[-1] in ".?!;:")
    marks = text.count("!") + text.count("?")
    odd = sum(1 for w in words if w[-1] in "#*$%&|<>!")
    known = sum(1 for w in words if w.lower() in FUNCTION_WORDS)
    latin = len(raw) * 5 <= len(text) * 7
    return "".join(
        (
            _between(s.n_symbols / s.word_chars, -1, 0, 0.02, 0.1),
            _between(upper / n, -1, 0, 0.2, 0.6),
            _between(marks / n, -1, 0, 0.1, 0.4),
            _between(odd / n, -1, 0, 0.05, 0.3),
            _between(s.n_repeat_words / n, -1, 0, 0.2, 0.5),
            _between(s.n_dup_lines / max(s.n_lines, 1), -1, 0, 0.2, 0.5),
            _between(len(zlib.compress(raw, 1)) / len(raw), 0.2, 0.3, 9, 9),
            _between(len(set(words)) / n**0.75, 0.6, 1.2, 9e9, 9e9),
            _between(ends / n, 0.0, 0.02, 0.3, 0.6) if latin else NONE,
            _between(known / n, 0.005, 0.05, 0.7, 0.95) if latin else NONE,
            _between(s.word_chars / n, 1.5, 2.5, 10, 15) if latin else NONE,
        )
    )


def estimate(patterns: dict[str, int], rounds: int = 100) -> tuple[dict[str, float], np.ndarray]:
    """Posterior P(good) of each vote pattern, and P(vote | class) of each heuristic.

    A two-class latent model with independent heuristics, by expectation-maximisation from
    trust in texts that no heuristic objects to. Counts are smoothed, so that a heuristic that never votes says nothing.
    """
    if not patterns:
        return {}, np.zeros((0, 2, 3))
    keys = sorted(patterns)
    count = np.array([patterns[k] for k in keys], dtype=float)
    vote = np.array([[(GOOD, BAD, NONE).index(c) for c in k] for k in keys])
    good, bad = (vote == 0).sum(axis=1), (vote == 1).sum(axis=1)
    post = np.where(good + bad == 0, 0.5, np.where(bad == 0, 0.98, np.maximum(0.5**bad, 0.02)))
    table = np.zeros((vote.shape[1], 2, 3))
    for _ in range(rounds):
        prior = float(np.clip((count @ post + 1) / (count.sum() + 2), 1e-3, 1 - 1e-3))
        for j in range(vote.shape[1]):
            for y, share in enumerate((post, 1 - post)):
                seen = np.bincount(vote[:, j], count * share, minlength=3) + 0.5
                table[j, y] = seen / seen.sum()
        log = np.log(table)
        odds = np.log(prior / (1 - prior)) + sum(log[j, 0, vote[:, j]] - log[j, 1, vote[:, j]] for j in range(vote.shape[1]))
        new = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
        moved = float(np.abs(new - post).max())
        post = new
        if moved < 1e-9:
            break
    return dict(zip(keys, post.tolist())), table


#: Documents that train the scorer at most, by hash, from each side of the posterior.
SAMPLE_PER_SIDE = 700
MIN_PROBABILITY = 0.5


def fit_weak(docs: DataFrame, per_side: int = SAMPLE_PER_SIDE) -> tuple[Linear, dict[str, float]]:
    """The scorer and the posteriors of the vote patterns that occur.

    Votes and their counts come from all documents; the scorer is fitted on at most `per_side`
    documents with posterior above and below one half, in the order of a hash of id and text length.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "weak")

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        numbers = WordNumbers()
        for batch in batches:
            votes = []
            for text in batch["text"]:
                text = text or ""
                words = words_of(text)
                votes.append(votes_of(text, words, numbers.of(words)))
            yield {"key": batch["key"], "votes": votes}

    key = F.xxhash64(F.lit(23), F.col("doc_id"), F.xxhash64("text"))
    keyed = docs.select(key.alias("key"), "text")
    voted = scratch.write(map_columns(keyed, run, "key long, votes string"), "votes")
    # at most 3^11 patterns
    patterns = {r["votes"]: r["n"] for r in voted.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    posterior, _ = estimate(patterns)
    rows = [(k, p) for k, p in posterior.items()]
    table = F.broadcast(spark.createDataFrame(rows, "votes string, label double"))
    labelled = voted.join(table, "votes").dropDuplicates(["key"])
    picked = None
    for side in (F.col("label") >= 0.5, F.col("label") < 0.5):
        part = labelled.filter(side).orderBy("key").limit(per_side)
        picked = part if picked is None else picked.unionByName(part)
    picked = scratch.write(picked.select("key", "label"), "picked")
    # at most 2 * per_side rows
    sample = keyed.join(F.broadcast(picked.withColumnRenamed("key", "_key")), F.col("key") == F.col("_key"))
    sample = sample.dropDuplicates(["key"]).select("text", "label", (F.pmod("key", F.lit(4)) == 0).alias("held"))
    prior = sum(n * posterior[v] for v, n in patterns.items()) / max(sum(patterns.values()), 1)
    model = fit_calibrated(*featurise(sample), prior)
    scratch.drop("votes", "picked")
    return model, posterior


VERDICT = "n_words long, probability double, kept boolean"


def classify_texts(docs: DataFrame, model: Linear, min_probability: float = MIN_PROBABILITY, text_col: str = "text", name: str = "quality") -> DataFrame:
    """`docs` with a struct column `name`: the number of words, the scorer's probability of good, and `kept`.

    The scorer reads n-grams of the whole text and never the votes that its labels came from. A null,
    empty or blank text has no words, and the bias decides. All columns and rows, repeated ones too,
    stay as they are; an empty table stays empty. `name` must be a column that `docs` lacks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge():
        numbers, scorer = WordNumbers(), shared.value

        def say(texts: list[str | None]) -> list[tuple]:
            out = []
            for text in texts:
                at, hashes = hashes_of(text or "", numbers)
                p = float(scorer.probability(scorer.margin(text or "", hashes)))
                out.append((len(at), p, p >= min_probability))
            return out

        return say

    return docs.withColumn(name, text_udf(judge, VERDICT)(F.col(text_col).cast("string")))
