"""Quality rules: hashed n-gram logistic regression, calibrated, against fixed thresholds.

The model is fitted on the driver from a bounded sample of labelled rows, featurised on the
executors; every text is then scored whole, in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityforge.llm.columns import Columns, map_columns, text_udf
from entityforge.llm.hashed import Linear, feature_vector, fit_calibrated, hashes_of
from entityforge.llm.textstats import WordNumbers, stats_of

#: Labelled rows that the fit takes at most, by hash of their id, from each class.
SAMPLE_PER_CLASS = 700
#: A text whose calibrated probability of being good is below this is rejected.
MIN_PROBABILITY = 0.5
#: Base rules: fewest words, and the largest share of words in repeated 3-word windows.
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50

FEATURES = "label double, held boolean, slots binary, shares binary"


def featurise(sample: DataFrame) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """Features, targets and held-out flags of a bounded table (text, label, held), collected."""

    def vector(text: str, numbers: WordNumbers) -> tuple[np.ndarray, np.ndarray]:
        return feature_vector(text, hashes_of(text, numbers)[1])

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        numbers = WordNumbers()
        for batch in batches:
            found = [vector(t or "", numbers) for t in batch["text"]]
            yield {
                "label": batch["label"], "held": batch["held"],
                "slots": [a.astype(np.int32).tobytes() for a, _ in found], "shares": [v.astype(np.float32).tobytes() for _, v in found],
            }

    rows = map_columns(sample.select("text", "label", "held"), run, FEATURES).collect()
    features = [(np.frombuffer(r["slots"], np.int32).astype(np.int64), np.frombuffer(r["shares"], np.float32).astype(float)) for r in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i]["label"], rows[i]["held"], rows[i]["slots"], rows[i]["shares"]))
    return [features[i] for i in order], np.array([rows[i]["label"] for i in order]), np.array([rows[i]["held"] for i in order], dtype=bool)


def fit_rules(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Linear:
    """The model from labelled rows (doc_id, quality), at most `per_class` of each class.

    Ids are taken in the order of a hash, a quarter of them for calibration. An id and a class are one row,
    however often either table repeats the id: of its texts, the one of the smallest hash. Null labels are
    left out; with one class or none, the model rejects nothing.
    """
    h = F.xxhash64(F.lit(17), F.col("doc_id"))
    usable = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("_id"), (F.col("quality") > 0).cast("double").alias("label"), h.alias("_h")
    )
    prior = usable.agg(F.avg("label")).first()[0] or 0.5
    picked = None
    for label in (0.0, 1.0):
        part = usable.filter(F.col("label") == label).distinct().orderBy("_h", "_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    # at most 2 * per_class rows, on either side of the join
    met = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_id"))
    sample = met.groupBy("_id", "label", "_h").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("least")).select("label", "_h", "least.text")
    return fit_calibrated(*featurise(sample.select("text", "label", (F.pmod("_h", F.lit(4)) == 0).alias("held"))), prior)


VERDICT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, probability double, kept boolean"
)


def judge_texts(docs: DataFrame, model: Linear, min_probability: float = MIN_PROBABILITY, text_col: str = "text", name: str = "rules") -> DataFrame:
    """`docs` with a struct column `name`: base counts, base verdict, probability and `kept`.

    Every text is read whole; a null, empty or blank text has no words and fails the base rules. All
    columns and rows, repeated ones too, are kept as they are; an empty table stays empty. `name`
    must be a column that `docs` lacks. The rules know no language; the model knows what its rows show.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def judge():
        numbers, scorer = WordNumbers(), shared.value

        def say(texts: list[str | None]) -> list[tuple]:
            out = []
            for text in texts:
                text = text or ""
                at, hashes = hashes_of(text, numbers)
                s = stats_of(text, at)
                failed = s.n_words < MIN_WORDS or 100 * s.n_repeat_words > MAX_REPEATED_PERCENT * s.n_words
                p = float(scorer.probability(scorer.margin(text, hashes)))
                out.append((s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words, failed, p, not failed and p >= min_probability))
            return out

        return say

    return docs.withColumn(name, text_udf(judge, VERDICT)(F.col(text_col).cast("string")))
