"""The training-data pipeline: five stages over `documents`, each written and read again.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns
of `documents`. A stage sees all rows that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityforge.llm import jaccard, mixing, packing, quality_rules, weak_quality
from entityforge.llm.columns import nested
from entityforge.llm.registry import tokenizer_path
from entityforge.llm.scratch import Scratch, small_or_shuffled


def _own_name(docs: DataFrame) -> str:
    """A column name that `docs` lacks, in whatever case."""
    name, taken = "_verdict", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality rules reject.

    Null and empty texts have too few words and go. Repeated rows share a verdict; ids may be null or repeat, since
    texts are judged. An empty table gives none. All columns stay as they are, whatever their names.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    name = _own_name(docs)
    judged = quality_rules.judge_texts(docs, quality_rules.fit_rules(docs, labels), name=name)
    return judged.filter(F.col(f"{name}.kept")).drop(name)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the weak-label classifier, fitted on this stage's input, rejects.

    A null text is judged as an empty one, repeated rows share a verdict, ids are not read, and an empty table gives
    none. All columns stay as they are, whatever their names.
    """
    name = _own_name(docs)
    judged = weak_quality.classify_texts(docs, weak_quality.fit_weak(docs)[0], name=name)
    return judged.filter(F.col(f"{name}.kept")).drop(name)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each component of near copies: the one with the smallest id.

    Rows, not ids, go or stay: ids may repeat or be null, a null id being the smallest. Of rows that
    repeat id and text the first by its other columns stays. Rows without words are copies of nothing.
    """
    gone, again = jaccard.spare_copies(docs)
    rows = nested(docs).select("row", jaccard.doc_of("row.doc_id").alias("doc"), jaccard.row_key("row.doc_id", "row.text").alias("key"))
    same_row = (F.col("doc") == F.col("_doc")) & (F.col("key") == F.col("_key"))
    kept = rows.join(small_or_shuffled(gone), same_row, "left_anti")
    if again.limit(1).count():
        twice = kept.join(small_or_shuffled(again), same_row, "left_semi")
        once = kept.join(small_or_shuffled(again), same_row, "left_anti")
        kept = once.unionByName(twice.groupBy("doc", "key").agg(F.min_by("row", F.to_json("row")).alias("row")), allowMissingColumns=True)
    return kept.select("row.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that sources come to weights 5, 2, 1, repeating.

    A null source is one of its own, texts without words get the whole copies of their source, rows alike in all get
    copies that differ by one at most, and an empty table gives none. All columns stay as they are, whatever their names.
    """
    return mixing.repeat_rows(docs, mixing.mix_sources(docs, (5, 2, 1), 3))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the mix into sequences of 2048 tokens.

    A null text is an empty one, of one token; long texts are cut into pieces; repeated rows and ids are packed each
    for itself, a null id stays null, and an empty table gives none. Returns the pieces; other columns are not kept.
    """
    return packing.pack(docs, tokenizer_path(), 2048, 0)


STAGES = [
    ("quality rules", rules_stage),
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_copies_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: SQL cannot express the fitted stages. tests/llm compares both stages of quality row by row with the fitted models by
#: dictionaries, the join and the packing with brute force, and the mixing with `mix_sources`.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is a table in the shared folder, dropped when its successor is written."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"stage{i}")
        if i:
            scratch.drop(f"stage{i - 1}")
    return docs
