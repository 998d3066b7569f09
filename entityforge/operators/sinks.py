"""Sinks. All overwrite. The distributed ones write with Spark; `*_document` functions make one small file."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The columns of the CSV export.
CSV_COLUMNS = ("id", "entity_type", "name", "description", "url", "logo_url", "categories", "source_name", "source_url", "metadata_json")


def flat_rows(entities: DataFrame) -> DataFrame:
    """Entities with ten text columns: categories joined by "; ", metadata as JSON."""
    return entities.select(
        "id", "entity_type", "name", "description", "url", F.coalesce("logo_url", F.lit("")).alias("logo_url"), F.array_join("categories", "; ").alias("categories"),
        F.col("source.name").alias("source_name"), F.col("source.url").alias("source_url"), F.to_json("metadata", {"ignoreNullFields": "false"}).alias("metadata_json"),
    )


def write_csv(entities: DataFrame, path: str, files: int | None = None) -> None:
    """CSV with a header, quotes doubled, CRLF; in ingest order when `files` is 1."""
    rows = entities.orderBy("pos") if files == 1 else entities
    flat = flat_rows(rows)
    flat = flat.coalesce(files) if files else flat
    flat.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").option("lineSep", "\r\n").csv(path)


def write_json(entities: DataFrame, edges: DataFrame, entity_path: str, edge_path: str) -> None:
    """JSON lines of both tables."""
    entities.drop("pos").write.mode("overwrite").option("ignoreNullFields", False).json(entity_path)
    edges.write.mode("overwrite").json(edge_path)


def json_document(rows: DataFrame, limit: int = 100_000) -> str:
    """A small table as one indented JSON array; raises beyond `limit` rows, which belong in `write_json`."""
    lines = rows.drop("pos").select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).limit(limit + 1).collect()
    if len(lines) > limit:
        raise ValueError(f"more than {limit} rows: write them with write_json")
    return json.dumps([json.loads(r[0]) for r in lines], indent=2, ensure_ascii=False)


def _indented(line: str) -> str:
    """An object as it stands in an indented array."""
    return "  " + json.dumps(json.loads(line), indent=2, ensure_ascii=False).replace("\n", "\n  ")


def _array_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines of a partition of an ordered array. Only the first row of those marked first opens it, only the last of those marked last ends it."""
    held, opened = None, False
    for batch in batches:
        made = []
        for line, first, last in zip(batch["line"], batch["first"], batch["last"]):
            if held is not None:
                made.append(held[0] + ",")
            held, opened = (("" if opened or not first else "[\n") + _indented(line), last), True
        if made:
            yield pd.DataFrame({"value": made})
    if held is not None:
        yield pd.DataFrame({"value": [held[0] + ("\n]" if held[1] else ",")]})


def write_json_parts(rows: DataFrame, path: str, order: Sequence[str] = ("pos",)) -> None:
    """An indented JSON array as a folder of text parts, written by the tasks; only the ends of `order` reach the driver.

    Parts concatenated by name are the document of `write_json_array` and a line break. Rows are ordered by the
    columns `order`, nulls first; ties stay next to each other in any order. `pos` is not written. An empty table gives `[]`.
    """
    spark = rows.sparkSession
    place = F.struct(*order)
    ends = rows.agg(F.min(place).alias("first"), F.max(place).alias("last")).first()
    if ends["first"] is None:
        spark.createDataFrame([("[]",)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return
    # equal places are in one partition of a range, so its first and last rows are known without numbering any
    is_end = {name: F.lit(True) for name in ends.asDict()}
    for name, end in ends.asDict().items():
        for column in order:
            is_end[name] &= F.col(column).eqNullSafe(F.lit(end[column]))
    line = F.to_json(F.struct(*[c for c in rows.columns if c != "pos"]), {"ignoreNullFields": "false"})
    marked = rows.orderBy(*order).select(line.alias("line"), is_end["first"].alias("first"), is_end["last"].alias("last"))
    marked.mapInPandas(_array_lines, "value string").write.mode("overwrite").text(path)


def write_json_array(rows: DataFrame, path: str) -> None:
    """One file with an indented JSON array, in ingest order where there is one, streamed row by row.

    The driver writes it, one partition of text in memory at a time, to any store that Spark reaches;
    a large catalog belongs in `write_json` or `write_json_parts`.
    """
    spark = rows.sparkSession
    ordered = rows.orderBy("pos").drop("pos") if "pos" in rows.columns else rows
    lines = ordered.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("line"))
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    try:
        mark = "["
        for row in lines.toLocalIterator():
            out.write(bytearray(f"{mark}\n{_indented(row['line'])}".encode()))
            mark = ","
        out.write(bytearray(b"[]" if mark == "[" else b"\n]"))
    finally:
        out.close()


def write_report_file(report: DataFrame, path: str) -> None:
    """The one-row report as one indented JSON file."""
    spark = report.sparkSession
    text = json.dumps(json.loads(report.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).first()[0]), indent=2, ensure_ascii=False)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_report(report: DataFrame, path: str) -> None:
    """The one-row report as JSON."""
    report.coalesce(1).write.mode("overwrite").json(path)
