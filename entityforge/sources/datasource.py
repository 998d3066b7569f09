"""Remote searches and feeds as formats that `spark.read` knows.

A source's `queries` option, a JSON list, says what to ask; each query is a partition of its own, so it is one
task, and a filter on the column `query` leaves the others unasked. Rows are (_query, query, _item, raw): the
place of the query, the query, the place of the item in its answer, and the item as JSON.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition

SCHEMA = "_query bigint, query string, _item bigint, raw string"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
#: (query, options) → the items of its answer. It runs in a task.
Ask = Callable[[str, dict[str, str]], list[dict]]


@dataclass
class Asked(InputPartition):
    """One query and its place."""

    place: int
    query: str

    def __post_init__(self):
        self.value = self.place


class SearchReader(DataSourceReader):
    """Reads a list of queries, a partition each."""

    def __init__(self, queries: list[str], options: dict[str, str], ask: Ask):
        self.asked, self.options, self.ask = list(enumerate(queries)), options, ask

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes equality and membership of `query`; gives the others back."""
        for f in filters:
            if isinstance(f, EqualTo | EqualNullSafe) and f.attribute == ("query",):
                self.asked = [a for a in self.asked if a[1] == f.value]
            elif isinstance(f, In) and f.attribute == ("query",):
                self.asked = [a for a in self.asked if a[1] in f.value]
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        return [Asked(*a) for a in self.asked]

    def read(self, partition: InputPartition | None) -> Iterator[tuple]:
        if isinstance(partition, Asked):
            for i, item in enumerate(self.ask(partition.query, self.options)):
                yield partition.place, partition.query, i, json.dumps(item)


def source_of(name: str, ask: Ask) -> type[DataSource]:
    """A data source class of a name, whose queries `ask` answers."""

    class SearchSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema: object) -> SearchReader:
            options = dict(self.options)
            return SearchReader(json.loads(options.pop("queries", "[]")), options, ask)

    return SearchSource


def read_queries(spark: SparkSession, name: str, ask: Ask, queries: list[str], **options: object) -> DataFrame:
    """The rows of a source, registered anew so that this read answers by `ask`."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(source_of(name, ask))
    reader = spark.read.format(name).option("queries", json.dumps(queries))
    for key, value in options.items():
        reader = reader.option(key, str(value))
    return reader.load()
