"""Connected components of a table of edges, by contraction; nothing reaches the driver but counts."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityforge.llm.columns import Columns, map_columns
from entityforge.llm.scratch import Scratch, small_or_shuffled

#: Counted edges up to which one task finds the components, with a few tens of MB; beyond, the cluster contracts.
ONE_TASK_EDGES = 200_000


def _in_one_task(edges: DataFrame) -> DataFrame:
    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        parent: dict[int, int] = {}

        def top(x: int) -> int:
            while (p := parent.setdefault(x, x)) != x:
                parent[x] = parent[p]
                x = parent[x]
            return x

        for batch in batches:
            for u, v in zip(batch["u"], batch["v"]):
                a, b = top(u), top(v)
                parent[max(a, b)] = min(a, b)
        nodes = list(parent)
        yield {"node": nodes, "root": [top(x) for x in nodes]}

    return map_columns(edges.select("u", "v").repartition(1), run, "node long, root long")


def connected_components(scratch: Scratch, edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of `edges` (u, v: longs); nodes of a component share a root.

    In each round every node points at its smallest neighbour or itself, pointers are doubled, and
    the graph is contracted along them. Ids should be spread like hashes, so that pointer chains are
    short and a few rounds do. Each round is a written table, and self loops and repeats are dropped.
    """
    edges = scratch.write(edges.select("u", "v").filter("u != v"), f"{name}_given")
    if edges.count() <= ONE_TASK_EDGES:
        return scratch.write(_in_one_task(edges), f"{name}_roots")
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).filter("u != v").distinct()
    left = scratch.write(both, f"{name}_edges0")
    roots = left.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    step = 0
    while left.limit(1).count():
        parent = left.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("p"))
        parent = scratch.write(parent, f"{name}_parent{step}")
        for _ in range(2):
            other = parent.select(F.col("u").alias("_u"), F.col("p").alias("_p"))
            parent = parent.join(other, F.col("p") == F.col("_u")).select("u", F.col("_p").alias("p"))
        parent = scratch.write(parent, f"{name}_jump{step}")
        hint = small_or_shuffled(parent)
        at_u, at_v = hint.withColumnRenamed("p", "pu"), hint.select(F.col("u").alias("v"), F.col("p").alias("pv"))
        moved = left.join(at_u, "u").join(at_v, "v").select(F.col("pu").alias("u"), F.col("pv").alias("v"))
        step += 1
        left = scratch.write(moved.filter("u != v").distinct(), f"{name}_edges{step}")
        onto = hint.select(F.col("u").alias("root"), F.col("p").alias("_p"))
        roots = scratch.write(roots.join(onto, "root", "left").select("node", F.coalesce("_p", "root").alias("root")), f"{name}_roots{step}")
    return roots
