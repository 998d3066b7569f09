"""Approximate nearest neighbours by a hash-prefix forest.

A tree is a sorted array of long hash strings, one sign per random hyperplane. A query descends to
the place of its own string, where the longest prefixes match, and all trees ascend together, a bit
at a time, for more candidates. How far is told by the nearest rows found so far: under a prefix of
n bits, a tree holds a row at angle t with a chance of (1 - t / pi)^n, so the ascent ends where all
trees together hold any row nearer than the k-th best with a chance of `FOUND_CHANCE`.

The table is one more such tree, cut into blocks by prefixes of varying length, each as long as it
takes for a block to fit one task; a block has a forest of its own. A query first descends to the
block of its own prefix. With the angle of its k-th best there it visits, likeliest first, the other
blocks that may hold a nearer row: a plane on which the query projects m separates it from a row at
angle t with a chance of the normal law at -|m| / tan(t). On vectors with structure these are few;
without structure the angles are wide, and no index can do with less than much of the table.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityforge.llm.columns import Columns, as_columns, let, map_columns, names
from entityforge.llm.scratch import Scratch, partitions_for, small_or_shuffled

#: Trees of a block's forest, and bits of a hash string.
TREES, BITS = 48, 32
#: Chance that a row nearer than the k-th best is in a block visited, and that its block's forest finds it there.
FOUND_CHANCE = 0.95
#: With what chance the blocks that a query has visited by the end of each round hold any nearer row: in the
#: first, one leaf is visited, by its prefix at this angle; the angle of the k-th best then bounds the next.
ROUNDS, FIRST_ANGLE = (0.0, 0.5, FOUND_CHANCE), 0.4
#: Less than any cosine.
NO_BOUND = -2.0
#: Queries that ascend together; bits of a step of the ascent; cosines that differ by less may be equal.
GROUP, STEP, SLACK = 64, 2, 1e-12
#: Rows of a block at most, about 100 MB with its trees at 64 dimensions, and at least; bits of a block's prefix at most.
BLOCK_ROWS, LEAST_BLOCK, PREFIX_BITS = 65_536, 2048, 18


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times powers of two, which are exact, so that no square overflows or vanishes."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def planes_of(count: int, dim: int, seed: int) -> np.ndarray:
    """Normals of random hyperplanes, one per column; those of a seed and dimension are always the same."""
    return np.random.default_rng([seed, dim]).standard_normal((dim, count))


def depth_for(angle: np.ndarray, trees: int, deepest: int) -> np.ndarray:
    """Longest prefix under which `trees` trees hold a row at this angle with `FOUND_CHANCE`."""
    single = 1 - (1 - FOUND_CHANCE) ** (1 / trees)
    with np.errstate(divide="ignore"):
        depth = np.log(single) / np.log(np.clip(1 - angle / np.pi, 1e-9, 1 - 1e-12))
    return np.clip(np.floor(depth), 0, deepest).astype(np.int64)


class Forest:
    """The trees of one block of row vectors."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = 5):
        self.vectors, self.bits, self.trees = scaled(vectors), bits, trees
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        self.planes = planes_of(trees * bits, vectors.shape[1], seed).astype(np.float32)
        #: Deeper than this, prefixes of distinct strings of a block hardly ever agree.
        self.deepest = min(bits, len(vectors).bit_length() + 4)
        self.order, self.keys = [], []
        for codes in self.hashes(self.vectors):
            order = np.argsort(codes, kind="stable").astype(np.int32)
            self.order.append(order)
            self.keys.append(codes[order])
        #: How many rows queries have been compared with.
        self.compared = 0

    def hashes(self, vectors: np.ndarray) -> Iterator[np.ndarray]:
        """The hash strings of `vectors` in each tree, as numbers whose highest bit comes first."""
        single, weights = vectors.astype(np.float32), 1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64)
        for t in range(self.trees):
            yield (single @ self.planes[:, t * self.bits : (t + 1) * self.bits] > 0) @ weights

    def _ranges(self, codes: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per tree and query: where the entries that share `length` bits with it begin and end."""
        free = (1 << (self.bits - length)) - 1
        at = codes & ~free[:, None]
        ends = [(np.searchsorted(k, at[:, t]), np.searchsorted(k, at[:, t] + free, side="right")) for t, k in enumerate(self.keys)]
        return np.array([low for low, _ in ends]), np.array([high for _, high in ends])

    def nearest(self, queries: np.ndarray, k: int, bound: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per query: rows with the k largest cosines found, ties at the k-th included, and the cosines.

        `bound`: cosine that k rows elsewhere reach already, so that only nearer ones are of use;
        fewer than k rows may be found then. A query's ascent goes on until k distinct rows are
        found, all rows if they are fewer, and no nearer one is likely to be missing.
        """
        queries = scaled(queries)
        norms = np.sqrt((queries * queries).sum(axis=1))
        codes = np.stack(list(self.hashes(queries)), axis=1)
        for at in range(0, len(queries), GROUP):
            some = slice(at, at + GROUP)
            yield from self._ascend(queries[some], norms[some], codes[some], k, None if bound is None else bound[some])

    def _depth(self, cosine: float) -> int:
        return int(depth_for(np.arccos(np.clip(cosine, -1, 1)), self.trees, self.deepest))

    def _ascend(self, queries: np.ndarray, norms: np.ndarray, codes: np.ndarray, k: int, bound: np.ndarray | None) -> Iterator:
        n = len(queries)
        best = np.full(n, NO_BOUND) if bound is None else bound.copy()
        # the first look is where a nearer row must be if there is a bound, else at the longest prefixes
        length = np.array([self.deepest if bound is None else self._depth(b) for b in best])
        seen = np.zeros((n, len(self.vectors)), dtype=bool)
        rows, score = [np.zeros(0, np.int64)] * n, [np.zeros(0)] * n
        waiting = np.arange(n)
        while len(waiting):
            low, high = self._ranges(codes[waiting], length[waiting])
            again = []
            for j, q in enumerate(waiting.tolist()):
                mark = np.zeros(len(self.vectors), dtype=bool)
                for order, a, b in zip(self.order, low[:, j].tolist(), high[:, j].tolist()):
                    if b > a:
                        mark[order[a:b]] = True
                fresh = np.flatnonzero(mark & ~seen[q])
                seen[q] |= mark
                self.compared += len(fresh)
                found = np.concatenate([rows[q], fresh])
                cosine = np.concatenate([score[q], self.vectors[fresh] @ queries[q] / (self.norms[fresh] * norms[q])])
                if len(found) >= k:
                    edge = float(np.partition(cosine, len(found) - k)[len(found) - k])
                    keep = cosine >= edge - SLACK
                    found, cosine = found[keep], cosine[keep]
                    best[q] = max(best[q], edge)
                rows[q], score[q] = found, cosine
                # without a bound, all is looked through until k rows are found
                goal = self._depth(best[q]) if len(found) >= k or bound is not None else 0
                if goal < length[q]:
                    length[q] = max(goal, length[q] - STEP)
                    again.append(q)
            waiting = np.array(again, dtype=np.int64)
        for q in range(n):
            at = rows[q] if bound is None else rows[q][score[q] >= bound[q] - SLACK]
            # the same sum for a pair wherever its row lies
            yield at, (self.vectors[at] * queries[q]).sum(axis=1) / (self.norms[at] * norms[q])


class Prefixes:
    """The tree of blocks: leaves are prefixes of the routing string, as (bits, value), with their block numbers."""

    def __init__(self, counts: dict[int, int], dim: int, block_rows: int, bits: int = PREFIX_BITS, seed: int = 7):
        self.bits, self.planes = bits, planes_of(bits, dim, seed)
        #: Children of the nodes that are split; blocks of the leaves, several where one prefix holds very many rows.
        self.split: set[tuple[int, int]] = set()
        self.blocks: dict[tuple[int, int], list[int]] = {}
        values = np.array(sorted(counts), dtype=np.int64)
        upto = np.append(0, np.cumsum([counts[v] for v in values.tolist()]))
        self.n = 0
        open_ = [(0, 0)]
        while open_:
            length, value = open_.pop()
            low, high = (np.searchsorted(values, (value + i) << (bits - length)) for i in (0, 1))
            rows = int(upto[high] - upto[low])
            if rows > block_rows and length < bits:
                self.split.add((length, value))
                open_ += [(length + 1, 2 * value), (length + 1, 2 * value + 1)]
            elif rows:
                many = -(-rows // block_rows)
                self.blocks[length, value] = list(range(self.n, self.n + many))
                self.n += many

    def margins(self, vectors: np.ndarray) -> np.ndarray:
        """Projections of unit vectors on the routing planes."""
        v = scaled(vectors)
        return (v / np.sqrt((v * v).sum(axis=1))[:, None]) @ self.planes

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Routing strings as numbers whose highest bit comes first."""
        return (self.margins(vectors) > 0) @ (1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64))

    def leaf(self, code: int) -> tuple[int, int]:
        """The leaf whose prefix `code` has: the longest that is not split."""
        length = 0
        while (length, code >> (self.bits - length)) in self.split:
            length += 1
        return length, code >> (self.bits - length)

    def blocks_for(self, margins: np.ndarray, bound: float | None, chance: float, known: list[int]) -> list[int]:
        """Blocks that together hold a row at the cosine `bound` with `chance`, without those known.

        Without a bound it is the leaf with the longest prefix of the query's string, or the likeliest
        one that is not empty; for `NO_BOUND`, where k rows were not found, it is all.
        """
        if bound == NO_BOUND:
            found = [b for many in self.blocks.values() for b in many]
        else:
            found = self._likely(margins, FIRST_ANGLE if bound is None else math.acos(max(-1.0, min(1.0, bound))), chance)
        return [b for b in found if b not in known]

    def _likely(self, margins: np.ndarray, angle: float, chance: float) -> list[int]:
        slope = math.cos(angle) / max(math.sin(angle), 1e-9) / math.sqrt(2)
        apart = [0.5 * math.erfc(abs(m) * slope) for m in margins.tolist()]
        own = (margins > 0).astype(int).tolist()
        found, held, heap = [], 0.0, [(-1.0, 0, 0)]
        while heap and (not found or held < chance):
            p, length, value = heapq.heappop(heap)
            if (length, value) in self.split:
                for bit in (0, 1):
                    heapq.heappush(heap, (p * (1 - apart[length] if bit == own[length] else apart[length]), length + 1, 2 * value + bit))
            else:
                held -= p
                found += self.blocks.get((length, value), [])
        return found


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


#: Parts in which the ids of one vector are put together first.
ID_PARTS = 256


def _least_ids(ids: Column, k: int) -> Column:
    """Of sorted ids: the k + 1 smallest distinct ones, each as often as it occurs, k times at most."""

    def kept(last: Column) -> Column:
        few = F.filter(ids, lambda x, i: (i < k) | (x != F.get(ids, i - k)))
        return F.filter(few, lambda x: last.isNull() | (x <= last))

    return let(F.get(F.array_distinct(ids), F.lit(k)), kept)


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """Equal vectors as one row (vector, ids), with the ids that can be among k answers to any query.

    Those are the k + 1 smallest distinct ids, each as often as it occurs, k times at most: a query leaves out
    its own, and k others stay. Batches are reduced first, and their lists part by part, so that a vector that
    very many rows share is never one long list.
    """

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            found: dict[bytes, tuple[list, Counter]] = {}
            for i, v in zip(batch["id"], batch["vector"]):
                found.setdefault(np.array(v).tobytes(), (v, Counter()))[1][i] += 1
            ids = [[i for i in sorted(seen)[: k + 1] for _ in range(min(seen[i], k))] for _, seen in found.values()]
            yield {"vector": [v for v, _ in found.values()], "ids": ids}

    local = map_columns(rows, run, "vector array<double>, ids array<long>").withColumn("part", F.pmod(F.xxhash64("ids", F.spark_partition_id()), F.lit(ID_PARTS)))
    together = let(F.array_sort(F.flatten(F.collect_list("ids"))), lambda ids: _least_ids(ids, k))
    return local.groupBy("vector", "part").agg(together.alias("ids")).groupBy("vector").agg(together.alias("ids"))


FOUND = "query_id long, vec_id long, score double"
_PLAN = "id long, vector array<double>, bound double, seen array<int>, blocks array<int>"
_SLOT = "dim int, block int, kind int, query_id long, bound double, vector array<double>, ids array<long>"


def _visit(laid: DataFrame, k: int, trees: int, bits: int) -> DataFrame:
    """What the forests of all blocks find. Rows of a block (kind 0) come before the queries (kind 1) that visit it."""

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        place, forest, stored, ids = None, None, [], []
        for batch in batches:
            out: list[tuple] = []
            n, i = len(batch["kind"]), 0
            while i < n:
                here, kind = (batch["dim"][i], batch["block"][i]), batch["kind"][i]
                j = i
                while j < n and batch["kind"][j] == kind and (batch["dim"][j], batch["block"][j]) == here:
                    j += 1
                if here != place:
                    place, forest, stored, ids = here, None, [], []
                if kind == 0:
                    stored.append(np.array(batch["vector"][i:j]))
                    ids += batch["ids"][i:j]
                elif stored:
                    if forest is None:
                        forest = Forest(np.concatenate(stored), trees, bits)
                        stored = [forest.vectors[:0]]
                    bounds = batch["bound"][i:j]
                    found = forest.nearest(np.array(batch["vector"][i:j]), k + 1, None if bounds[0] is None else np.array(bounds))
                    for query_id, (at, score) in zip(batch["query_id"][i:j], found):
                        best = sorted((-s, x) for a, s in zip(at, score.tolist()) for x in ids[a] if x != query_id)[:k]
                        out += [(query_id, x, -s) for s, x in best]
                i = j
            yield as_columns(out, names(FOUND))

    return map_columns(laid.sortWithinPartitions("dim", "block", "kind"), run, FOUND)


def _prefix_counts(index: DataFrame) -> dict[int, dict[int, int]]:
    """Per dimension: how many rows have each routing string, at most 2^`PREFIX_BITS` numbers."""

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            for dim in set(map(len, batch["vector"])):
                some = np.array([v for v in batch["vector"] if len(v) == dim])
                code, n = np.unique(Prefixes({}, dim, 1).codes(some), return_counts=True)
                yield {"dim": [dim] * len(code), "code": code, "n": n}

    found = map_columns(index.select("vector"), run, "dim int, code long, n long").groupBy("dim", "code").agg(F.sum("n").alias("n"))
    out: dict[int, dict[int, int]] = {}
    for r in found.toArrow().to_pylist():
        out.setdefault(r["dim"], {})[r["code"]] = r["n"]
    return out


def search(
    table: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
    trees: int = TREES, bits: int = BITS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """For each row for which `is_query` holds, the k nearest other rows that the forest finds.

    Nearness is the cosine of the original vectors in double precision, ties to the smaller id.
    Vectors that are null, all zero, or hold null or non-finite components take no part, nor do rows
    without an id; vectors of different lengths are never compared. Rows that repeat an id each count
    as a candidate, a query never meets rows of its own id, and a repeated query is answered once;
    with fewer than k other rows, all are found. Other columns are not read, whatever their names.
    Returns query_id, rank (from 1), vec_id, score; no rows for an empty table.
    """
    spark = table.sparkSession
    scratch = Scratch(spark, "nearest")
    vector = F.col(vector_col)
    rows = table.filter(F.col(id_col).isNotNull() & usable(vector)).select(
        F.col(id_col).cast("long").alias("id"), vector.cast("array<double>").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")
    )
    index = scratch.write(distinct_vectors(rows.select("id", "vector"), k), "index")
    asked = scratch.write(rows.filter("asks").select("id", "vector").dropDuplicates(["id"]), "asked")
    counts = _prefix_counts(index)
    n = sum(sum(c.values()) for c in counts.values())
    # a block or two for every task, but none too large for one, nor too small to be worth a forest
    block_rows = min(block_rows, max(-(-n // (2 * partitions_for(spark))), LEAST_BLOCK))
    trees_of = spark.sparkContext.broadcast({dim: Prefixes(c, dim, block_rows) for dim, c in counts.items()})
    blocks = max(sum(p.n for p in trees_of.value.values()), 1)

    def place(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            out = []
            for dim in set(map(len, batch["vector"])):
                at = [i for i, v in enumerate(batch["vector"]) if len(v) == dim]
                tree = trees_of.value[dim]
                for i, code in zip(at, tree.codes(np.array([batch["vector"][i] for i in at])).tolist()):
                    own = tree.blocks[tree.leaf(code)]
                    block = own[hash(tuple(batch["vector"][i])) % len(own)] if len(own) > 1 else own[0]
                    out.append((dim, block, 0, None, None, batch["vector"][i], batch["ids"][i]))
            yield as_columns(out, names(_SLOT))

    def planner(chance: float):
        def run(batches: Iterator[Columns]) -> Iterator[Columns]:
            for batch in batches:
                blocks = []
                for v, bound, seen in zip(batch["vector"], batch["bound"], batch["seen"]):
                    tree = trees_of.value.get(len(v))
                    blocks.append(tree.blocks_for(tree.margins(np.array([v]))[0], bound, chance, seen) if tree else [])
                yield batch | {"blocks": blocks}

        return run

    held = scratch.write(map_columns(index, place, _SLOT), "held")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))

    queries, found = asked.select("id", "vector", F.lit(None).cast("double").alias("bound"), F.array().cast("array<int>").alias("seen")), None
    for turn, chance in enumerate(ROUNDS):
        planned = scratch.write(map_columns(queries, planner(chance), _PLAN), f"plan{turn}")
        if turn and not planned.filter(F.size("blocks") > 0).limit(1).count():
            continue
        asks = planned.select(
            F.size("vector").alias("dim"), F.explode("blocks").alias("block"), F.lit(1).alias("kind"), F.col("id").alias("query_id"),
            "bound", "vector", F.lit(None).cast("array<long>").alias("ids"),
        )
        visited = held
        if turn:
            # of later rounds, only blocks that a query asks for travel
            wanted = scratch.write(asks.select(F.col("dim").alias("_dim"), F.col("block").alias("_block")).distinct(), f"wanted{turn}")
            visited = held.join(small_or_shuffled(wanted), (F.col("dim") == F.col("_dim")) & (F.col("block") == F.col("_block")), "left_semi")
        made = scratch.write(_visit(visited.unionByName(asks).repartition(blocks, "dim", "block"), k, trees, bits), f"found{turn}")
        found = made if found is None else found.unionByName(made)
        # the k-th best so far, for queries that found so many
        kth = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("kth"))
        queries = planned.join(kth, "id", "left").select("id", "vector", F.coalesce("kth", F.lit(NO_BOUND)).alias("bound"), F.concat("seen", "blocks").alias("seen"))
    scratch.keep_only(*(f"found{i}" for i in range(len(ROUNDS))))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
