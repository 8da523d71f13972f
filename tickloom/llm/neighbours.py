"""Nearest neighbours by inner product: a forest of random-projection trees.

Every tree halves the space again and again, each time at the median along the direction
between two vectors drawn at random. A query searches all trees through one priority queue,
the most promising branch of any tree first, and opens leaves until these hold a given
share of the vectors. All vectors in an opened leaf are candidates and ranked by their
exact inner product.

The trees are made from a bounded sample; every vector is put into its leaf of each tree.
Vectors and queries are dealt into blocks, and each pair of blocks is one group: no group
and no task grows with the table.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.store import written
from tickloom.llm.text import mix

TREES = 8
#: Vectors of the sample that the trees are made from, about; taken by a hash of their ids.
SAMPLE = 20_000
LEAF = 64
#: Leaves are opened until the sum of their shares of the vectors, over all trees, is this.
#: Vectors without any clusters need that much for a recall of 0.9 and more.
OPENED = 2.0
BLOCK = 8192
QUERY_BLOCK = 1024
_U64 = np.uint64


@dataclass
class Tree:
    """Inner nodes in a row: direction, offset, and the next node on either side; leaf k is -1 - k."""

    directions: np.ndarray
    offsets: np.ndarray
    below: np.ndarray
    above: np.ndarray
    weights: np.ndarray  # each leaf's share of the sample

    @property
    def root(self) -> int:
        return 0 if len(self.offsets) else -1

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        at = np.full(len(vectors), self.root)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            side = np.einsum("ij,ij->i", vectors[inner], self.directions[node]) < self.offsets[node]
            at[inner] = np.where(side, self.below[node], self.above[node])
        return -1 - at


def grow(sample: np.ndarray, seed: int, leaf: int = LEAF) -> Tree:
    draws = iter(range(1 << 62))

    def draw(count: int) -> int:
        return int(mix(np.array([seed * 1_000_003 + next(draws)], _U64))[0] % _U64(count))

    directions, offsets, below, above, weights = [], [], [], [], []

    def split(members: np.ndarray) -> int:
        if len(members) > leaf:
            for _ in range(5):
                direction = sample[members[draw(len(members))]] - sample[members[draw(len(members))]]
                norm = np.linalg.norm(direction)
                if not norm > 0:
                    continue
                direction = direction / norm
                along = sample[members] @ direction
                offset = float(np.median(along))
                low = along < offset
                if low.any() and not low.all():
                    node = len(offsets)
                    directions.append(direction)
                    offsets.append(offset)
                    below.append(0)
                    above.append(0)
                    below[node] = split(members[low])
                    above[node] = split(members[~low])
                    return node
        weights.append(len(members) / max(1, len(sample)))
        return -len(weights)

    split(np.arange(len(sample)))
    width = sample.shape[1]
    return Tree(
        np.array(directions).reshape(-1, width), np.array(offsets, float), np.array(below, int), np.array(above, int),
        np.array(weights),
    )


def opened(query: np.ndarray, forest: list[Tree], amount: float) -> list[list[int]]:
    """Per tree the leaves that the query opens, by one queue over all trees."""
    out: list[list[int]] = [[] for _ in forest]
    sides = [tree.directions @ query - tree.offsets for tree in forest]
    queue = [(0.0, number, tree.root) for number, tree in enumerate(forest)]
    while queue and amount > 0:
        far, number, node = heapq.heappop(queue)
        tree = forest[number]
        while node >= 0:
            side = sides[number][node]
            near, other = (tree.below[node], tree.above[node]) if side < 0 else (tree.above[node], tree.below[node])
            heapq.heappush(queue, (max(far, abs(side)), number, int(other)))
            node = int(near)
        out[number].append(-1 - node)
        amount -= tree.weights[-1 - node]
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, summed from the first component on."""
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        total += a[:, k] * b[:, k]
    return total


def _valid(table: DataFrame) -> DataFrame:
    """Rows whose vectors can take part: finite, not zero, of the most common length."""
    vector = F.col("embedding").cast("array<double>")
    usable = (
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.exists(
            vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
        ) & F.exists(vector, lambda x: x != 0)
    )
    rows = table.select(F.col("vec_id").cast("long"), vector.alias("vector")).where(usable)
    width = rows.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n"))
    width = width.orderBy(F.desc("n"), "width").first()
    return rows.where(F.size("vector") == (width.width if width else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def lifted(vectors: np.ndarray, largest: float) -> np.ndarray:
    """Vectors with a component more, which brings all to the same length.

    Their distances to a query that has none of it then fall as inner products grow, so that trees,
    which look for what is close by, find large inner products off the origin and at mixed lengths too.
    """
    rest = np.sqrt(np.maximum(largest - np.einsum("ij,ij->i", vectors, vectors), 0))
    return np.concatenate([vectors, rest[:, None]], axis=1)


def aimed(query: np.ndarray, largest: float) -> np.ndarray:
    """A query among lifted vectors, of their length."""
    return np.append(query * (np.sqrt(largest) / np.linalg.norm(query)), 0.0)


def search(table: DataFrame, is_query: str, count: int = 20, amount: float = OPENED, trees: int = TREES) -> DataFrame:
    """(query_id, rank, vec_id, score): for the rows of (vec_id, embedding) chosen by the SQL condition
    ``is_query``, their nearest other rows found, by inner product, ties to the smaller vec_id.

    Vectors that are null, zero, of an odd length, or hold a null or a value that is not
    finite take no part, neither do rows without vec_id. Rows of equal vec_id are candidates
    each, but not of a query of that id.
    """
    rows = _valid(table)
    total, fields = rows.count(), "query_id long, rank int, vec_id long, score double"
    if not total:
        return table.sparkSession.createDataFrame([], fields)
    steps = 1 << 30
    chosen = rows.where(F.pmod(F.xxhash64("vec_id", F.lit("forest")), F.lit(steps)) < min(steps, SAMPLE * steps // total))
    sample = [r.vector for r in chosen.orderBy("vec_id").collect()] or [rows.first().vector]
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    largest = rows.agg(F.max(square).alias("largest")).first().largest
    forest = [grow(lifted(np.array(sample), largest), seed) for seed in range(trees)]
    blocks = -(-total // BLOCK)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch.column(1))
                leaves = np.stack([tree.leaves(lifted(vectors, largest)) for tree in forest], axis=1)
                listed = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(vectors) + 1) * len(forest), pa.int32()),
                    pa.array(leaves.reshape(-1), pa.int32()),
                )
                yield pa.RecordBatch.from_arrays([*batch.columns, listed], names=["vec_id", "vector", "leaves"])

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                plans = []
                for vector in _matrix(batch.column(1)):
                    leaves = opened(aimed(vector, largest), forest, amount)
                    plans.append([n * 65536 + leaf for n, x in enumerate(leaves) for leaf in x])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(plans, pa.list_(pa.int32()))], names=["vec_id", "vector", "plan"]
                )

    queries = rows.where(is_query)
    query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    dealt = lambda name, n, other, m: (
        F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int").alias(name),
        F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other),
    )
    index = rows.mapInArrow(place, "vec_id long, vector array<double>, leaves array<int>").select(
        "*", *dealt("block", blocks, "query_block", query_blocks)
    )
    plans = queries.mapInArrow(plan, "vec_id long, vector array<double>, plan array<int>").select(
        "*", *dealt("query_block", query_blocks, "block", blocks)
    )
    best = (
        plans.groupBy("block", "query_block").cogroup(index.groupBy("block", "query_block"))
        .applyInPandas(lambda q, v: _nearest(q, v, count), "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = written(best, "nearest").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _nearest(queries: pd.DataFrame, vectors: pd.DataFrame, count: int) -> pd.DataFrame:
    """The best candidates of a block of vectors for a block of queries."""
    none = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
    if not len(queries) or not len(vectors):
        return none
    points, asked = np.stack(vectors["vector"]), np.stack(queries["vector"])
    ids, query_ids = vectors["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
    leaves = np.stack(vectors["leaves"])
    wants: dict[int, list[int]] = {}
    for number, plan in enumerate(queries["plan"]):
        for leaf in plan:
            wants.setdefault(int(leaf), []).append(number)
    scores = np.full((len(asked), len(points)), -np.inf, np.float32)
    for tree in range(leaves.shape[1]):
        order = np.argsort(leaves[:, tree], kind="stable")
        held, starts = np.unique(leaves[order, tree], return_index=True)
        for leaf, members in zip(held.tolist(), np.split(order, starts[1:]), strict=True):
            askers = wants.get(tree * 65536 + leaf)
            if askers:
                scores[np.ix_(askers, members)] = asked[askers] @ points[members].T
    out = []
    for number, row in enumerate(scores):
        row[ids == query_ids[number]] = -np.inf
        found = np.flatnonzero(row > -np.inf)
        if len(found) > count:
            # Rounding must not decide: what is as good as the last within it stays in.
            last = np.partition(row[found], len(found) - count)[len(found) - count]
            found = found[row[found] >= last - 1e-5 * max(1.0, abs(float(last)))]
        exact = products(points[found], np.broadcast_to(asked[number], (len(found), asked.shape[1])))
        keep = np.lexsort((ids[found], -exact))[:count]
        out.append(pd.DataFrame({"query_id": query_ids[number], "vec_id": ids[found][keep], "score": exact[keep]}))
    return pd.concat([none, *out])
