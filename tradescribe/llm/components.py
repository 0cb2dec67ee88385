"""Connected components of a graph that only Spark's tables hold.

Alternating large-star and small-star steps (Kiveris et al., 2014) turn every
component into a star around its smallest vertex in about log(n) rounds.  Before
the first round, each task turns what its own links connect into stars, a bounded
number of links at a time, which shortens long chains.  A vertex may carry any share of the links: its smallest neighbour is a partial
aggregate, and it meets the links again in a join whose two sides are read from
tables, which adaptive execution may split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tradescribe.llm.tables import ship_package, stored

# Links that a task contracts at once.
CONTRACTED = 1_000_000


class UnionFind:
    """Sets of the numbers 0 to n-1 inside one task."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        """Whether a and b were in different sets."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def contracted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (u, v) of each vertex u with the smallest vertex v that it reaches by the links (a, b), u itself left out."""
    ids, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    forest = UnionFind(len(ids))
    for i, j in np.unique(np.stack([places[: len(a)], places[len(a) :]], axis=1), axis=0).tolist():
        forest.join(i, j)
    roots = np.array([forest.root(i) for i in range(len(ids))], dtype=np.int64)
    moved = roots != np.arange(len(ids))
    return ids[moved], ids[roots[moved]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def links(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        ends = [np.concatenate([batch[name].to_numpy() for batch in held]) for name in ("a", "b")]
        u, v = contracted(*ends)
        return pa.RecordBatch.from_pydict({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= CONTRACTED:
            yield links(held)
            held, n = [], 0
    if held:
        yield links(held)


def _star(neighbours: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each vertex u to the smallest of them and u.

    The large star gives at most as many links as it gets, so only the small one
    takes out repeated links.
    """
    least = stored(
        neighbours.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "components-least"
    )
    linked = neighbours.join(least, "u")
    if large:
        links = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        links = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            least.select("u", F.col("m").alias("v"))
        )
    links = links.where(F.col("u") != F.col("v"))
    return stored(links if large else links.distinct(), "components-links")


def _all_stars(edges: DataFrame) -> bool:
    """Whether no vertex u has two smaller neighbours, or a smaller and a greater one."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), "v").unionAll(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(None).cast("long").alias("v"))
    )
    seen = ends.groupBy("x").agg(
        F.max("up").alias("up"), F.min("up").alias("down"), F.min("v").alias("first"), F.max("v").alias("last")
    )
    chained = (F.col("up") == 1) & ((F.col("down") == 0) | (F.col("first") < F.col("last")))
    return seen.where(chained).count() == 0


def components(links: DataFrame) -> DataFrame:
    """(id, component_id) of every vertex of links(a, b), both long; component_id is the smallest vertex reached.

    Links with a null end, of a vertex with itself and repeated links change nothing.
    """
    ship_package(links.sparkSession)
    known = links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    # Links often come out of Python; stored first, so that no task runs two Python workers at once.
    known = stored(known.select("a", "b"), "components-found")
    edges = stored(known.mapInArrow(_contracted, "u long, v long"), "components-links")
    while not _all_stars(edges):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = _star(_star(both, large=True), large=False)
    # Tasks may have found the same link.
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionAll(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component_id"))
    ).distinct()
