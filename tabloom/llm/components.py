"""Connected components of a distributed edge list: union-find inside partitions, then alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.scratch import materialize

#: Links that one task may hold for union-find (some 100 MB).
TASK_LINKS = 500_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) for all nodes that aren't the smallest of their component, by union-find with path halving."""
    nodes, codes = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = np.arange(len(nodes)).tolist()

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    codes = codes.tolist()
    half = len(a)
    for x, y in zip(codes[:half], codes[half:], strict=True):
        x, y = find(x), find(y)
        if x != y:  # nodes are sorted, so the smaller code is the smaller node
            parent[max(x, y)] = min(x, y)
    roots = np.array([find(x) for x in range(len(nodes))], np.int64)
    below = roots != np.arange(len(nodes))
    return nodes[below], nodes[roots[below]]


def _local(most: int):
    """A forest of every ``most`` links or so of a partition; what is linked stays linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch in _ended(batches):
            if batch is not None and batch.num_rows:
                held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
                total += batch.num_rows
            if held and (batch is None or total >= most):
                nodes, roots = forest(*(np.concatenate([h[i] for h in held]) for i in (0, 1)))
                held, total = [], 0
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["a", "b"])

    return run


def _ended(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def components(edges: DataFrame, most_rounds: int = 60, task_links: int = TASK_LINKS, keep=materialize) -> DataFrame:
    """``edges`` (a, b long, no nulls) to (node, component): the smallest node of each component, for all nodes that are not it.

    Partitions reduce their links to forests first. What is left is finished by one more union-find if it is few enough for
    a task, and else by rounds of alternating stars. There a node with very many edges is joined by its key, which adaptive execution can split; no neighbourhood is collected. Each
    round is written by ``keep``; rounds grow with the logarithm of the components' sizes.
    """
    down = lambda df: df.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = down(edges).repartition("b").mapInArrow(_local(task_links), "a long, b long")
    now = keep(links, "components")
    seen = _print(now)
    if 0 < seen[0] <= task_links:
        now = keep(now.coalesce(1).mapInArrow(_local(2 * task_links), "a long, b long"), "components")
        return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    now = now.distinct()
    for _ in range(most_rounds):
        if seen[0] == 0 or not _deeper(now):
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        now = keep(_small(_large(now)), "components")
        seen, last = _print(now), seen
        if seen == last:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    raise RuntimeError("components did not settle")


def _print(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return r.n, r.s


def _deeper(edges: DataFrame) -> bool:
    """Whether the edges are not yet stars: a node has two parents, or a parent has one."""
    twice = edges.groupBy("a").count().where("count > 1").limit(1)
    chained = edges.select("b").distinct().join(edges.select(F.col("a").alias("b")), "b", "left_semi").limit(1)
    return bool(twice.take(1)) or bool(chained.take(1))


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the smallest of its neighbours and itself."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours go to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
