"""Connected components by alternating star contractions, all rows on the executors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import stash


#: Edges (16 bytes each) that one task may hold.
TASK_EDGES = 4_000_000


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct nodes of some edges and the smallest node that each is connected to."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return nodes, nodes[label]
        low = np.minimum(x, y)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while (label[label] != label).any():
            label = label[label]


def _forest(batches):
    """Stars that connect what the edges of this task connect, TASK_EDGES at a time."""
    held, n = [], 0

    def stars():
        nodes, root = roots(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]))
        off = nodes != root
        return nodes[off], root[off]

    for batch in batches:
        held.append((batch["u"].to_numpy(), batch["v"].to_numpy()))
        n += len(batch)
        if n > TASK_EDGES:
            held = [stars()]
            n = len(held[0][0])
            if n > TASK_EDGES // 2:
                yield pa.RecordBatch.from_pydict({"u": held[0][0], "v": held[0][1]})
                held, n = [], 0
    if n:
        u, v = stars()
        yield pa.RecordBatch.from_pydict({"u": u, "v": v})


def components(edges: DataFrame) -> DataFrame:
    """edges (a long, b long) -> (node long, root long), root the smallest node of the component; for every node with an edge to another.

    First every task replaces its edges by stars. When no more than TASK_EDGES are left a task does so once more, and that is the
    result. Otherwise the rounds below go on over all tasks.

    Each round links the larger neighbours of a node to its smallest neighbour, then the smaller ones; the edges end as stars
    around the roots after about log2(nodes) rounds. Minima are combined before the shuffle, so a node that a third of all edges
    share costs no task more; the joins back are plain equi-joins, whose large keys Spark splits.
    """
    now = stash(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").mapInArrow(_forest, "u long, v long"))
    mark = (now.count(), None)
    while True:
        if mark[0] <= TASK_EDGES:
            now = stash(now.coalesce(1).mapInArrow(_forest, "u long, v long"))
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stash(small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        last, mark = mark, tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == last:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
