"""Hierarchies and succession chains by recursive queries; what goes deeper than the cap is an error, rows have no limit."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_DEPTH = 64


def _no_row_limit(df: DataFrame) -> None:
    """Spark stops recursive queries at a million rows otherwise; it reads the setting when the query runs."""
    df.sparkSession.conf.set("spark.sql.cteRecursionRowLimit", "-1")


def hierarchy(nodes: DataFrame, key: str, parent: str, max_depth: int = MAX_DEPTH) -> DataFrame:
    """node, root, depth and path of every node below a root; a node whose parent is missing is a root, cycles are not reached."""
    _no_row_limit(nodes)
    name = f"nodes_{uuid.uuid4().hex}"
    known = nodes.select(F.col(key).alias("__known")).distinct()
    tagged = nodes.select(F.col(key).alias("node"), F.col(parent).alias("parent")).join(known, F.col("parent") == F.col("__known"), "left")
    tagged.withColumn("is_root", F.col("__known").isNull()).drop("__known").createOrReplaceTempView(name)
    return nodes.sparkSession.sql(
        f"""WITH RECURSIVE tree MAX RECURSION LEVEL {max_depth + 2} AS (
          SELECT node, node AS root, 0 AS depth, CAST(node AS STRING) AS path FROM {name} WHERE is_root
          UNION ALL
          SELECT n.node, t.root, t.depth + 1, concat(t.path, '/', CAST(n.node AS STRING)) FROM tree t JOIN {name} n ON n.parent = t.node
          WHERE NOT n.is_root)
        SELECT node, root, depth, path FROM tree"""
    )


def succession_edges(rows: DataFrame, key: str, successor: str, predecessors: str) -> DataFrame:
    """src -> dst for every successor and every predecessor turned round, each once."""
    ahead = rows.where(F.col(successor).isNotNull()).select(F.col(key).alias("src"), F.col(successor).alias("dst"))
    back = rows.select(F.explode(predecessors).alias("src"), F.col(key).alias("dst"))
    return ahead.unionByName(back).distinct()


def chains(edges: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """start, node and steps of everything reached from each node without a predecessor."""
    _no_row_limit(edges)
    name = f"edges_{uuid.uuid4().hex}"
    edges.select("src", "dst").createOrReplaceTempView(name)
    return edges.sparkSession.sql(
        f"""WITH RECURSIVE walk MAX RECURSION LEVEL {max_depth + 2} AS (
          SELECT DISTINCT e.src AS start, e.src AS node, 0 AS steps FROM {name} e LEFT ANTI JOIN {name} p ON p.dst = e.src
          UNION ALL
          SELECT w.start, e.dst, w.steps + 1 FROM walk w JOIN {name} e ON e.src = w.node)
        SELECT start, node, steps FROM walk"""
    )
