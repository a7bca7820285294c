"""Sets that change by additions and removals, and bursts of changes of which the last counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def members_after(changes: DataFrame, group: str, member: str, added: str, order: str) -> DataFrame:
    """group and member of all that are in a set after its changes, in their order: the last change of a member decides."""
    last = changes.groupBy(group, member).agg(F.max_by(F.col(added), F.col(order)).alias("__in"))
    return last.where("__in").select(group, member)


def debounced(changes: DataFrame, key: str, at: str, wait: str, order: str) -> DataFrame:
    """The changes that no other of their key follows within wait: what a writer that waits so long after each would write."""
    following = Window.partitionBy(key).orderBy(at, order)
    rows = changes.withColumn("__next", F.lead(at).over(following))
    return rows.where(F.col("__next").isNull() | (F.col("__next") >= F.col(at) + F.expr(f"interval {wait}"))).drop("__next")
