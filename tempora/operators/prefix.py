"""Running sums over a whole table without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that a range should have, and the fewest and the most ranges.
RANGE_ROWS = 4_000_000
LEAST, MOST = 64, 4096


def range_number(value: Column, cuts: list[float]) -> Column:
    """How many of the cuts (in order) are no larger than a value, by two searches of about the root of their number."""
    if not cuts:
        return F.lit(0)
    width = max(1, round(len(cuts) ** 0.5))
    rows = [cuts[k : k + width] for k in range(0, len(cuts), width)]
    below = lambda array: F.size(F.filter(array, lambda c: c <= value))
    row = below(F.array(*(F.lit(r[0]) for r in rows)))
    within = F.get(F.array(*(F.array(*map(F.lit, r)) for r in rows)), row - 1)
    return F.when(row > 0, (row - 1) * width + below(within)).otherwise(0)


def sum_before(rows: DataFrame, order: str, value: str, output: str = "before", parts: int | None = None, tie: tuple[str, ...] = ()) -> DataFrame:
    """rows with the sum of value over all rows that come earlier by a numeric order column.

    Approximate quantiles cut the order into ranges (the cut values are part of the plan, so a retry deals rows alike), more of them
    for more rows; a window runs inside each range, and the sums of the ranges before are joined on. Nulls of the order come first.
    """
    parts = parts or min(MOST, max(LEAST, -(-rows.count() // RANGE_ROWS)))
    cuts = sorted(set(rows.where(F.col(order).isNotNull()).approxQuantile(order, [k / parts for k in range(1, parts)], 0.2 / parts))) if parts > 1 else []
    dealt = rows.withColumn("__range", F.coalesce(range_number(F.col(order).cast("double"), cuts), F.lit(0)))
    inside = Window.partitionBy("__range").orderBy(F.col(order).asc_nulls_first(), *tie).rowsBetween(Window.unboundedPreceding, -1)
    per_range = dealt.groupBy(F.col("__range").alias("__r")).agg(F.sum(value).alias("__sum"))
    offsets = per_range.select("__r", F.sum("__sum").over(Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)).alias("__offset"))
    # as many rows as ranges, so every task may have them
    joined = dealt.join(F.broadcast(offsets), F.col("__range") == F.col("__r"))
    kind = rows.schema[value].dataType
    zero = F.lit(0).cast(kind)
    total = F.coalesce(F.sum(value).over(inside), zero) + F.coalesce("__offset", zero)
    return joined.withColumn(output, total).drop("__range", "__r", "__offset")
