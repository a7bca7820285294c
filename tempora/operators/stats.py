"""Counts, groups, rankings and their ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import DEFAULT_GROUP
from .temporal import is_current


def holders_per_post(posts: DataFrame, mandates: DataFrame, post_id: str = "post_id", mandate_id: str = "mandate_id", end: str = "end_date") -> DataFrame:
    """posts with the number of current mandates; 0 for posts without any.

    Mandates are counted per post before the join, so the join meets one row a post and a post that a third of all mandates name is
    no burden.
    """
    counts = mandates.where(F.col(mandate_id).isNotNull()).groupBy(F.col(post_id).alias("__post")).agg(F.count_if(is_current(end)).alias("holders"))
    return posts.join(counts, F.col(post_id) == F.col("__post"), "left").drop("__post").withColumn("holders", F.coalesce("holders", F.lit(0)).cast("long"))


def count_by(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n"))


def count_with_total(rows: DataFrame, key: str) -> DataFrame:
    """A row a group and one with a null group for all."""
    return rows.rollup(key).agg(F.count("*").alias("n"), F.grouping(key).cast("int").alias("is_total"))


def count_by_default(rows: DataFrame, key: str, default: str = DEFAULT_GROUP) -> DataFrame:
    """Groups by a key, null ones under a default; an empty text is a group of its own."""
    return rows.groupBy(F.coalesce(F.col(key), F.lit(default)).alias(key)).agg(F.count("*").alias("n"))


def distinct_values(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(key).distinct()


def members(rows: DataFrame, key: str, value: str, output: str = "members") -> DataFrame:
    """The values of each group as a sorted array. Arrays grow with their group: join on the key instead where a group may be large."""
    return rows.groupBy(key).agg(F.sort_array(F.collect_list(value)).alias(output))


def top_by_count(rows: DataFrame, key: str, n: int, end: str = "end_date") -> DataFrame:
    """The n keys with most rows, ties to the smaller key: rank, key, total and current."""
    counted = rows.groupBy(key).agg(F.count("*").alias("total"), F.count_if(is_current(end)).alias("current"))
    best = counted.orderBy(F.col("total").desc(), F.col(key)).limit(n)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.col("total").desc(), F.col(key))))  # n rows


def crosstab(rows: DataFrame, key: str, by: str, values: list) -> DataFrame:
    """Counts of each stated value of by for each key; naming the values saves a pass."""
    return rows.groupBy(key).agg(*[F.count_if(F.col(by) == v).alias(str(v)) for v in values])


def duplicate_keys(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.where(F.coalesce(*[F.col(k).cast("string") for k in keys]).isNotNull()).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def seat_overflow(posts_with_holders: DataFrame, seats: str = "seat_count") -> DataFrame:
    """Posts with more holders than seats; no number of seats is no limit."""
    return posts_with_holders.where(F.col("holders") > F.col(seats))


def freshness(sources: DataFrame, source: str = "source_id", retrieved: str = "retrieved") -> DataFrame:
    return sources.groupBy(source).agg(F.count("*").alias("n"), F.max(retrieved).alias("latest"))


def dutch_order(label: Column | str) -> Column:
    """Sorts as Dutch does; for display only, joins stay binary."""
    return F.collate(F.col(label) if isinstance(label, str) else label, "nl")


def joined_list(rows: DataFrame, key: str, value: str, order: str, separator: str = " · ") -> DataFrame:
    """The values of a group in order, with a separator before all but the first."""
    ordered = F.array_sort(F.collect_list(F.struct(order, value)))
    return rows.groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x[value].cast("string")), separator).alias("list"))
