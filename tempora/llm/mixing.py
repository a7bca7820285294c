"""Mixing sources to target weights by systematic sampling.

Sources in code-point order (null last) have weights WEIGHTS, repeating, and share BUDGET times the size of everything. A target
stops at CAP times its source's size; the excess goes to the others by weight until none is above its cap (water filling:
in order of cap per weight, a source is capped if its cap is below its share of what the sources before it left over).

Every row of a source has the same expected copies, target / source size. Their prefix sums run over the rows of the
source in order of size, so equal stretches of the running sum hold rows of equal size; one offset per source, drawn from its
name and the seed, is added and a row is taken once for each integer that the sum crosses. The prefix sum of a row is its rank times the
rate. Ranks come from a range partitioning and the counts of its partitions: no window holds a whole source.

Only integer sums and one division make a target, and reruns give the same rows.

Defined results: a null or empty text has size 0 and may be taken, for no words; a source of size 0 has target 0 and gives
nothing; rows that repeat share their source's copies like any rows; null ids sort first; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import identified, row_hash, stash

WEIGHTS = (3, 1, 2)
#: BUDGET is a ratio of whole numbers.
BUDGET = (3, 2)
CAP = 2


def word_count(text: str) -> Column:
    """Number of [^\\x20\\x09-\\x0D]+ in a text (null: 0)."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, source: str, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """sources (a row a source, with source_size) with its target."""
    order = Window.orderBy(F.col(source).asc_nulls_last())
    pick = F.get(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights))
    w = sources.withColumn("__w", pick.cast("long")).withColumn("__cap", F.col("source_size") * CAP)
    fill = Window.orderBy((F.col("__cap") / F.col("__w")).asc(), F.col(source).asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    w = w.withColumn("__left", BUDGET[0] * F.sum("source_size").over(every) - BUDGET[1] * F.coalesce(F.sum("__cap").over(before), F.lit(0)))
    w = w.withColumn("__rest", F.sum("__w").over(fill.rowsBetween(0, Window.unboundedFollowing)))
    # capped if cap / w < left / (BUDGET[1] * rest)
    w = w.withColumn("__full", F.col("__cap") * BUDGET[1] * F.col("__rest") < F.col("__w") * F.col("__left"))
    # the first source that is not capped sets the level of all that are not
    level = F.max_by(F.struct("__left", "__rest"), F.when(~F.col("__full"), F.col("__rest"))).over(every)
    return w.withColumn("__level", level).select(
        source,
        "source_size",
        *[c for c in sources.columns if c not in (source, "source_size")],
        F.when(F.col("__full"), F.col("__cap").cast("double")).otherwise((F.col("__w") * F.col("__level.__left")).cast("double") / (BUDGET[1] * F.col("__level.__rest")).cast("double")).alias("target"),
    )


def offset(source: str, seed: int = 0) -> Column:
    """A number in [0, 1) from a source's name: 32 bits of its SHA-256."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(source).cast("string"), F.lit("\x00")))
    return F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def mix_copies(rows: DataFrame, size: str = "size", source: str = "source", key: str = "doc_id", *, weights: tuple[int, ...] = WEIGHTS, seed: int = 0, ties: tuple[str, ...] | None = None) -> DataFrame:
    """rows with source_size, target and copies (0, 1 or 2 times the row goes into the mix). Runs jobs when it is called.

    Rows of a source are ranked by size, id and ties (by default a hash of the other columns), so only equal rows are in no fixed order."""
    base = rows.drop("source_size", "target", "copies")
    spark = rows.sparkSession
    order = [F.col(source).asc_nulls_last(), F.col(size), F.col(key)]
    others = [F.col(f"`{c}`") for c in base.columns if c not in (size, source, key)]
    order += [F.col(c) for c in ties] if ties is not None else [F.xxhash64(*(F.to_json(F.struct(c)) for c in others))] if others else []
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = stash(base)
    placed = stash(base.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__pos", F.monotonically_increasing_id()))
    placed = placed.withColumn("__part", F.shiftright("__pos", 33))
    counts = placed.groupBy(source, "__part").agg(F.min("__pos").alias("__first"), F.count("*").alias("__n"), F.sum(size).alias("__size"))
    counts = stash(counts)
    before = Window.partitionBy(source).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    per_source = targets(counts.groupBy(source).agg(F.sum("__size").alias("source_size")), source, weights).withColumn("__offset", offset(source, seed)).withColumnRenamed(source, "__of")
    joined = starts.join(per_source, F.col(source).eqNullSafe(F.col("__of"))).select(F.col(source).alias("__for"), F.col("__part").alias("__p"), "__first", "__before", "source_size", "target", "__offset")
    out = placed.join(joined, F.col(source).eqNullSafe(F.col("__for")) & (F.col("__part") == F.col("__p")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(F.lit(0.0))
    rank = F.col("__pos") - F.col("__first") + F.col("__before") + 1
    upto = lambda r: F.floor(r.cast("double") * rate + F.col("__offset"))
    copies = F.least(upto(rank) - upto(rank - 1), F.lit(CAP)).cast("int")
    return out.select(*[f"`{c}`" for c in base.columns], "source_size", "target", copies.alias("copies"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", *, weights: tuple[int, ...] = WEIGHTS, seed: int = 0) -> DataFrame:
    """The rows of docs, each as often as the mix takes it; rows that repeat are ranked one by one. Runs jobs when it is called.

    Only places of rows in their files, ids, hashes of the rows, sources and sizes are ranked; texts move once, in the join with the copies.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    placed, place = identified(docs), ("__file", "__row")
    light = placed.select(*place, row_hash(docs).alias("__whole"), F.col(f"`{key}`").alias("__key"), F.col(f"`{source}`").alias("__source"), word_count(text).alias("__size"))
    copies = mix_copies(light, "__size", "__source", "__key", weights=weights, seed=seed, ties=("__whole", *place)).where("copies > 0").select(*place, F.col("copies").alias("__copies"))
    repeated = placed.join(copies, list(place)).withColumn("__again", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return repeated.select(*columns)


#: The same in SQL. Ranks by a window, which one engine on one machine may do.
ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS BIGINT) AS w, 2 * source_size AS cap FROM s),
f AS (SELECT *, CAST(3 * sum(source_size) OVER () - 2 * coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS left_,
  CAST(sum(w) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS rest FROM w),
g AS (SELECT *, cap * 2 * rest < w * left_ AS is_full FROM f),
l AS (SELECT max(rest) AS rest, arg_max(left_, rest) AS left_ FROM g WHERE NOT is_full),
t AS (SELECT source, source_size, CASE WHEN is_full THEN cap::DOUBLE ELSE (w * l.left_)::DOUBLE / (2 * l.rest)::DOUBLE END AS target,
  ('0x' || left(sha256('0:' || coalesce(source, chr(0))), 8))::BIGINT::DOUBLE / 4294967296.0 AS u FROM g, l),
r AS (SELECT doc_id, size, t.source_size, target, u, CASE WHEN t.source_size > 0 THEN target / t.source_size::DOUBLE ELSE 0.0 END AS rate,
  row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id) AS k FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(size * least(floor(k::DOUBLE * rate + u) - floor((k - 1)::DOUBLE * rate + u), 2) AS BIGINT) AS taken FROM r
"""
