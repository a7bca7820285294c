"""Quality rules over the register, their report, and differences of snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stats import duplicate_keys, holders_per_post, seat_overflow

ERROR, WARNING = "error", "warning"


def orphans(rows: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key is not among the parents' (null keys are no orphans)."""
    p = parents.select(F.col(parent_key).alias("__parent")).distinct()
    return rows.where(F.col(key).isNotNull()).join(p, F.col(key) == F.col("__parent"), "left_anti")


def referenced(rows: DataFrame, key: str, children: DataFrame, child_key: str) -> DataFrame:
    """Rows that some child names."""
    c = children.select(F.col(child_key).alias("__child"))
    return rows.join(c, F.col(key) == F.col("__child"), "left_semi")


def parent_child(rows: DataFrame, key: str, parent: str, *columns: str) -> DataFrame:
    """Child and parent rows side by side: key, parent and the parent's columns as parent_*."""
    p = rows.select(F.col(key).alias("__p"), *[F.col(c).alias(f"parent_{c}") for c in columns])
    return rows.join(p, F.col(parent) == F.col("__p")).drop("__p")


def issue(rows: DataFrame, severity: str, rule: str, entity: str, key: Column | str, message: Column | str) -> DataFrame:
    k = F.col(key) if isinstance(key, str) else key
    m = F.lit(message) if isinstance(message, str) else message
    return rows.select(F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), F.lit(entity).alias("entity"), k.cast("string").alias("key"), m.alias("message"))


def all_issues(orgs: DataFrame, persons: DataFrame, posts: DataFrame, mandates: DataFrame) -> DataFrame:
    """Cross-record rules: severity, rule, entity, key, message. A row an issue; nothing is collected."""
    m = mandates.withColumn("place", F.concat_ws("#", "person_id", F.col("pos").cast("string")))
    found = [
        issue(orphans(m, "organization_id", orgs, "id"), WARNING, "mandate-org-missing", "mandate", "place", F.col("organization_id")),
        issue(orphans(m, "post_id", posts, "id"), WARNING, "mandate-post-missing", "mandate", "place", F.col("post_id")),
        issue(orphans(posts, "organization_id", orgs, "id"), WARNING, "post-org-missing", "post", "id", F.col("organization_id")),
        issue(orphans(orgs, "parent_id", orgs, "id"), WARNING, "org-parent-missing", "organisation", "id", F.col("parent_id")),
        issue(orphans(orgs, "successor_id", orgs, "id"), WARNING, "org-successor-missing", "organisation", "id", F.col("successor_id")),
        issue(m.where("end_date < start_date"), ERROR, "mandate-ends-before-start", "mandate", "place", F.col("mandate_id")),
        issue(duplicate_keys(orgs, "id"), ERROR, "org-id-repeated", "organisation", "id", F.col("n").cast("string")),
        issue(duplicate_keys(persons, "id"), ERROR, "person-id-repeated", "person", "id", F.col("n").cast("string")),
        issue(duplicate_keys(posts, "id"), ERROR, "post-id-repeated", "post", "id", F.col("n").cast("string")),
        issue(duplicate_keys(m, "mandate_id"), WARNING, "mandate-id-repeated", "mandate", "mandate_id", F.col("n").cast("string")),
        issue(duplicate_keys(persons.select(F.col("identifiers.wikidata").alias("wikidata")), "wikidata"), WARNING, "wikidata-repeated", "person", "wikidata", F.col("n").cast("string")),
        issue(seat_overflow(holders_per_post(posts.withColumnRenamed("id", "post_id"), m)), WARNING, "post-seats-exceeded", "post", "post_id", F.concat_ws(" of ", F.col("holders").cast("string"), F.col("seat_count").cast("string"))),
    ]
    p = posts.select(F.col("id").alias("__post"), F.to_date(F.nullif(F.col("valid_from"), F.lit(""))).alias("__from"))
    early = m.join(p, F.col("post_id") == F.col("__post")).where("start_date < __from")
    found.append(issue(early, WARNING, "mandate-before-post", "mandate", "place", F.col("start_date").cast("string")))
    return reduce(DataFrame.unionByName, found)


def report(issues: DataFrame) -> DataFrame:
    return issues.groupBy("severity", "rule").agg(F.count("*").alias("n"))


def exit_code(issues: DataFrame, strict: bool = False) -> int:
    """1 if there is an error, or under strict any issue; else 0."""
    wanted = issues if strict else issues.where(F.col("severity") == ERROR)
    return int(not wanted.isEmpty())


def row_hash(df: DataFrame, *without: str) -> Column:
    """SHA-256 of a row's columns by name; nulls count."""
    row = F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns) if c not in without])
    return F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256)


def snapshot_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """key and change (added, removed, changed) of rows that differ between two snapshots; a null key is a key like others."""
    a = old.select(F.col(key).alias("__a"), row_hash(old).alias("__x"))
    b = new.select(F.col(key).alias("__b"), row_hash(new).alias("__y"))
    joined = a.join(b, F.col("__a").eqNullSafe(F.col("__b")), "full_outer")
    change = F.when(F.col("__x").isNull(), "added").when(F.col("__y").isNull(), "removed").when(F.col("__x") != F.col("__y"), "changed")
    return joined.select(F.coalesce("__a", "__b").alias(key), change.alias("change")).where("change is not null")


def added_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys of new that old has not as often."""
    return new.select(key).exceptAll(old.select(key))
