"""Bounded samples of labelled rows to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The most labelled rows that a classifier is fitted on, those with the smallest hashes of their ids.
SAMPLE = 20_000


def fold(key: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo: the same row is in the same fold everywhere (null: null)."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % modulus


def sample(docs: DataFrame, labels: DataFrame, label: str, key: str, modulus: int | None, held: int | None, most: int = SAMPLE) -> DataFrame:
    """At most so many rows of docs with their label as __label (0 or 1), without the held-out fold; a row a label row."""
    usable = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    if modulus is not None:
        usable = usable.where(fold(key, modulus) != held)
    picked = usable.groupBy(key).agg(F.max(F.col(label).cast("int")).alias("__label")).orderBy(F.xxhash64(key), key).limit(most).withColumnRenamed(key, "__key")
    # at most SAMPLE rows of two numbers, so they may go to every executor
    return docs.join(F.broadcast(picked), F.col(key) == F.col("__key")).drop("__key")
