"""From raw documents to token ids: five stages, each an operator of tempora.llm over all that the stage before it kept.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame; run() writes each as Parquet in the shared folder, reads it
again for the next, and deletes it when that is written. All but the last return the columns of documents.

Defined results: without labels every document scores 0.5 and stays; null and empty texts have the score of an empty text, stay in near
dedup one by one, lose nothing, and have size 0 and no pieces; rows that repeat are one group, so one of them stays; nulls in other columns
and columns named like those that operators add pass unchanged (but piece_ids); an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm import minhash, mixing, pieces, quality, storage, substring


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores 0.5 or more; fitted on a bounded sample of the labelled documents that are left."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model, output="__score").where("__score >= 0.5").drop("__score")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, of the smallest id, of each group of near duplicates."""
    return minhash.keep_first(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words under windows of 35 words that occur twice or more; other texts stay as they are."""
    kept = substring.remove_repeats(docs, prefix="__")
    n_chars = F.when(F.col("__n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", n_chars).select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often (0, 1 or 2 times) as the mix of sources takes it."""
    return mixing.mix(docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with sampled piece ids that decode to their texts."""
    import public_tokenizers

    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", quality_filter),
    ("near dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("source mixing", mix_sources),
    ("sentencepiece", to_pieces),
]

#: Consistent samples, trees and lattices are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, storage.settled(spark, lambda s=stage, d=docs: s(spark, d, sf_dir))
        if k:
            storage.discard(before)
        storage.release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
