"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import mixing, substring, topk, warc


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate group of every document."""
    from .minhash import near_duplicates

    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def op2_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of documents as sampled pieces, and whether decoding them gives the text back."""
    import public_tokenizers

    from .pieces import encode

    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    back = encode(docs, model, drop_text=True, decoded="decoded")
    digest = F.sha2("decoded", 256)
    return back.select("doc_id", F.size("piece_ids").alias("n_pieces"), "piece_ids", digest.alias("decoded_sha256"), (digest == F.col("text_sha256")).alias("lossless"))


def op3_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back."""
    from .storage import shared_folder
    from .warc import read_archives, write_archives

    folder = shared_folder(spark)
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), folder)
    return read_archives(spark, folder, payload="digest").select("page_id", "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), "refers_to")


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity digests of every document and of its edited text."""
    from .fingerprint import compare_with_edits

    return compare_with_edits(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    from .quality import held_out, score, train

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), modulus=3, held=1)
    return score(docs, model).select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words under a repeated window of 35 words, removed from every text of documents."""
    from .substring import remove_repeats

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs, keep_text=False)


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector with all others."""
    from .topk import top_k

    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(rows, rows.where(F.col("vec_id") % 50 == 0), k=5)


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document a mix of all sources takes."""
    from .mixing import mix_copies, word_count

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", word_count("text").alias("size"))
    return mix_copies(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op9_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text of documents, written to wavelet-matrix shards and read back."""
    import public_tokenizers

    from .storage import shared_folder
    from .wavelet import read_digests, write_shards

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    manifest = write_shards(docs, shared_folder(spark), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_digests(manifest)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    from .quality import held_out
    from .toxicity import score, train

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), modulus=4, held=2)
    return score(docs, model).select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_sampled_pieces": op2_sampled_pieces,
    "op3_warc_archives": op3_warc_archives,
    "op4_document_fingerprints": op4_document_fingerprints,
    "op5_quality_rules": op5_quality_rules,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_top_k": op7_top_k,
    "op8_source_mixing": op8_source_mixing,
    "op9_wavelet_tokens": op9_wavelet_tokens,
    "op10_toxicity": op10_toxicity,
}

ORACLE_SQL: dict[str, str] = {
    "op3_warc_archives": warc.ORACLE_SQL,
    "op6_substring_dedup": substring.ORACLE_SQL,
    "op7_top_k": topk.ORACLE_SQL,
    "op8_source_mixing": mixing.ORACLE_SQL,
}
