"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from navforge.llm.common import table
from navforge.llm.embedding_dedup import near_vectors
from navforge.llm.filter_audit import audit_filters
from navforge.llm.minhash_dedup import near_duplicates
from navforge.llm.mixing import mix_to_targets
from navforge.llm.oracle import SQL
from navforge.llm.packing import pack_sequences
from navforge.llm.pii import find_personal_data, fit_personal_data
from navforge.llm.pitman_yor import score_documents
from navforge.llm.resampling import importance_resample
from navforge.llm.substring_dedup import substring_dedup
from navforge.llm.token_counts import count_tokens
from navforge.llm.topk import exact_top_k
from navforge.llm.toxicity import fit_labels, held_out, score_toxicity
from navforge.llm.warc import archive_round_trip

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back as chunk rows."""
    return archive_round_trip(table(spark, sf_dir, "pages"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents left after removal of repeated 20-word windows."""
    return substring_dedup(table(spark, sf_dir, "documents"), digest=True)


def tokenizer_ranks() -> tuple[str, str]:
    """The vocabulary of byte_bpe_50k.json as ranks, and its pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


#: Shares of all words that the mixture aims at.
MIX_TARGETS = {"en": 0.48, "de": 0.17, "fr": 0.17, "es": 0.16, "junk": 0.02}


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled table of the mixture: a document's language, or junk where its
    quality label is 0."""
    return labels.select("doc_id", "quality").join(docs.select("doc_id", "lang"), "doc_id").select(
        "doc_id", F.when(F.col("quality") == 0, "junk").otherwise(F.col("lang")).alias("domain"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of all documents that bring the domains' expected words to MIX_TARGETS."""
    docs = table(spark, sf_dir, "documents")
    labelled = labelled_domains(docs, table(spark, sf_dir, "labels"))
    return mix_to_targets(docs, labelled, MIX_TARGETS).drop("text", "lang", "source", "n_chars")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of at most 2048 ids."""
    return pack_sequences(table(spark, sf_dir, "documents"), tokenizer_path(),
                          ranks=tokenizer_ranks(), with_ids=False)


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings linked at cosine 0.95, with components."""
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token counts of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, tokenizer_path("piece_bpe_32k.model")).drop("text")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_labels(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents linked at 0.8 of their 2-word shingles, with components."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=2, per_cent=80)


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best rows for every embedding whose id is divisible by 100."""
    return exact_top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_personal_data(docs, fit_personal_data(docs)).drop("text", "added")


def op11_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents, learned from those that are not held out."""
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    return score_documents(table(spark, sf_dir, "documents"), remainder == 2)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents of 20 words, drawn by their likeness to the benchmark."""
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from all documents, in every order, per language."""
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_warc, op2_substring_dedup, op3_mixing, op4_packing, op5_embedding_dedup,
        op6_token_counts, op7_toxicity, op8_minhash_dedup, op9_exact_topk, op10_personal_data,
        op11_pitman_yor, op12_importance_resampling, op13_filter_audit)}


def oracle_sql() -> dict[str, str]:
    """SQL where it can express the operator; the tests compare the others with brute force."""
    return dict(SQL)
