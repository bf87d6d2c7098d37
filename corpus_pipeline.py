"""Training corpus from documents: five stages, each written as Parquet.

toxicity (documents scored 0.5 or more go), near_duplicates (one document of
each group stays), personal_data (spans are replaced by marks), mixing
(documents are dropped or repeated to reach the target weights), packing
(pieces of sequences of at most 2048 ids).  All but the last return the columns
of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from navforge.llm.common import Scratch, release_shuffles, table
from navforge.llm.minhash_dedup import near_duplicates
from navforge.llm.mixing import mix_to_targets
from navforge.llm.packing import pack_sequences
from navforge.llm.pii import find_personal_data, fit_personal_data
from navforge.llm.queries import (
    MIX_TARGETS, labelled_domains, tokenizer_path, tokenizer_ranks,
)
from navforge.llm.toxicity import fit_labels, score_toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5 (empty texts included)."""
    model = fit_labels(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model, "__toxicity").filter("__toxicity < 0.5").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates (5-word
    shingles, 0.8).  Rows that share a doc_id are one document, and one of them that
    is kept stays, with words if there is one; rows without id all stay."""
    groups = near_duplicates(docs, words=5, per_cent=80, text_hash=True)
    stay = groups.filter("kept").groupBy("doc_id").agg(
        F.min_by("text_hash", F.struct(F.col("n_shingles") == 0, "text_hash")).alias("__hash"))
    rest = docs.join(stay, "doc_id")
    other = F.xxhash64(F.col("text").cast("binary")) != F.col("__hash")
    one = W.partitionBy("doc_id").orderBy(other)
    rest = rest.withColumn("__nth", F.row_number().over(one)).filter("__nth = 1")
    return rest.select(docs.columns).unionByName(docs.filter("doc_id is null"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; personal data in their text is replaced by [EMAIL], [IP], [CARD], [PHONE]."""
    found = find_personal_data(docs, fit_personal_data(docs), redact=True)
    text = F.when(F.col("text").isNotNull(), F.col("redacted_text"))
    out = found.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture to MIX_TARGETS takes them (never, once, or more)."""
    labelled = labelled_domains(docs, table(spark, sf_dir, "labels"))
    mixed = mix_to_targets(docs, labelled, MIX_TARGETS)
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return mixed.filter("copies > 0").withColumn("__copy", times).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    return pack_sequences(docs, tokenizer_path(), ranks=tokenizer_ranks(), with_ids=False)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_dedup),
    ("personal_data", personal_data),
    ("mixing", mixing),
    ("packing", packing),
]

#: Compression, tokenizers and message passing have no SQL; the tests compare with
#: brute-force versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, applied to ``documents``."""
    scratch = Scratch(spark, "corpus")
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)  # the stage after it has been written
        before = name
        release_shuffles(spark)
    return docs
