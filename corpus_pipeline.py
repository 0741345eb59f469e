"""A training corpus from raw documents: five stages, each one operator of folio.llm.

``run`` writes each stage's documents as Parquet in the shared folder and gives them to the next.
All stages but the last return the columns of ``documents``; the last returns each kept document's
token count and the digests of its ids and of the bytes they decode to.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from folio.llm.bpe import RANKS, bpe_digests
from folio.llm.common import documents, small_batches, stored
from folio.llm.decontam import drop_contaminated
from folio.llm.langid import keep_identified
from folio.llm.ngram_join import keep_one
from folio.llm.quality import keep_good


#: Near copies share 80 % of their five-word n-grams (op10 has bounds of its own).
NEAR_WORDS = 5
NEAR_SHARE = (80, 100)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fitted quality rules keep (cases: ``folio.llm.quality.keep_good``)."""
    small_batches(spark)
    return keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words belong to a language (cases: ``folio.llm.langid.keep_identified``)."""
    small_batches(spark)
    return keep_identified(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by n-grams of ``NEAR_WORDS`` words (cases: ``folio.llm.ngram_join.keep_one``)."""
    small_batches(spark)
    return keep_one(docs, NEAR_WORDS, *NEAR_SHARE)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark (cases: ``folio.llm.decontam.drop_contaminated``)."""
    small_batches(spark)
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of every document left (cases: ``folio.llm.bpe.bpe_digests``)."""
    small_batches(spark)
    return bpe_digests(docs, public_tokenizers.path(RANKS))


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_level_bpe", byte_level_bpe),
]

#: The vote model, the CRF and the BPE merges have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` of those kept.

    Defined cases: null, empty and white-space texts fail the quality rules; repeated rows and near copies leave one; null ids
    may stay; an empty table gives no rows; extra columns pass through all stages but the last.
    """
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
