"""The training-data pipeline over ``documents``: each stage is one operator of ``ledgerspark.llm`` and works on all that the
stage before it kept. Every stage but the last returns the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerspark.llm import bpe, exact_dedup, jaccard_join, mixing, toxicity
from ledgerspark.llm.catalog import tokenizer
from ledgerspark.llm.common import ARROW_ROWS, documents, drop_table, few_rows, materialize
from ledgerspark.session import table


def bounded(spark: SparkSession) -> None:
    """Arrow batches of few rows in this session from here on. A stage that passes whole texts through Python runs when its result
    is written, after it has returned."""
    spark.conf.set(ARROW_ROWS, few_rows(spark))


def toxic_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (it learns from the labelled documents among ``docs``)."""
    bounded(spark)
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels"), holdout=None))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return exact_dedup.drop_exact_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: five-word shingles, similarity 0.8 or more."""
    return jaccard_join.one_of_each_class(docs, words=5, threshold=80)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.emit(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian 32-bit), ids_sha256, decoded_sha256 per emitted document."""
    bounded(spark)
    return bpe.encode_documents(docs, tokenizer("word_bpe_49k.json"), ids=True, decoded=False)


STAGES = [("toxicity", toxic_stage), ("exact_dedup", exact_stage), ("ngram_jaccard_join", near_stage),
          ("mixing", mix_stage), ("bpe", encode_stage)]

#: The first and last stages are a trained classifier and a BPE encoder: not SQL. ``tests/llm/test_pipeline.py`` holds every stage
#: against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is written as Parquet and read again as the next stage's documents."""
    docs = documents(spark, sf_dir)
    before = None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            drop_table(before)  # its only reader is written
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
