"""The registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import (bpe, chat, exact_dedup, hard_negatives, jaccard_join, merkle, mixing, pii, substring_dedup, suffix_array, token_files, topk, toxicity)
from ledgerspark.llm.common import documents, materialize, public_id
from ledgerspark.session import table


def tokenizer(name: str) -> str:
    """Path of a public tokenizer file (the vocabularies are installed beside Python on every machine)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_array.suffix_array_dedup(documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(documents(spark, sf_dir), words=4, threshold=85)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted", "threshold", "rejected")


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(odd).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(extra)
    out = chat.format_conversations(rows)
    turns = chat.read_turns(F.col("formatted"))
    loss = chat.loss_text(F.col("formatted"), F.col("loss"))
    told = F.array_join(F.transform(F.col("turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    out = out.select("tree", F.col("formatted"), turns.alias("turns"), loss.alias("said"))
    return out.select(public_id("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
                      F.char_length("said").cast("long").alias("loss_chars"), F.sha2(F.col("said").cast("binary"), 256).alias("loss_sha256"),
                      F.char_length("formatted").cast("long").alias("formatted_chars"))


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_table(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_documents(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"), ids=False, decoded=False)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_proofs(documents(spark, sf_dir))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.turned_labels(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_table(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_substring_dedup, op3_mixing, op4_suffix_array_dedup, op5_ngram_jaccard_join,
                                   op6_toxicity, op7_chat_formatting, op8_exact_topk, op9_token_files, op10_bpe, op11_merkle_manifest, op12_hard_negatives,
                                   op13_pii)}
ORACLES = {"op1_exact_dedup": exact_dedup.ORACLE, "op3_mixing": mixing.ORACLE, "op7_chat_formatting": chat.ORACLE, "op8_exact_topk": topk.ORACLE,
           "op11_merkle_manifest": merkle.ORACLE, "op12_hard_negatives": hard_negatives.ORACLE}
