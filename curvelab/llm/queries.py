"""Registered queries of this subpackage: each operator over its whole table, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvelab.llm import (
    chat,
    decontamination,
    hamming,
    language,
    main_text,
    minhash,
    negatives,
    packing,
    quality,
    token_counts,
    token_files,
    toxicity,
    vector_codes,
)
from curvelab.llm.common import in_remainder, table
from curvelab.llm.pieces import vocabulary_path

WORD_VOCABULARY, BYTE_VOCABULARY = "word_bpe_49k.json", "byte_bpe_50k.json"
END_ID = 2


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut, placed = packing.pack(table(spark, sf_dir, "documents"), vocabulary_path(WORD_VOCABULARY), END_ID)
    return placed.join(packing.piece_digests(cut), ["part", "piece"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary_path(WORD_VOCABULARY))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    text = main_text.extract(pages, main_text.train(pages))
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scores.select(
        "doc_id",
        in_remainder("doc_id", 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op7_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_preferences(chat.following_pairs(table(spark, sf_dir, "conversations")))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return scores.select(
        "doc_id",
        in_remainder("doc_id", 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op9_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming.linked_vectors(table(spark, sf_dir, "embeddings"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest, folder = token_files.token_files(table(spark, sf_dir, "documents"), vocabulary_path(BYTE_VOCABULARY), END_ID)
    return token_files.read_token_files(manifest, folder, with_ids=False)


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language.train(docs))
    return found.select("doc_id", in_remainder("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return negatives.hard_negatives(vectors.select("vec_id", "embedding", moved.alias("label")))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.product_codes(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_minhash_dedup,
        op2_packing,
        op3_token_counts,
        op4_main_text,
        op5_decontamination,
        op6_toxicity,
        op7_preference_format,
        op8_quality,
        op9_vector_dedup,
        op10_token_files,
        op11_language_id,
        op12_hard_negatives,
        op13_vector_codes,
    )
}
