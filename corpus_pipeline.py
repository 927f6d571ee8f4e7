"""A training-corpus pipeline over ``documents``: filter, deduplicate, decontaminate, pack.

Each stage takes the documents that its predecessor kept, written and read again, and
returns the documents that it keeps, with their columns; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curvelab.llm import decontamination, minhash, packing, quality, toxicity
from curvelab.llm.common import staged, table
from curvelab.llm.pieces import vocabulary_path
from curvelab.llm.queries import END_ID, WORD_VOCABULARY
from curvelab.session import prepare


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject (score below 0.5)."""
    prepare(spark)
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (score of 0.7 or more)."""
    prepare(spark)
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near duplicates (five-word
    shingles, similarity of 0.8 or more)."""
    prepare(spark)
    return minhash.keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    prepare(spark)
    return decontamination.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, placed in sequences of 4096 tokens."""
    prepare(spark)
    _, placed = packing.pack(docs, vocabulary_path(WORD_VOCABULARY), END_ID)
    return placed.select("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "sequence_tokens")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: The stages hold trained models and a tokenizer, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written before the next reads it."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
