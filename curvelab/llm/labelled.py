"""Bounded training samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelab.llm.common import in_remainder


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, max_rows: int) -> DataFrame:
    """(doc_id, text, y) of at most ``max_rows`` labelled documents outside the held-out remainder.

    The sample is the labelled ids with the smallest hashes.  It is chosen on the label
    table alone, so the documents are scanned once against a side of at most ``max_rows``
    ids and never shuffled.  Rows whose label or doc_id is null do not count; an id with
    several labels takes the largest; of equal texts one row stays."""
    ids = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~in_remainder("doc_id", modulus, held_out))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    return rows.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("y").alias("y")).select("doc_id", "text", "y")
