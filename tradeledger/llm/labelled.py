"""Labelled rows for training: a bounded sample, and which rows are held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeledger.llm.batches import pick


def held_out(id_column: str, folds: int, fold: int) -> Column:
    """Rows whose crc32 of the id as text has this remainder; a row without id is not held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % folds == fold, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, bound: int) -> DataFrame:
    """(doc_id, text, y) of at most ``bound`` labelled rows that are not held out.

    The ids of smallest hash are taken, so the sample does not depend on order or partitions. A
    repeated id counts once, with the larger of its labels; ids without text are left out.
    """
    known = pick(labels, "doc_id", label).where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.where(~held_out("doc_id", folds, fold)).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    texts = pick(docs, "doc_id", "text").where(F.col("text").isNotNull())
    # The chosen ids are at most ``bound`` rows.
    return texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
