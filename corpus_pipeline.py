"""The corpus pipeline: quality, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir); its rows are written as Parquet and read again for the next
one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeledger.llm.batches import prepare
from tradeledger.llm.decontaminate import find_items
from tradeledger.llm.linedup import remove_repeated_lines
from tradeledger.llm.neardup import keep_one
from tradeledger.llm.packing import pack_with_steps
from tradeledger.llm.quality import score_quality
from tradeledger.llm.queries import tokenizer_definition
from tradeledger.session import apply_skew_settings, cut_lineage

#: Votes and descents of the learned stages have no SQL form.
ORACLE_SQL = None


#: Columns that the stages read or change; others are carried along under names of no operator's own.
OWN = ("doc_id", "text", "lang", "source", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _set_up(spark: SparkSession) -> None:
    apply_skew_settings(spark)
    prepare(spark)


def filtering(stage: Stage) -> Stage:
    """A stage that returns the columns of its documents, whatever further columns these have."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _set_up(spark)
        names = [c if c in OWN else f"extra_{i}" for i, c in enumerate(docs.columns)]
        kept = stage(spark, docs.toDF(*names), sf_dir)
        return kept.select(*names).toDF(*docs.columns)

    return run_stage


@filtering
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier, learned from the labels of these documents, does not reject.

    NULL and empty texts get the share of label 1 among the labelled sample as score (0.5 without labels);
    repeated rows are judged alike. An empty table gives none.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_quality(docs, labels).where("predicted = 1")


@filtering
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of earlier runs; texts left without a word go. n_chars follows the text.

    A NULL text stays NULL, an empty one stays. Rows of one id and text are one document and lose the same lines;
    a NULL id comes last. An empty table gives none.
    """
    left = remove_repeated_lines(docs, drop_emptied=True)
    return left.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else left


@filtering
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word shingles that are 0.8 alike: that of the smallest id.

    Rows without words, NULL texts among them, belong to no group and stay. Of rows repeated with one id
    one stays. Ids are integers, a NULL id comes last. An empty table gives none.
    """
    return keep_one(docs)


@filtering
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words of a benchmark item.

    NULL and empty texts have no words and stay, repeated rows stay or go together. Items without words, or no
    items, remove nothing. An empty table gives none.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_items(docs, items).where("not contaminated")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenized documents in full sequences, with step groups.

    A NULL or empty text is the end id alone, repeated rows are packed each, a NULL id stays NULL. Columns
    beside id and text are not read. An empty table gives none.
    """
    _set_up(spark)
    return pack_with_steps(docs, tokenizer_definition())


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
