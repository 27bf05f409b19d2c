"""Registered queries of the text operators, over whole tables, and their check SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeledger.llm import alignment, decontaminate, exactdedup, lexical, linedup, neardup, packing, quality, repeats, secrets, textrules, toxicity, urlrules
from tradeledger.llm.batches import prepare
from tradeledger.llm.checks import CHECKS
from tradeledger.session import apply_skew_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[Callable[[str], DataFrame]], DataFrame]):
    """Register a function of a table reader under its own name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        apply_skew_settings(spark)
        prepare(spark)
        return fn(lambda name: spark.read.parquet(f"{folder}/{name}.parquet"))

    QUERIES[fn.__name__] = run
    return fn


def tokenizer_definition() -> str:
    """The public tokenizer's JSON; ``TOKENIZER_PATH`` names another file of its kind."""
    import public_tokenizers

    path = os.environ.get("TOKENIZER_PATH") or public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        return file.read()


@query
def op1_decontaminate(read) -> DataFrame:
    found = decontaminate.find_items(read("documents"), read("benchmark"), gram=10, keep=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


@query
def op2_pack(read) -> DataFrame:
    packed = packing.pack_with_steps(read("documents"), tokenizer_definition())
    return packed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step"
    )


@query
def op3_secrets(read) -> DataFrame:
    found = secrets.scan_secrets(read("documents"))

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def listed(column):
        return F.array_join(
            F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    base = listed(F.filter("secrets", lambda s: s["kind"] != "opaque"))
    live = F.size(F.filter("secrets", lambda s: s["live"])).cast("bigint").alias("n_live")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(base.cast("binary"), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"), live,
    )


@query
def op4_neardup(read) -> DataFrame:
    found = neardup.near_duplicates(read("documents"), words=3, num=85, den=100)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op5_quality(read) -> DataFrame:
    scored = quality.score_quality(read("documents"), read("labels"), keep=["doc_id"])
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op6_urls(read) -> DataFrame:
    return urlrules.judge_urls(read("pages")).select("page_id", "host", "path", "rule", "verdict")


@query
def op7_textrules(read) -> DataFrame:
    return textrules.judge_texts(read("documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


@query
def op8_linedup(read) -> DataFrame:
    left = linedup.remove_repeated_lines(read("documents"))
    sha = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    return left.select("doc_id", "n_lines", "n_removed", sha)


@query
def op9_repeats(read) -> DataFrame:
    return repeats.remove_repeats(read("documents"), digest=True)


@query
def op10_toxicity(read) -> DataFrame:
    scored = toxicity.score_toxicity(read("documents"), read("labels"), keep=["doc_id"])
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op11_exact(read) -> DataFrame:
    return exactdedup.exact_duplicates(read("documents"))


@query
def op12_search(read) -> DataFrame:
    return lexical.rank_documents(read("documents"), read("benchmark"))


@query
def op13_align(read) -> DataFrame:
    first, second = alignment.tokenizer_files()
    return alignment.align_tokens(read("documents"), first, second, digest=True)
