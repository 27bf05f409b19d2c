"""Exact duplicates by a tree merge of sorted digest runs.

Each input partition sorts the digests of its rows into a run: one entry per text, with the number of
rows and the row that stays. In each round ``fan`` neighbouring runs meet in one of the next level, so
every text of a run has at most ``fan`` entries to merge, however many copies the corpus holds. The
merge keeps the entry that stays, as each level did before it. Entries of the top level with more than one
row then go back down the same tree, run by run, to the rows.

A run is dealt over tasks by (run, digest) and sorted there, so no task holds a whole run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeledger.llm.batches import pick
from tradeledger.session import cut_lineage

#: White space that does not count, as a pattern.
BLANKS = r"[\x20\x09-\x0D]+"

#: Runs that meet in one round.
FAN = 16

# What makes two texts the same: SHA-256, and a hash of another kind that verifies it.
_TEXT = ["digest", "proof"]


def digest_rows(docs: DataFrame, id_column: str, keep: Sequence[str]) -> DataFrame:
    """One written row per row of docs: row, run, digest, proof, chars, id, and the kept columns."""
    kept = [c for c in dict.fromkeys(keep) if c not in (id_column, "text")]
    rows = pick(docs, id_column, "text", *kept)
    names = [f"k{i}" for i in range(len(kept))]
    rows = rows.toDF("id", "text", *names)
    whole = F.coalesce("text", F.lit(""))
    plain = rows.withColumn("plain", F.regexp_replace(whole, BLANKS, ""))
    return cut_lineage(
        plain.select(
            F.monotonically_increasing_id().alias("row"),
            F.spark_partition_id().alias("run"),
            F.unhex(F.sha2(F.col("plain").cast("binary"), 256)).alias("digest"),
            F.xxhash64("plain").alias("proof"),
            F.length(whole).cast("bigint").alias("chars"),
            "id",
            *(["text"] if "text" in keep else []),
            *names,
        )
    )


def _merged(entries: DataFrame, stays: Column, rows: Column) -> DataFrame:
    """One entry per run and text: the row that stays and the number of rows."""
    return entries.groupBy("run", *_TEXT).agg(F.min(stays).alias("stays"), F.sum(rows).alias("rows"))


def _above(run: Column, fan: int) -> Column:
    return F.floor(run / fan).cast("int")


def merge_runs(rows: DataFrame, fan: int = FAN) -> list[DataFrame]:
    """The levels of the tree over written digest rows, each written; the last holds a single run."""
    # Most code points first, then the smallest id; a NULL id comes last, and of repeated rows the first stays.
    order = F.struct((-F.col("chars")).alias("less"), F.col("id").isNull().alias("unnamed"), "id", "row")
    levels = [cut_lineage(_merged(rows, order, F.lit(1)))]
    runs = (rows.agg(F.max("run")).first()[0] or 0) + 1
    while runs > 1:
        met = levels[-1].withColumn("run", _above(F.col("run"), fan))
        levels.append(cut_lineage(_merged(met, F.col("stays"), F.col("rows"))))
        runs = -(-runs // fan)
    return levels


def repeated_entries(levels: list[DataFrame], fan: int = FAN) -> DataFrame:
    """(run, text, stays, rows) of the lowest level's entries whose text more than one row of the corpus has."""
    found = levels[-1].where("rows > 1")
    for level in reversed(levels[:-1]):
        entries = level.select("run", *_TEXT, _above(F.col("run"), fan).alias("above"))
        found = entries.join(found.withColumnRenamed("run", "above"), ["above", *_TEXT])
        found = found.select("run", *_TEXT, "stays", "rows")
    return found


def exact_duplicates(
    docs: DataFrame, id_column: str = "doc_id", keep: Sequence[str] = (), fan: int = FAN
) -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, text_sha256, and the columns ``keep``.

    Texts are equal when they are identical without the characters of ``BLANKS``; a NULL text counts as
    empty, and empty texts equal each other. Of equal texts the row with the most code points stays, then
    the one with the smallest id; a NULL id comes after all others, and of rows repeated with one id and
    length a single one stays. Kept columns named like a result column are left out, columns that clash
    with each other are not read. An empty table gives an empty result. With ``keep`` naming the text,
    the rows with ``kept`` are the de-duplicated table.

    Every join and merge is by (run, text): at most ``fan`` entries meet, and in the last join the
    rows of one input partition.
    """
    if fan < 2:
        raise ValueError("at least two runs must meet in a round")
    result = {id_column.lower(), "keep_id", "group_size", "kept", "text_sha256"}
    keep = [c for c in dict.fromkeys(keep) if c.lower() not in result]
    rows = digest_rows(docs, id_column, keep)
    several = repeated_entries(merge_runs(rows, fan), fan)
    met = rows.join(several, ["run", *_TEXT], "left")
    alone = F.col("rows").isNull()
    others = [c for c in keep if c != "text"]
    return met.select(
        F.col("id").alias(id_column),
        F.when(alone, F.col("id")).otherwise(F.col("stays.id")).alias("keep_id"),
        F.coalesce("rows", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("stays.row") == F.col("row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        *[F.col(f"k{others.index(c)}" if c in others else c).alias(c) for c in keep],
    )
