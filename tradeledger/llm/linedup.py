"""Line deduplication by winnowing over line hashes. DataFrame functions only.

Hashes of two consecutive lines are winnowed: of every two in a row the least is a fingerprint, so any
run of three lines that occurs twice has a common one. Fingerprints found at several positions are
joined back, and the match is extended both ways by the runs of three lines around them; overlapping
runs make up matches of any length. A long line is a run of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeledger.llm.batches import pick
from tradeledger.llm.textrules import BLANKS, let
from tradeledger.session import cut_lineage

#: Lines per hash, hashes per window; their sum less one is the shortest run that is always found.
GRAM, WINDOW = 2, 2

#: Words from which a line alone counts as a run.
LONG_LINE = 25


def _lines(text: Column) -> Column:
    """Lines with a word: place among all lines, hash without outer blanks, number of words."""
    every = F.transform(
        F.split(text, "\n"),
        lambda line, i: let(
            F.btrim(line, F.lit(BLANKS)),
            lambda t: F.struct(
                i.alias("i"),
                F.xxhash64(t).alias("h"),
                F.when(t == "", 0).otherwise(F.size(F.split(t, r"[\x20\x09-\x0D]+"))).alias("words"),
            ),
        ),
    )
    return F.filter(every, lambda x: x["words"] > 0)


def _runs(lines: Column, n: int) -> Column:
    """Hash and places of every n lines in a row."""
    def run(s: Column) -> Column:
        part = F.slice(lines, s + 1, n)
        return F.struct(
            F.xxhash64(F.transform(part, lambda x: x["h"])).alias("h"), F.transform(part, lambda x: x["i"]).alias("at")
        )

    empty = F.array().cast("array<struct<h:bigint,at:array<int>>>")
    return F.when(F.size(lines) < n, empty).otherwise(F.transform(F.sequence(F.lit(0), F.size(lines) - n), run))


def _fingerprints(grams: Column, runs: Column) -> Column:
    """Window minima (the rightmost of equal ones), each with the runs that hold it."""
    def window(s: Column) -> Column:
        part = F.transform(F.slice(grams, s + 1, WINDOW), lambda g, i: F.struct(g["h"].alias("h"), (-(s + i)).alias("p")))
        return F.array_min(part)

    span = GRAM + WINDOW - 1 - GRAM
    chosen = F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(grams) - WINDOW), window))

    def with_runs(x: Column) -> Column:
        first = F.greatest(-x["p"] - span, F.lit(0))
        return F.struct(x["h"].alias("h"), F.slice(runs, first + 1, -x["p"] - first + 1).alias("runs"))

    empty = F.array().cast("array<struct<h:bigint,runs:array<struct<h:bigint,at:array<int>>>>>")
    return F.when(F.size(grams) < WINDOW, empty).otherwise(F.transform(chosen, with_runs))


def repeated_runs(docs: DataFrame, long_line: int = LONG_LINE) -> DataFrame:
    """(id, key, places): lines that lie in a run which occurs earlier, per text; ``docs`` has id, key and text."""
    shortest = GRAM + WINDOW - 1

    def parts(lines: Column) -> Column:
        long_ones = F.transform(
            F.filter(lines, lambda x: x["words"] >= long_line),
            lambda x: F.struct(F.xxhash64(x["h"], F.lit("line")).alias("h"), F.array(x["i"]).alias("at")),
        )
        prints = let(
            F.struct(_runs(lines, GRAM).alias("g"), _runs(lines, shortest).alias("r")),
            lambda both: _fingerprints(both["g"], both["r"]),
        )
        return F.struct(long_ones.alias("long_ones"), prints.alias("prints"))

    rows = docs.select("id", "key", let(_lines(F.col("text")), parts).alias("p"))
    rows = cut_lineage(rows.where((F.size("p.long_ones") > 0) | (F.size("p.prints") > 0)))
    prints = rows.select("id", "key", F.explode("p.prints").alias("f")).select("id", "key", F.col("f.h").alias("f"), "f.runs")
    shared = prints.groupBy("f").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("f")
    zones = prints.join(shared, "f", "left_semi").select("id", "key", F.explode("runs").alias("r"))
    alone = rows.select("id", "key", F.explode("p.long_ones").alias("r"))
    runs = zones.union(alone).select("id", "key", F.col("r.h").alias("h"), F.col("r.at").alias("at")).distinct()
    # Documents are ordered by id, those without one come last; then by text hash.
    place = F.struct(F.col("id").isNull().alias("none"), "id", "key", F.col("at")[0].alias("line"))
    found = runs.withColumn("place", place)
    first = found.groupBy("h").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = found.join(first, "h").where("place <> first")
    return later.groupBy("id", "key").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("places"))


def remove_repeated_lines(
    docs: DataFrame, id_column: str = "doc_id", long_line: int = LONG_LINE, drop_emptied: bool = False
) -> DataFrame:
    """Rows of docs with ``text`` less its repeated lines, and n_lines and n_removed.

    A line goes if it lies in three consecutive lines (or is one of ``long_line`` words or more) that
    occur earlier: in a document of smaller id, or further up in the same text. Blank lines are passed
    over and stay; outer blanks of a line do not count; runs are compared by 64-bit hashes. Rows of the
    same id and text are one document and judged alike, rows without id come last. A NULL text stays
    NULL with no lines. With ``drop_emptied`` rows that lose every word are dropped. Columns named
    n_lines or n_removed are replaced.
    """
    others = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    rows = pick(docs, *others).withColumn("key_", F.xxhash64("text"))
    texts = rows.where(F.col("text").isNotNull()).select(F.col(id_column).alias("id"), F.col("key_").alias("key"), "text")
    later = repeated_runs(texts, long_line).toDF("id_", "hash_", "places_")
    on = F.col(id_column).eqNullSafe(F.col("id_")) & (F.col("key_") == F.col("hash_"))
    met = rows.join(later, on, "left")
    lines = F.split("text", "\n")
    left = let(
        lines,
        lambda x: F.array_join(
            F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("places_")), lambda i: F.get(x, i)), "\n"
        ),
    )
    changed = F.col("places_").isNotNull()
    out = met.select(
        *[F.when(changed, left).otherwise(F.col("text")).alias(c) if c == "text" else F.col(f"`{c}`") for c in others],
        F.coalesce(F.size(lines), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("places_"), F.lit(0)).cast("bigint").alias("n_removed"),
    )
    if drop_emptied:
        out = out.where((F.col("n_removed") == 0) | (F.translate("text", BLANKS, "") != ""))
    return out
