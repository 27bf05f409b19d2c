"""Readers: table folders, CSV extracts and sets of files."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_tables(spark: SparkSession, root: str, names: list[str]) -> dict[str, DataFrame]:
    """Named tables from one folder of Parquet files."""
    return {name: spark.read.parquet(f"{root}/{name}.parquet") for name in names}


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A CSV extract with a header row and a stated schema (no inference pass).

    A header whose names are not those of the schema, in order, is an error.
    """
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def scan_file_set(
    spark: SparkSession,
    folder: str,
    suffix: str,
    schema: T.StructType | str,
    table_hint: str | None = None,
    fallback: str | None = None,
) -> DataFrame:
    """All files of one kind below ``folder`` as one table, with ``source_file``.

    A workbook is a sub-folder with one file per sheet. ``table_hint`` keeps the sheets whose
    name contains it, even if they have a header only; workbooks without such a sheet use their
    ``fallback`` sheet ("last" or "second_to_last" by name). A header that differs from the schema
    is an error.
    """
    rows = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{suffix}")
        .csv(folder, header=True, schema=schema, enforceSchema=False)
        .withColumn("source_path", F.col("_metadata.file_path"))
    )
    parts = F.split("source_path", "/")
    sheet = F.element_at(parts, -1)
    book = F.element_at(parts, -2)
    if table_hint is None:
        return rows.withColumn("source_file", sheet).drop("source_path")
    # One row per file, then per workbook: a listing, no content is read.
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{suffix}")
        .load(folder)
        .select(F.split("_metadata.file_path", "/").alias("parts"))
    )
    sheets = files.select(F.element_at("parts", -2).alias("source_file"), F.element_at("parts", -1).alias("sheet"))
    hinted = F.filter("sheets", lambda s: s.contains(table_hint))
    position = {"last": 1, "second_to_last": 2, None: 0}[fallback]
    other = F.reverse("sheets")[position - 1] if position else F.lit(None).cast("string")
    chosen = (
        sheets.groupBy("source_file")
        .agg(F.array_sort(F.collect_set("sheet")).alias("sheets"))
        .select("source_file", F.when(F.size(hinted) > 0, hinted[0]).otherwise(other).alias("sheet"))
    )
    return (
        rows.withColumn("source_file", book)
        .withColumn("sheet", sheet)
        .join(chosen, ["source_file", "sheet"], "left_semi")
        .drop("source_path", "sheet")
    )


def stack_file_set(spark: SparkSession, folder: str, suffix: str, renames: dict[str, str] | None = None) -> DataFrame:
    """All files of one kind below ``folder`` stacked by normalised header name, as text, with ``source_file``.

    Files may differ in the order and number of their columns: they are grouped by header line, each
    layout is read once, and columns that a layout lacks are NULL. A file with a header only adds its
    columns, an empty one nothing. ``renames`` is that of ``normalise_headers``; two columns of a file
    with one normalised name are an error. Header lines hold no line breaks.
    """
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}")
    path = F.col("_metadata.file_path")
    lines = files.text(folder).select(path.alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")
    # The first block of a file lies in one partition, in order.
    numbered = lines.where("start = 0").withColumn("line", F.monotonically_increasing_id())
    headers = numbered.groupBy("path").agg(F.min_by("value", "line").alias("header"))
    layouts = headers.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("header")
    name = F.regexp_extract(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "[^/]+$", 0)
    parts = []
    # The driver holds file names, as it does for any scan; a layout is a distinct header.
    for layout in layouts.collect():
        rows = spark.read.csv([unquote(p) for p in layout["paths"]], header=True)
        found = normalise_headers(rows.withColumn("sourcefile", name), renames)
        parts.append(found.withColumnRenamed("sourcefile", "source_file"))
    return append_ragged(*parts) if parts else spark.createDataFrame([], "source_file string")


def normalise_headers(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Lower-case names without blanks and underscores; ``comments`` becomes ``notes``."""
    renames = {"comments": "notes"} if renames is None else renames
    names = []
    for name in df.columns:
        name = re.sub(r"[_ ]", "", name.lower())
        for old, new in renames.items():
            name = name.replace(old, new)
        names.append(name)
    return df.toDF(*names)


def append_ragged(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Stack tables whose columns differ; absent columns are NULL."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def inline_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small literal relation."""
    return spark.createDataFrame(rows, schema)
