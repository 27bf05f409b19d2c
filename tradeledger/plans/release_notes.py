"""Upload lines cross-checked with release and product notes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeledger.sources.write import materialise_stage

LINE = ["product_name", "release_name", "release_version", "part_number", "release_notes", "product_notes"]


def annotated_uploads(uploads: DataFrame, releases: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct upload lines of every file with the notes of their release and product.

    Keys are compared column by column (missing equals missing). Notes are combined and made distinct before
    they meet the lines, which are distinct too, so the joined rows are and need not be gathered again.
    """
    release = releases.select("releasename", "releaseversion", "productname", "rmnotes").distinct().alias("r")
    product = products.select("productname", "rmnotes").distinct()
    notes = (
        release.join(product.alias("p"), F.col("r.productname").eqNullSafe(F.col("p.productname")), "left")
        .select(
            "r.releasename",
            "r.releaseversion",
            F.col("p.productname").alias("product_name"),
            F.col("r.rmnotes").alias("release_notes"),
            F.col("p.rmnotes").alias("product_notes"),
            F.lit(True).alias("released"),
        )
        .distinct()
        .alias("n")
    )
    same_release = F.col("u.release_name").eqNullSafe(F.col("n.releasename")) & F.col(
        "u.release_version"
    ).eqNullSafe(F.col("n.releaseversion"))
    # A line without release misses the product's name, as products without name do.
    nameless = product.filter("productname is null").alias("p")
    line = (
        uploads.select("source_file", "release_name", "release_version", "part_number").distinct().alias("u")
    )
    return (
        line.join(notes, same_release, "left")
        .join(nameless, F.col("n.released").isNull(), "left")
        .select(
            "u.source_file",
            "n.product_name",
            "u.release_name",
            "u.release_version",
            "u.part_number",
            "n.release_notes",
            F.coalesce("n.product_notes", "p.rmnotes").alias("product_notes"),
        )
    )


def noted_lines(annotated: DataFrame) -> DataFrame:
    """Lines with a release note or a product note."""
    return annotated.filter(F.col("release_notes").isNotNull() | F.col("product_notes").isNotNull())


def release_note_crosscheck(uploads: DataFrame, releases: DataFrame, products: DataFrame) -> dict[str, DataFrame]:
    """Result tables per file: lines with notes, all annotated lines, the uploads themselves."""
    annotated = materialise_stage(annotated_uploads(uploads, releases, products))
    return {"lines_with_notes": noted_lines(annotated), "annotated": annotated, "uploads": uploads}
