"""Batched web impressions unnested to one row per impression."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeledger.functions.dates import local_day_bounds, local_time
from tradeledger.functions.text import null_if_blank

# Sections that show listings, the one that shows deals, and the one without products.
LISTING_SECTIONS = [
    "Deals Nearby",
    "Delivery Services",
    "Dispensary Storefronts",
    "Doctors",
    "Mail Order / Delivery Services",
    "CBD Stores",
]
DEAL_SECTION = "Deals Nearby"
BRAND_ONLY_SECTION = "Featured Brands"

IMPRESSION_FIELDS = [
    "section_name",
    "listing_id",
    "listing_type",
    "deal_id",
    "brand_id",
    "product_id",
    "position",
]


def batches_of_days(batches: DataFrame, first: dt.date, end: dt.date, tz: str) -> DataFrame:
    """Batches of the local days ``[first, end)``; the bounds are on the raw column."""
    low, high = local_day_bounds(first, end, tz)
    return batches.filter((F.col("batch_time") >= low) & (F.col("batch_time") < high))


def event_rows(time_field: str = "timestamp") -> Column:
    """The events text as an array; NULL where it is no valid JSON array."""
    fields = ",".join(f"`{name}`: string" for name in [*IMPRESSION_FIELDS, time_field])
    return F.from_json("events", f"array<struct<{fields}>>")


def malformed_batches(batches: DataFrame, location: str | None = "Home", time_field: str = "timestamp") -> DataFrame:
    """Batches whose events cannot be read, which ``impression_flatten`` has no rows for."""
    chosen = batches if location is None else batches.filter(F.col("location") == location)
    return chosen.filter(F.col("events").isNotNull() & event_rows(time_field).isNull())


def impression_flatten(
    batches: DataFrame,
    location: str | None = "Home",
    tz: str = "America/Los_Angeles",
    platform: str = "Web",
    keep: Sequence[str] = (),
    time_field: str = "timestamp",
) -> DataFrame:
    """One row per impression; which ids are kept depends on the section.

    ``keep`` names further batch columns to carry along, ``time_field`` the key of the ISO time.

    The array is parsed as JSON, so its size, field order and nested values do not matter.
    A missing key gives NULL. Batches that are no JSON array have no rows here; they are those of
    ``malformed_batches``.
    """
    chosen = batches if location is None else batches.filter(F.col("location") == location)
    shared = [*keep, "anonymous_id", "location", "region_name"]
    one = chosen.select(*shared, event_rows(time_field).alias("_all")).select(
        *shared, F.posexplode("_all").alias("impression_index", "_one")
    )
    section = F.col("_one.section_name")
    listed = section.isin(LISTING_SECTIONS)

    def only(condition: Column, field: str) -> Column:
        return F.when(condition, null_if_blank(F.col(f"_one.{field}")))

    # Zone marks are cut off: the text is UTC and the result zone-free.
    iso = F.regexp_replace(F.regexp_replace(F.col("_one")[time_field], "T", " "), "Z$", "")
    shown_at = iso.try_cast("timestamp_ntz")
    return one.select(
        *keep,
        local_time(shown_at, tz).alias("impression_time"),
        F.lit(platform).alias("platform"),
        "anonymous_id",
        "location",
        "region_name",
        "impression_index",
        section.alias("section_name"),
        only(listed, "listing_id").alias("listing_id"),
        only(listed, "listing_type").alias("listing_type"),
        only(section == DEAL_SECTION, "deal_id").alias("deal_id"),
        only(~listed, "brand_id").alias("brand_id"),
        only(~listed & (section != BRAND_ONLY_SECTION), "product_id").alias("product_id"),
        F.col("_one.position").alias("section_position"),
    )
