"""History rebuilt from audit rows: deals, account owners, retailer status, menu overrides."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeledger.functions.audit import (
    audit_new_value,
    changed_fields,
    new_value,
    old_value,
    rrule_days,
    rrule_frequency,
    rrule_until,
)
from tradeledger.functions.dates import local_date, local_time, month_label, month_start, ntz
from tradeledger.functions.text import number_from_text
from tradeledger.operators.intervals import (
    expand_days,
    expand_months,
    join_asof,
    latest_per_period,
    lead_intervals,
)
from tradeledger.operators.ordered import HOT_ROWS, carry, slices_needed
from tradeledger.operators.tables import decode_codes, existence_flag, left_join_hot_right, union_tagged
from tradeledger.sources.write import materialise_stage

TZ = "America/Los_Angeles"

# Retailer status codes.
STATUS_LABELS = {"0": "Pending", "1": "Approved", "2": "Rejected", "3": "Expired"}


def deal_schedules(audits: DataFrame, tz: str = TZ, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Deal schedule valid from each audit row on, with unchanged fields filled from earlier rows.

    ``own_start`` is the start date the row itself states on creation.
    """
    fields = F.col("_fields")
    parsed = audits.withColumn("_fields", changed_fields(F.col("changes"))).select(
        "deal_date_id",
        "deal_id",
        "created_at",
        "audit_id",
        local_date(F.col("created_at"), tz).alias("effective_date"),
        "action",
        new_value(fields, "listing_id").alias("listing_id"),
        new_value(fields, "listing_type").alias("listing_type"),
        F.substring(new_value(fields, "dtstart"), 1, 10).alias("day_1_start"),
        new_value(fields, "rrule").alias("rule"),
    ).withColumns(
        {"own_start": F.when(F.col("action") == "create", F.col("day_1_start")), "own_rule": F.col("rule")}
    )
    filled = ["listing_id", "listing_type", "day_1_start", "rule"]
    return carry(
        parsed,
        ["deal_date_id"],
        ["created_at", "audit_id"],
        following={"ineffective_date": "effective_date"},
        known={c: c for c in filled},
        include_current=True,
        slices=slices_needed(audits, ["deal_date_id"], hot_rows),
    )


def weekday_code(day: Column) -> Column:
    """First two letters of the weekday in lower case."""
    return F.lower(F.substring(F.date_format(day, "EEEE"), 1, 2))


def on_listed_weekday(day: Column, weekdays: Column) -> Column:
    return F.contains(weekdays, weekday_code(day))


def deal_days(
    audits: DataFrame,
    as_of: dt.date,
    days: int = 30,
    tz: str = TZ,
    literal: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Distinct (listing, day) with a deal in the ``days`` before ``as_of``.

    Weekly rules apply on their weekdays (without a list, on that of the first day), daily ones every
    day, others on the first day only; an open end is ``as_of``. ``literal`` takes creation rows only, ends open rules one day after their
    start, and gives a rule without matching weekday its first day.
    A start that is no date gives no day. Ranges are clipped to the window before they are expanded, so a rule gives at most ``days`` rows.
    """
    window_start, window_end = F.lit(as_of - dt.timedelta(days=days)), F.lit(as_of - dt.timedelta(days=1))
    schedules = deal_schedules(audits, tz, hot_rows)
    stated, rule = ("own_start", "own_rule") if literal else ("day_1_start", "rule")
    planned = (
        schedules.filter((F.col("action") != "destroy") & F.col(stated).isNotNull())
        .withColumn("frequency", rrule_frequency(F.coalesce(rule, F.lit(""))))
        .withColumn("first_day", F.col(stated).try_cast("date"))
        .withColumn("weekdays", F.lower(rrule_days(F.col(rule))))
        .withColumn("until", rrule_until(F.col(rule)))
    )
    first = F.greatest("first_day", "effective_date")
    ended = F.coalesce("ineffective_date", F.lit(as_of))
    if literal:
        last = F.least(F.coalesce("until", F.date_add("first_day", 1)), ended, window_end)
        # Weekdays repeat, so the first seven days tell whether any day of the range matches.
        week = F.when(first <= last, F.sequence(first, F.least(last, F.date_add(first, 6))))
        matches = F.coalesce(F.exists(week, lambda d: on_listed_weekday(d, F.col("weekdays"))), F.lit(False))
        marked = planned.withColumn("_matches", matches)
        matched = expand_days(marked.filter("_matches"), F.greatest(first, window_start), last)
        matched = matched.filter(on_listed_weekday(F.col("active_date"), F.col("weekdays")))
        alone = marked.filter(~F.col("_matches")).withColumn("active_date", F.col("first_day"))
        alone = alone.filter(F.col("active_date").between(window_start, window_end))
        found = matched.unionByName(alone)
    else:
        until = F.when(F.col("frequency") == "One Day", F.col("first_day")).otherwise(
            F.coalesce("until", F.lit(as_of))
        )
        spread = expand_days(planned, F.greatest(first, window_start), F.least(until, ended, window_end))
        listed = F.coalesce("weekdays", weekday_code(F.col("first_day")))
        found = spread.filter((F.col("frequency") != "Weekly") | on_listed_weekday(F.col("active_date"), listed))
    return found.select("listing_id", "listing_type", "active_date").distinct()


def deal_active_days(
    audits: DataFrame,
    as_of: dt.date,
    days: int = 30,
    tz: str = TZ,
    literal: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Active deal days per listing in the ``days`` before ``as_of``."""
    return (
        deal_days(audits, as_of, days, tz, literal, hot_rows)
        .groupBy("listing_id", "listing_type")
        .agg(F.count(F.lit(1)).alias("deals_active_past"))
    )


def owner_changes(
    accounts: DataFrame, top_levels: DataFrame, history: DataFrame, users: DataFrame
) -> DataFrame:
    """One row per top-level account and owner change, named; accounts without change have one row.

    Children of one account may be created on different days: the earliest counts.
    """
    created = (
        accounts.join(top_levels, "account_id", "left")
        .groupBy("top_level_id")
        .agg(F.min("created_at").alias("account_created"))
    )
    changes = (
        history.filter(F.col("field") == "Owner")
        .select(F.col("account_id").alias("top_level_id"), "changed_at", "old_value", "new_value")
        .distinct()
    )
    new = users.select(F.col("user_id").alias("new_value"), F.col("user_name").alias("new_name"))
    old = users.select(F.col("user_id").alias("old_value"), F.col("user_name").alias("old_name"))
    named = (
        changes.join(new, "new_value", "left")
        .join(old, "old_value", "left")
        .select(
            "top_level_id",
            "changed_at",
            F.coalesce("old_name", "old_value").alias("old_owner"),
            F.coalesce("new_name", "new_value").alias("new_owner"),
        )
        # Raw values may differ while the names agree: the repeated rows of the source.
        .distinct()
    )
    return left_join_hot_right(created, named, ["top_level_id"])


def owner_intervals(changes: DataFrame, slices: int | None = None) -> DataFrame:
    """Owner intervals: from creation to the first change, then from change to change."""
    placed = carry(
        changes,
        ["top_level_id"],
        ["changed_at", "old_owner", "new_owner"],
        following={"_next": "changed_at"},
        index="_place",
        slices=slices,
    )

    def span(condition: Column, start: str, end: str, owner: str) -> Column:
        parts = (F.col(c).alias(n) for c, n in ((start, "start_date"), (end, "end_date"), (owner, "owner")))
        return F.when(condition, F.struct(*parts))

    spans = F.array_compact(
        F.array(
            span(F.col("_place") == 1, "account_created", "changed_at", "old_owner"),
            span(F.col("changed_at").isNotNull(), "changed_at", "_next", "new_owner"),
        )
    )
    return placed.select("top_level_id", F.explode(spans).alias("_span")).select("top_level_id", "_span.*")


def account_owner_history(
    accounts: DataFrame,
    top_levels: DataFrame,
    history: DataFrame,
    users: DataFrame,
    as_of: dt.date,
    since: dt.date = dt.date(2017, 1, 1),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One owner per top-level account and month up to the last closed month."""
    slices = slices_needed(history.select(F.col("account_id").alias("top_level_id")), ["top_level_id"], hot_rows)
    intervals = owner_intervals(owner_changes(accounts, top_levels, history, users), slices)
    last_day = month_start(as_of) - dt.timedelta(days=1)
    months = expand_months(
        intervals,
        F.greatest(F.to_date("start_date"), F.lit(since)),
        F.least(F.coalesce(F.to_date("end_date"), F.lit(as_of)), F.lit(last_day)),
    )
    latest = latest_per_period(months, ["top_level_id", "month_start"], "start_date", ["end_date", "owner"])
    return latest.withColumn("year_month", F.date_format("month_start", "yyyy-MM"))


def retailer_status_history(
    retailers: DataFrame,
    audits: DataFrame,
    brand_ids: Sequence[int] | None = None,
    tz: str = TZ,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Status intervals per retailer, decoded; retailers without audit keep their current status."""
    chosen = retailers if brand_ids is None else retailers.filter(F.col("brand_id").isin(list(brand_ids)))
    value = audit_new_value(F.col("changes"), "status")
    rows = audits.filter(F.col("auditable_type") == "VerifiedRetailer").select(
        F.col("auditable_id").alias("vr_id"),
        "audit_id",
        F.col("created_at").alias("audited_at"),
        value.alias("audited_status"),
    )
    joined = left_join_hot_right(chosen, rows, ["vr_id"])
    ended = carry(
        joined,
        ["vr_id"],
        ["audited_at", "audit_id"],
        following={"_ended": "audited_at"},
        slices=slices_needed(rows, ["vr_id"], hot_rows),
    )
    status = F.coalesce("audited_status", F.col("status").cast("string"))
    return ended.select(
        "vr_id",
        F.col("status").alias("current_status"),
        "brand_id",
        "listing_id",
        "listing_type",
        F.to_date("created_at").alias("created_date"),
        local_time(F.coalesce("audited_at", "created_at"), tz).alias("start_date"),
        local_time(F.col("_ended"), tz).alias("end_date"),
        decode_codes(status, STATUS_LABELS, status).alias("status_label"),
    )


def store_entities(dispensaries: DataFrame, deliveries: DataFrame) -> DataFrame:
    return union_tagged({"Dispensary": dispensaries, "Delivery": deliveries}, "core_type")


def brand_sales_base(
    orders: DataFrame,
    order_items: DataFrame,
    listings: DataFrame,
    buyers: DataFrame,
    stores: DataFrame,
    regions: DataFrame,
    region_names: DataFrame,
    start: dt.date,
    end: dt.date,
    staff_mail: str,
    brand_ids: Sequence[int] | None = None,
    max_price: float = 50000,
    type_offset: int = 2,
    tz: str = TZ,
) -> DataFrame:
    """Revenue per order of a brand with store, region and month.

    ``start`` and ``end`` bound the local week start of the order (both inclusive).
    """
    items = order_items.filter(F.col("price") < max_price)
    if brand_ids is not None:
        items = items.filter(F.col("brand_id").isin(list(brand_ids)))
    revenue = items.groupBy("order_id").agg(F.sum(F.col("price") * F.col("amount")).alias("total_rev"))
    outside = buyers.filter(~F.contains("email", F.lit(staff_mail))).select("account_id")
    day = local_date(F.col("order_time"), tz)
    # A coarse bound on the raw column reaches the scan; the exact week test follows.
    rough = F.col("order_time").between(
        ntz(start - dt.timedelta(days=2)), ntz(end + dt.timedelta(days=9))
    )
    placed = (
        orders.filter((F.col("status") != 0) & rough)
        .withColumn("order_date", day)
        .filter(F.trunc("order_date", "week").between(F.lit(start), F.lit(end)))
    )
    shop = listings.select("listing_id", (F.col("listing_type") - type_offset).alias("order_listing_type"), "wmid")
    places = regions.join(
        region_names, F.lower("region") == F.lower("region_name")
    ).select("region_id", "region_name", "super_region")
    return (
        placed.join(shop, ["listing_id", "order_listing_type"])
        .join(outside, "account_id", "left_semi")
        .join(stores, "wmid")
        .join(places, "region_id")
        .join(revenue, "order_id")
        .select(
            "order_id",
            "order_date",
            "core_id",
            "core_type",
            "menu_override_id",
            "region_name",
            "super_region",
            F.date_format("order_date", "yyyy-MM").alias("year_month"),
            month_label(F.col("order_date")).alias("month_label"),
            "total_rev",
        )
    )


def menu_override_history(
    stores: DataFrame,
    audits: DataFrame,
    tz: str = TZ,
    min_length: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Override intervals per store from audit rows that touch the override.

    ``audits``: core_id, core_type, created_at, audit_id, action, changes. Stores without such rows
    have one row of NULLs.
    """
    touched = audits.filter(
        F.contains("changes", F.lit("menu_override_id")) & (F.col("action") != "create")
    )

    def wmid(value: Column) -> Column:
        return number_from_text(value, min_length)

    fields = F.col("_fields")
    rows = touched.withColumn("_fields", changed_fields(F.col("changes"))).select(
        "core_id",
        "core_type",
        "audit_id",
        local_time(F.col("created_at"), tz).alias("update_date"),
        wmid(old_value(fields, "menu_override_id")).alias("old_override"),
        wmid(new_value(fields, "menu_override_id")).alias("new_override"),
    )
    known = stores.select("core_id", "core_type").distinct()
    store = ["core_id", "core_type"]
    joined = left_join_hot_right(known, rows, store)
    return lead_intervals(joined, store, "update_date", ["audit_id"], "end_date", slices_needed(touched, store, hot_rows))


def sales_at_retailer_status(
    sales: DataFrame,
    overrides: DataFrame,
    status_history: DataFrame,
    stores: DataFrame,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Each sale with the override and the retailer status valid on its date.

    Both intervals are half-open. Before the first change of a store its old override holds.
    Retailers have one row per listing and brand, so the status intervals of a listing do not overlap.
    The sales are kept as a table before each lookup: the rows of their keys are counted on it.
    """
    sales = materialise_stage(sales)
    store = ["core_id", "core_type"]
    changed = materialise_stage(overrides.filter(F.col("update_date").isNotNull()))
    flagged = existence_flag(sales, changed, store, "has_audit")
    valid = join_asof(
        flagged,
        changed,
        store,
        "order_date",
        "update_date",
        "end_date",
        {
            "update_date": "update_date",
            "override_end": "end_date",
            "old_override": "old_override",
            "new_override": "new_override",
        },
        slices_needed(sales, store, hot_rows),
    )
    first = changed.groupBy(*store).agg(
        F.min_by("old_override", F.struct("update_date", "audit_id")).alias("first_override")
    )
    current = F.when(
        F.col("has_audit"),
        F.when(F.col("update_date").isNull(), F.col("first_override")).otherwise(F.col("new_override")),
    ).otherwise(F.col("menu_override_id"))
    by_wmid = stores.select(
        F.col("wmid").alias("current_override"),
        F.col("core_id").alias("override_id"),
        F.col("core_type").alias("override_type"),
    )
    placed = materialise_stage(
        valid.join(first, store, "left")
        .withColumn("current_override", current)
        .join(by_wmid, "current_override", "left")
        .withColumn("listing_id", F.coalesce("override_id", "core_id"))
        .withColumn("listing_type", F.coalesce("override_type", "core_type"))
        .drop("first_override")
    )
    listing = ["listing_id", "listing_type"]
    return join_asof(
        placed,
        status_history,
        listing,
        "order_date",
        "start_date",
        "end_date",
        {"status_start": "start_date", "status_end": "end_date", "status_label": "status_label"},
        slices_needed(placed, listing, hot_rows),
    )
