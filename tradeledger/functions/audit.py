"""Values out of audit rows: JSON of changed fields, and recurrence rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradeledger.functions.text import null_if_blank


def json_path_text(json: Column, key: str) -> Column:
    """Value of a top-level key as text; NULL when the key is absent."""
    return F.get_json_object(json, f"$.{key}")


def changed_fields(json: Column) -> Column:
    """All changed fields as a map of texts, so that the JSON is parsed once for several fields."""
    return F.from_json(json, "map<string,string>")


def _element(fields: Column, key: str, index: int) -> tuple[Column, Column]:
    """The field as text, and one element of it if it is an ``[old, new]`` array."""
    whole = F.try_element_at(fields, F.lit(key))
    return whole, null_if_blank(F.get(F.from_json(whole, "array<string>"), F.lit(index)))


def new_value(fields: Column, key: str) -> Column:
    """New value of a field: second element of ``[old, new]``, or the plain value of a create row."""
    whole, second = _element(fields, key, 1)
    return F.when(whole.startswith("["), second).otherwise(null_if_blank(whole))


def old_value(fields: Column, key: str) -> Column:
    """First element of ``[old, new]``; NULL on create rows."""
    whole, first = _element(fields, key, 0)
    return F.when(whole.startswith("["), first)


def audit_new_value(json: Column, key: str) -> Column:
    return new_value(changed_fields(json), key)


def audit_old_value(json: Column, key: str) -> Column:
    return old_value(changed_fields(json), key)


def rrule_frequency(rule: Column) -> Column:
    return (
        F.when(F.contains(rule, F.lit("WEEKLY")), "Weekly")
        .when(F.contains(rule, F.lit("DAILY")), "Daily")
        .otherwise("One Day")
    )


def rrule_days(rule: Column) -> Column:
    """Weekday list such as ``MO,WE``; NULL when the rule has none."""
    return null_if_blank(F.regexp_extract(rule, r"BYDAY=([^;]*)", 1))


def rrule_until(rule: Column) -> Column:
    """Last date of the rule; NULL when open-ended or malformed."""
    digits = F.regexp_extract(rule, r"UNTIL=(\d{8})", 1)
    return F.try_to_timestamp(null_if_blank(digits), F.lit("yyyyMMdd")).cast("date")
