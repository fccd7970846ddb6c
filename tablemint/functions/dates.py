"""Dates and casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, number_or_null, trimmed

SHORT_DATE = r"^(\d{1,2})/(\d{1,2})/(\d{2,4})$"
US_DATETIME = r"^(\d{2})/(\d{2})/(\d{4})\s+(\d{2}:\d{2}:\d{2})$"


def us_datetime_to_iso(value: Column | str) -> Column:
    """``01/23/2026 15:41:51`` to ISO; anything else unchanged.  No calendar check."""
    value = _col(value)
    text = trimmed(value)
    return F.when(
        text.rlike(US_DATETIME), F.regexp_replace(text, US_DATETIME, r"$3-$1-$2T$4")
    ).otherwise(value)


def iso_date(value: Column | str) -> Column:
    """``1/23/26`` to ``2026-01-23``; two-digit years are of this century; else null."""
    text = trimmed(value)
    month, day, year = (F.regexp_extract(text, SHORT_DATE, i) for i in (1, 2, 3))
    full_year = F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year)
    return F.when(
        text.rlike(SHORT_DATE),
        F.concat_ws("-", full_year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")),
    )


def iso_datetime(value: Column | str) -> Column:
    """A date or date-time text as ISO in UTC; a date alone is its midnight."""
    text = trimmed(value)
    parsed = F.to_utc_timestamp(F.try_to_timestamp(text), F.current_timezone())
    return F.when(
        text.rlike(r"^\d{4}-\d{2}-\d{2}$") & text.try_cast("date").isNotNull(),
        F.concat(text, F.lit("T00:00:00Z")),
    ).otherwise(F.date_format(parsed, "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def cast_as(value: Column | str, kind: str) -> Column:
    """Cast a text value to one of the four declared kinds; unreadable is null."""
    value = _col(value)
    if kind == "number":
        return number_or_null(value)
    if kind == "string":
        return value.cast("string")
    if kind == "boolean":
        text = F.lower(trimmed(value))
        return F.when(text == "true", F.lit(True)).when(text == "false", F.lit(False))
    if kind == "datetime":
        return iso_datetime(value)
    raise ValueError(f"unknown cast {kind!r}")
