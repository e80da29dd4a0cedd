"""Dates as ISO text."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_date(value: Column, pattern: str | Sequence[str | None] | None = None) -> Column:
    """``yyyy-MM-dd`` of a date, a timestamp or text; unreadable text fails.

    A date cast to text is in this form; it costs less than a formatter. With several
    patterns each cell is read by the first that fits it, so a column may hold dates of
    mixed forms; None among them is the ISO form, with or without a time of day.
    """
    if pattern is None or isinstance(pattern, str):
        moment = F.to_timestamp(value, pattern) if pattern else value.cast("timestamp_ntz")
        return moment.cast("date").cast("string")
    text = value.cast("string")
    tries = [
        (F.try_to_timestamp(text, F.lit(p)) if p else text.try_cast("timestamp_ntz")).cast("date") for p in pattern
    ]
    said = F.concat(F.lit("no date: "), text)
    found = F.coalesce(*tries, F.raise_error(said).cast("date"))
    return F.when(text.isNotNull(), found).cast("string")


def load_date(value: str | date) -> str:
    """A load date as ISO text; raises ``ValueError`` if it is no date."""
    return (value if isinstance(value, date) else date.fromisoformat(value)).strftime("%Y-%m-%d")


def load_calendar(first: str, last: str, every: str = "month") -> list[str]:
    """Load dates from the first to the last, for a backfill: each day, or each
    first of a month."""
    start, end = date.fromisoformat(first), date.fromisoformat(last)
    days = (start + timedelta(n) for n in range((end - start).days + 1))
    if every not in ("day", "month"):
        raise ValueError(f"every must be day or month, not {every}")
    return [load_date(day) for day in days if every == "day" or day.day == 1]
