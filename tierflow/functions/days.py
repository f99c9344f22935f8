"""Calendar days as expressions. Ids: FN-14, FN-15, FN-16, PRJ-4, PRJ-5, SNK-2."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

Day = date | str


def iso(day: Day) -> str:
    return day.isoformat() if isinstance(day, date) else str(day)


def shifted(day: Day, by: int) -> str:
    """The day so many days later, as ISO text."""
    return (date.fromisoformat(iso(day)[:10]) + timedelta(days=by)).isoformat()


def in_window(column: str | Column, first: Day | None, last: Day | None) -> Column:
    """Inclusive day window; a missing bound is open.

    The upper bound is the next day's start, so times inside the last day count,
    be the column a day, a timestamp or ISO text of either.
    """
    value = F.col(column) if isinstance(column, str) else column
    inside = F.lit(True)
    if first is not None:
        inside = inside & (value >= F.lit(iso(first)))
    if last is not None:
        inside = inside & (value < F.lit(shifted(last, 1)))
    return inside


def in_days(column: str | Column, days: Iterable[Day]) -> Column:
    """Membership in an explicit day list."""
    value = F.col(column) if isinstance(column, str) else column
    return value.isin([iso(day) for day in days])


def calendar_days(first: Column, last: Column) -> Column:
    """Array of the days in the window, empty when it is reversed.

    An unguarded ``sequence`` counts down when its bounds are reversed.
    """
    return F.when(
        first <= last, F.sequence(first, last, F.expr("interval 1 day"))
    ).otherwise(F.array().cast("array<date>"))


def listed_days(text: str | Column) -> Column:
    """Array of trimmed, non-blank entries of a comma-joined day list."""
    value = F.col(text) if isinstance(text, str) else text
    return F.filter(
        F.transform(F.split(value, ","), lambda piece: F.trim(piece)),
        lambda piece: piece != "",
    )
