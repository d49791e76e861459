"""Calendar arithmetic, epoch conversions and date ranges. All times are UTC."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Span = tuple[date, date]

#: Day numbers of 0001-01-01 and 9999-12-31.
FIRST_DAY, LAST_DAY = (day.toordinal() - date(1970, 1, 1).toordinal() for day in (date.min, date.max))


def span_of(start: date | None, end: date | None, max_days: int | None = None) -> Span | None:
    """Check an inclusive range. Both bounds or neither; ``None`` means all history.

    ``max_days`` refuses longer ranges where a caller wants that.
    """
    if start is None and end is None:
        return None
    if start is None or end is None:
        raise ValueError("give both start and end, or neither")
    if end < start:
        raise ValueError("end is before start")
    days = (end - start).days + 1
    if max_days is not None and days > max_days:
        raise ValueError(f"a range of {days} days is above the limit of {max_days}")
    return start, end


def backfill_window(anchor: date, days: int) -> Span:
    """The ``days`` days that end the day before ``anchor``."""
    if days < 1:
        raise ValueError("days must be at least 1")
    return anchor - timedelta(days=days), anchor - timedelta(days=1)


def between_days(day: Column, span: Span) -> Column:
    """Inclusive range predicate; prunes partitions when ``day`` is a partition column."""
    return day.between(F.lit(span[0]), F.lit(span[1]))


def shifted(span: Span, days: int) -> Span:
    return span[0] + timedelta(days=days), span[1] + timedelta(days=days)


def in_span(df: DataFrame, day: str, span: Span | None) -> DataFrame:
    return df if span is None else df.where(between_days(F.col(day), span))


def days_of(span: Span) -> list[date]:
    return [span[0] + timedelta(days=k) for k in range((span[1] - span[0]).days + 1)]


def day_number(day: Column) -> Column:
    """Days since 1970-01-01, so that a RANGE frame counts calendar days."""
    return F.unix_date(day)


def day_start_ms(day: Column) -> Column:
    """First millisecond of the UTC day."""
    return F.unix_date(day).cast("long") * F.lit(86_400_000)


def day_end_ms(day: Column) -> Column:
    """Last millisecond of the UTC day."""
    return (F.unix_date(day).cast("long") + 1) * F.lit(86_400_000) - 1


def date_of_text(text: Column) -> Column:
    """ISO text (a date, or a timestamp that starts with one) to date; NULL when malformed."""
    return text.try_cast("date")


def date_of_epoch_ms(ms: Column) -> Column:
    """UTC date of an epoch-millisecond value, independent of the session time zone.

    NULL outside the years 1 to 9999, such as for a time in micro- or nanoseconds.
    """
    number = F.floor(ms / F.lit(86_400_000.0))
    return F.date_from_unix_date(F.when(number.between(FIRST_DAY, LAST_DAY), number).cast("int"))


def event_date(text: Column, ms: Column) -> Column:
    """Date of a history point: its ISO text, else its epoch milliseconds."""
    return F.coalesce(date_of_text(text), date_of_epoch_ms(ms))


def hours_after_day_start(moment: Column, day: Column) -> Column:
    """Hours from the start of the UTC ``day`` to ``moment`` (negative when before)."""
    micros = F.unix_micros(moment) - day_start_ms(day) * F.lit(1000)
    return micros / F.lit(3.6e9)
