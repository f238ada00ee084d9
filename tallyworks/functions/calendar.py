"""Time windows, trailing periods and month ranges."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, functions as F


def parse_date_range(start: str | date, end: str | date) -> tuple[date, date]:
    """Check an inclusive range before any plan is built; ISO dates, start not after end."""
    try:
        first, last = (d if isinstance(d, date) else date.fromisoformat(d) for d in (start, end))
    except ValueError as error:
        raise ValueError("dates must be written as YYYY-MM-DD") from error
    if first > last:
        raise ValueError("the start date must not be after the end date")
    return first, last


def _midnight(day: date) -> Column:
    return F.lit(day.isoformat()).cast("timestamp_ntz")


def in_window(ts: str, start: str | date, end: str | date) -> Column:
    """`start <= ts < end + 1 day`, a bare column against literals so that it reaches the scan."""
    first, last = parse_date_range(start, end)
    return (F.col(ts) >= _midnight(first)) & (F.col(ts) < _midnight(last + timedelta(days=1)))


def since_days(c: str, as_of: date, days: int = 30, is_date: bool = False) -> Column:
    """Rows not older than midnight of `as_of - days`. There is no upper bound."""
    floor = as_of - timedelta(days=days)
    return F.col(c) >= (F.lit(floor) if is_date else _midnight(floor))


def in_months(start: str | date, end: str | date, year: str = "year", month: str = "month") -> Column:
    """Whole months touched by the range: a start on the 15th takes all of that month.

    Comparisons are on bare columns, so partition folders and row groups outside the range are skipped.
    """
    first, last = parse_date_range(start, end)
    y, m = F.col(year), F.col(month)
    after = (y > first.year) | ((y == first.year) & (m >= first.month))
    before = (y < last.year) | ((y == last.year) & (m <= last.month))
    return (y >= first.year) & (y <= last.year) & after & before


def months_touched(start: Column, end: Column) -> Column:
    """Array of the first days of all months covered by the date columns `start` and `end`."""
    return F.sequence(
        F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("interval 1 month")
    )


def month_label(year: Column | str, month: Column | str) -> Column:
    return F.format_string("%d-%02d", year, month)


def now_or(fixed: Column | None) -> Column:
    """The processing time, or a fixed instant where a repeatable result is needed."""
    return F.current_timestamp() if fixed is None else fixed


def utc_instant(wall_clock: Column | str) -> Column:
    """The instant at which a clock in UTC shows `wall_clock`, whatever the session zone."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), wall_clock).cast("timestamp")


def utc_date(instant: Column | str) -> Column:
    """The date in UTC of an instant, whatever the session zone."""
    local = F.col(instant) if isinstance(instant, str) else instant
    return F.to_date(F.convert_timezone(F.current_timezone(), F.lit("UTC"), local.cast("timestamp_ntz")))
