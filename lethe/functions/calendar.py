"""Retention calendar as Column expressions.

Every function takes date columns and gives a date, a text or an array of
partition values, so the same expression serves a literal run date and a table
of dates. Formats may be a Python string or a column of the configuration.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Partition value formats by grain.
DAY_FORMATS = ("yyyyMMdd", "yyyy-MM-dd")
MONTH_FORMATS = ("yyyyMM", "yyyy-MM")

# Days of event partitions before the run, by table frequency.
EVENT_DAYS = {"jours": 1, "semaine": 7}
EVENT_MONTHLY = "mois"

DEFAULT_STOCK_START = date(2013, 1, 1)
EVENT_MONTH_FORMAT = "yyyyMM"

Format = str | Column


def _days() -> Column:
    return F.make_dt_interval(days=F.lit(1))


def _months() -> Column:
    return F.make_ym_interval(months=F.lit(1))


def _no_dates() -> Column:
    return F.array().cast("array<date>")


def _by_grain(fmt: Format, daily: Column, monthly: Column) -> Column:
    """Choose the dates by the grain of the format; an unknown format is an error."""
    if isinstance(fmt, str):
        if fmt in DAY_FORMATS:
            return daily
        if fmt in MONTH_FORMATS:
            return monthly
        raise ValueError(f"unknown partition value format {fmt!r}")
    problem = F.raise_error(F.concat(F.lit("unknown partition value format "), F.coalesce(fmt, F.lit("null"))))
    return (
        F.when(fmt.isin(*DAY_FORMATS), daily)
        .when(fmt.isin(*MONTH_FORMATS), monthly)
        .otherwise(problem.cast("array<date>"))
    )


def _values(dates: Column, fmt: Format) -> Column:
    """Dates written in a format; a format column is matched against the known ones.

    A constant format is compiled once, one that changes by row for every date.
    """

    def written(pattern: str) -> Column:
        return F.transform(dates, lambda d: F.date_format(d, pattern))

    if isinstance(fmt, str):
        return written(fmt)
    first, *others = DAY_FORMATS + MONTH_FORMATS
    chosen = F.when(fmt == first, written(first))
    for pattern in others:
        chosen = chosen.when(fmt == pattern, written(pattern))
    return chosen.otherwise(dates.cast("array<string>"))


def cutoff(run_date: Column, months: Column | int) -> Column:
    """The run date moved back by a number of months, clamped to the month end."""
    n = F.lit(months) if isinstance(months, int) else months
    return F.add_months(run_date, -n)


def month_partitions(cut: Column, fmt: Format) -> Column:
    """Partitions of the month before the month of the cut-off."""
    month = F.add_months(cut, -1)
    first = F.trunc(month, "MM")
    return _values(_by_grain(fmt, F.sequence(first, F.last_day(month), _days()), F.array(first)), fmt)


def stock_partitions(cut: Column, fmt: Format, start: date | Column = DEFAULT_STOCK_START) -> Column:
    """All partitions from the start up to, but without, the day or month of the cut-off."""
    begin = F.lit(start) if isinstance(start, date) else start
    last_day = F.date_sub(cut, 1)
    days = F.when(begin <= last_day, F.sequence(begin, last_day, _days())).otherwise(_no_dates())
    first_month, last_month = F.trunc(begin, "MM"), F.trunc(F.add_months(cut, -1), "MM")
    months = F.when(
        first_month <= last_month, F.sequence(first_month, last_month, _months())
    ).otherwise(_no_dates())
    return _values(_by_grain(fmt, days, months), fmt)


def expired_partitions(
    run_date: Column, months: Column | int, fmt: Format, mode: str, start: date = DEFAULT_STOCK_START
) -> Column:
    """Partition plan of a run: everything expired (stock) or the newly expired month."""
    cut = cutoff(run_date, months)
    return stock_partitions(cut, fmt, start) if mode == "stock" else month_partitions(cut, fmt)


def event_partitions(run_date: Column, frequency: str, fmt: Format) -> Column:
    """Partitions of the event table that a run reads; the run date is not among them."""
    if frequency == EVENT_MONTHLY:
        return month_partitions(run_date, fmt)
    if frequency not in EVENT_DAYS:
        raise ValueError(f"unknown event table frequency {frequency!r}")
    days = F.sequence(F.date_sub(run_date, EVENT_DAYS[frequency]), F.date_sub(run_date, 1), _days())
    return F.array_distinct(_values(_by_grain(fmt, days, days), fmt))


def event_month(value: Column, fmt: str) -> Column:
    """Month of an event date text; null when the text cannot be read, an error when the format is unknown."""
    if fmt not in DAY_FORMATS:
        raise ValueError(f"unknown event date format {fmt!r}; known: {DAY_FORMATS}")
    return F.date_format(F.try_to_date(value, fmt), EVENT_MONTH_FORMAT)


def expired_months(event: Column, run_month: Column, keep: Column | int) -> Column:
    """Months m with event <= m < run month - keep, as texts; empty when there is none."""
    n = F.lit(keep) if isinstance(keep, int) else keep
    first = F.trunc(event, "MM")
    last = F.trunc(F.add_months(run_month, -n - 1), "MM")
    months = F.when(first <= last, F.sequence(first, last, _months())).otherwise(_no_dates())
    return _values(months, EVENT_MONTH_FORMAT)


# Time stamp formats of the audits.
AUDIT_FORMATS = ("yyyy-MM-dd", "yyyyMMdd")
AUDIT_LONG_FORMAT = "dd/MM/yyyy HH:mm:ss.SSS"


def fmt_ts(epoch_ms: Column, fmt: str) -> Column:
    """Epoch milliseconds as a day in one of two formats, or in the long form."""
    pattern = fmt if fmt in AUDIT_FORMATS else AUDIT_LONG_FORMAT
    return F.date_format(F.timestamp_millis(epoch_ms), pattern)
