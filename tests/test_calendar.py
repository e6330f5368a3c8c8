"""The retention calendar against plain Python dates."""

from __future__ import annotations

import calendar as pycal
from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lethe.functions import calendar as cal

DATES = st.dates(date(1999, 1, 1), date(2031, 12, 31))
EDGES = [date(2000, 2, 29), date(2019, 3, 31), date(2020, 3, 31), date(2021, 1, 1), date(2021, 12, 31), date(2024, 1, 31)]
PATTERNS = {"yyyyMMdd": "%Y%m%d", "yyyy-MM-dd": "%Y-%m-%d", "yyyyMM": "%Y%m", "yyyy-MM": "%Y-%m"}
slow = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


def back(day: date, months: int) -> date:
    index = day.year * 12 + day.month - 1 - months
    year, month = divmod(index, 12)
    return date(year, month + 1, min(day.day, pycal.monthrange(year, month + 1)[1]))


def month_days(day: date) -> list[date]:
    return [date(day.year, day.month, d) for d in range(1, pycal.monthrange(day.year, day.month)[1] + 1)]


def months_from(first: date, last: date) -> list[date]:
    out, day = [], first.replace(day=1)
    while day <= last.replace(day=1):
        out.append(day)
        day = (day + timedelta(days=32)).replace(day=1)
    return out


def written(days, fmt):
    return [d.strftime(PATTERNS[fmt]) for d in days]


def evaluate(spark, days, **columns):
    frame = spark.createDataFrame([(d,) for d in days], "d date")
    return frame.select("d", *[c.alias(n) for n, c in columns.items()]).collect()


@slow
@given(days=st.lists(DATES, min_size=20, max_size=40), months=st.integers(0, 50))
def test_month_and_stock_partitions(spark, days, months):
    start = date(2013, 1, 1)
    cut = cal.cutoff(F.col("d"), months)
    columns = {"cut": cut}
    for fmt in PATTERNS:
        columns[f"m_{fmt}"] = cal.month_partitions(cut, fmt)
        columns[f"s_{fmt}"] = cal.stock_partitions(cut, fmt, start)
    for row in evaluate(spark, days + EDGES, **columns):
        expected = back(row.d, months)
        assert row.cut == expected
        before = back(expected, 1)
        stock = [start + timedelta(days=i) for i in range(max(0, (expected - start).days))]
        for fmt in cal.DAY_FORMATS:
            assert row[f"m_{fmt}"] == written(month_days(before), fmt)
            assert row[f"s_{fmt}"] == written(stock, fmt)
        for fmt in cal.MONTH_FORMATS:
            assert row[f"m_{fmt}"] == written([before], fmt)
            assert row[f"s_{fmt}"] == written(months_from(start, before), fmt)


@slow
@given(days=st.lists(DATES, min_size=20, max_size=40), keep=st.integers(0, 60))
def test_expired_months(spark, days, keep):
    run = date(2024, 5, 17)
    for row in evaluate(spark, days + EDGES, m=cal.expired_months(F.col("d"), F.lit(run), keep)):
        months = months_from(row.d, back(run, keep + 1)) if row.d.replace(day=1) <= back(run, keep + 1) else []
        assert row.m == written(months, "yyyyMM")


def test_worked_examples(spark):
    row = evaluate(spark, [date(2019, 3, 2)], v=cal.month_partitions(cal.cutoff(F.col("d"), 12), "yyyyMMdd"))[0]
    assert (row.v[0], row.v[-1], len(row.v)) == ("20180201", "20180228", 28)


def test_event_partitions(spark):
    row = evaluate(
        spark, [date(2024, 3, 1)],
        jours=cal.event_partitions(F.col("d"), "jours", "yyyyMMdd"),
        semaine=cal.event_partitions(F.col("d"), "semaine", "yyyy-MM-dd"),
        month=cal.event_partitions(F.col("d"), "semaine", "yyyyMM"),
        mois=cal.event_partitions(F.col("d"), "mois", "yyyyMM"),
    )[0]
    assert row.jours == ["20240229"]
    assert row.semaine == [f"2024-02-{d}" for d in range(23, 30)]
    assert row.month == ["202402"] and row.mois == ["202402"]


def test_event_month(spark):
    frame = spark.createDataFrame([("20240131",), ("2024-01-31",), ("none",), (None,)], "v string")
    rows = frame.select(cal.event_month(F.col("v"), "yyyyMMdd").alias("c"))
    assert [r.c for r in rows.collect()] == ["202401", None, None, None]
    with pytest.raises(ValueError, match="unknown event date format"):
        cal.event_month(F.col("v"), "x")


def test_format_column_and_unknown_formats(spark):
    day = F.lit(date(2024, 3, 10))
    frame = spark.createDataFrame([(f,) for f in PATTERNS], "f string")
    rows = frame.select("f", cal.month_partitions(day, F.col("f")).alias("v")).collect()
    for row in rows:
        days = month_days(date(2024, 2, 1)) if row.f in cal.DAY_FORMATS else [date(2024, 2, 1)]
        assert row.v == written(days, row.f)
    with pytest.raises(ValueError, match="unknown partition value format"):
        cal.month_partitions(day, "dd/MM/yyyy")
    with pytest.raises(ValueError, match="frequency"):
        cal.event_partitions(day, "an", "yyyyMM")
    with pytest.raises(Exception, match="unknown partition value format"):
        spark.createDataFrame([("dd",)], "f string").select(cal.month_partitions(day, F.col("f"))).collect()


def test_audit_time_stamps(spark):
    row = spark.range(1).select(
        cal.fmt_ts(F.lit(1700000000123), "yyyy-MM-dd").alias("a"), cal.fmt_ts(F.lit(1700000000123), "yyyyMMdd").alias("b"),
        cal.fmt_ts(F.lit(1700000000123), "other").alias("c")).head()
    assert tuple(row) == ("2023-11-14", "20231114", "14/11/2023 22:13:20.123")
