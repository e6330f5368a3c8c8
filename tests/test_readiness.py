"""Partition availability against brute force."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from lethe.operators import readiness


def test_latest_and_missing_against_brute_force(spark):
    random.seed(3)
    first = date(2024, 1, 1)
    # One dataset holds most of the rows on both sides.
    inventory = [("hot" if i % 3 else f"d{i % 5}", first + timedelta(days=random.randrange(40)), "_SUCCESS") for i in range(300)]
    required = [
        (f"j{i}", "hot" if i % 2 else f"d{i % 7}", first + timedelta(days=random.randrange(-5, 45)), -random.randrange(4), "DAY")
        for i in range(400)
    ]
    have = spark.createDataFrame([(d, p.strftime("%Y%m%d"), f) for d, p, f in inventory], "dataset string, partition_value string, flag string")
    want = spark.createDataFrame(required, "job string, dataset string, nominal_date date, offset int, unit string")
    latest = {r.job: r.partition_value for r in readiness.latest_partition(want, have).collect()}
    missing = {r.job for r in readiness.missing_partitions(want, have).collect()}
    assert len(latest) == len(required)
    for job, dataset, nominal, offset, _ in required:
        days = [p for d, p, _ in inventory if d == dataset]
        before = [p for p in days if p <= nominal]
        assert latest[job] == (max(before).strftime("%Y%m%d") if before else None)
        assert (job in missing) == (nominal + timedelta(days=offset) not in days)


def test_ready_needs_every_flag(spark):
    have = spark.createDataFrame(
        [("a", "20240101", "_SUCCESS"), ("a", "20240101", "_SUCCESS"), ("b", "20240101", "_READY")],
        "dataset string, partition_value string, flag string")
    day = date(2024, 1, 2)
    want = spark.createDataFrame(
        [("one", "a", day, -1, "DAY", "_SUCCESS"), ("two", "a", day, -1, "DAY", "_SUCCESS"), ("two", "b", day, -1, "DAY", "_SUCCESS")],
        "job string, dataset string, nominal_date date, offset int, unit string, flag string")
    assert sorted((r.job, r.ready, r.inputs) for r in readiness.ready(want, have).collect()) == [
        ("one", True, 1), ("two", False, 2)]


def test_bounds_and_schedules(spark):
    bounds = readiness.window_bounds(F.lit(date(2024, 3, 31)), {"m": (-1, "MONTH"), "d": (-60, "DAY")}, "yyyy-MM-dd")
    assert tuple(spark.range(1).select(bounds["m"], bounds["d"]).head()) == ("2024-02-29", "2024-01-31")
    with pytest.raises(ValueError, match="format"):
        readiness.window_bounds(F.lit(date(2024, 3, 31)), {}, "dd")
    first, last = date(2024, 1, 1), date(2024, 2, 29)
    days = [first + timedelta(days=i) for i in range(60)]
    for rule, wanted in (("TUE-SAT", range(1, 6)), ("WED-SAT", range(2, 6)), ("MON-FRI", range(5)), ("MON-SAT", range(6)), ("daily", range(7))):
        got = sorted(r.nominal_date for r in readiness.nominal_dates(spark, first, last, rule).collect())
        assert got == [d for d in days if d.weekday() in wanted]
    assert [r.nominal_date.day for r in readiness.nominal_dates(spark, first, last, "monthly").collect()] == [1, 1]
    with pytest.raises(ValueError, match="schedule"):
        readiness.nominal_dates(spark, first, last, "weekly")
    with pytest.raises(Exception, match="unknown unit"):
        spark.range(1).select(readiness.shift(F.current_date(), F.lit(1), F.lit("YEAR"))).collect()
