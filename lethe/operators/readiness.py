"""Availability of partitions and date windows over an inventory table.

The inventory has one row per (dataset, partition_value, flag). A request has
(job, dataset, nominal_date, offset, unit) and optionally a flag.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lethe.functions.calendar import DAY_FORMATS, MONTH_FORMATS
from lethe.identifiers import column_path

# Schedule days, Sunday being 1.
SCHEDULE_DAYS = {
    "TUE-SAT": (3, 7),
    "WED-SAT": (4, 7),
    "MON-FRI": (2, 6),
    "MON-SAT": (2, 7),
}
DAILY, MONTHLY = "daily", "monthly"
DAY_UNIT, MONTH_UNIT = "DAY", "MONTH"


def shift(nominal: Column, offset: Column, unit: Column) -> Column:
    """Nominal date moved by a number of days or months."""
    return (
        F.when(unit == DAY_UNIT, F.date_add(nominal, offset))
        .when(unit == MONTH_UNIT, F.add_months(nominal, offset))
        .otherwise(F.raise_error(F.concat(F.lit("unknown unit "), unit)).cast("date"))
    )


def _wanted(required: DataFrame, fmt: str) -> DataFrame:
    value = F.date_format(shift(F.col("nominal_date"), F.col("offset"), F.col("unit")), fmt)
    return required.withColumn("partition_value", value)


def missing_partitions(required: DataFrame, inventory: DataFrame, fmt: str = "yyyyMMdd") -> DataFrame:
    """Requests whose partition is not in the inventory."""
    return _wanted(required, fmt).join(
        inventory.select("dataset", "partition_value").distinct(), ["dataset", "partition_value"], "left_anti"
    )


def latest_partition(required: DataFrame, inventory: DataFrame, fmt: str = "yyyyMMdd") -> DataFrame:
    """Newest partition of the dataset at or before the nominal date, null when there is none.

    Both sides shrink to distinct dates per dataset first, so a window never holds
    more rows than the calendar has days, however many requests a dataset gets;
    no request meets more than one partition.
    """
    days = inventory.select("dataset", F.to_date("partition_value", fmt).alias("day")).distinct()
    asked = required.select("dataset", F.col("nominal_date").alias("day")).distinct()
    marked = days.withColumn("available", F.col("day")).unionByName(
        asked.withColumn("available", F.lit(None).cast("date"))
    )
    so_far = Window.partitionBy("dataset").orderBy("day").rangeBetween(Window.unboundedPreceding, 0)
    newest = (
        marked.withColumn("newest", F.max("available").over(so_far))
        .groupBy("dataset", F.col("day").alias("nominal_date"))
        .agg(F.max("newest").alias("newest"))
    )
    return required.join(newest, ["dataset", "nominal_date"], "left").select(
        *required.columns, F.date_format("newest", fmt).alias("partition_value")
    )


def ready(required: DataFrame, inventory: DataFrame, fmt: str = "yyyyMMdd") -> DataFrame:
    """Per job and nominal date: do all wanted partitions carry the wanted flag?"""
    keys = ["dataset", "partition_value", "flag"]
    present = inventory.select(*keys).distinct().withColumn("present", F.lit(True))
    return (
        _wanted(required, fmt)
        .join(present, keys, "left")
        .groupBy("job", "nominal_date")
        .agg(
            F.bool_and(F.coalesce("present", F.lit(False))).alias("ready"),
            F.count("*").alias("inputs"),
        )
    )


def window_bounds(
    nominal: Column, offsets: Mapping[str, tuple[int, str]], fmt: str = "yyyyMMdd"
) -> dict[str, Column]:
    """Named date bounds: name -> (offset, unit), as texts of a partition format."""
    if fmt not in DAY_FORMATS + MONTH_FORMATS:
        raise ValueError(f"unknown partition value format {fmt!r}")
    return {
        name: F.date_format(shift(nominal, F.lit(offset), F.lit(unit)), fmt)
        for name, (offset, unit) in offsets.items()
    }


def scan_window(df: DataFrame, low: Column | str, high: Column | str, column: str = "dt") -> DataFrame:
    """Rows with a partition value between two bounds, both included."""
    return df.where(F.col(column_path(column)).between(low, high))


def nominal_dates(spark: SparkSession, start: date, end: date, rule: str) -> DataFrame:
    """Calendar table of a schedule between two dates, both included."""
    step = F.make_ym_interval(months=F.lit(1)) if rule == MONTHLY else F.make_dt_interval(days=F.lit(1))
    dates = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end), step)).alias("nominal_date"))
    if rule in (DAILY, MONTHLY):
        return dates
    if rule not in SCHEDULE_DAYS:
        raise ValueError(f"unknown schedule {rule!r}")
    return dates.where(F.dayofweek("nominal_date").between(*SCHEDULE_DAYS[rule]))
