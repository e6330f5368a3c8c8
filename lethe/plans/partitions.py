"""Which partitions a run touches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lethe.functions.calendar import event_partitions, expired_partitions
from lethe.operators.configuration import TABLE_KEY
from lethe.specs import EventClock, Run, TablePlan


def constant(spark: SparkSession, value: Column):
    """Value of an expression without inputs; the optimizer folds it, so no job runs."""
    return spark.sql("VALUES (0)").select(value.alias("value")).head().value


def _values(spark: SparkSession, values: Column) -> list[str]:
    # A calendar list: its length is the number of days since the stock start at most.
    return list(constant(spark, values))


def mask_partitions(spark: SparkSession, plan: TablePlan, run: Run) -> list[str]:
    """Partitions past the keeping period."""
    return _values(
        spark,
        expired_partitions(F.lit(run.run_date), plan.keep_months, plan.partition_format, run.mode, run.stock_start),
    )


def purge_partitions(spark: SparkSession, plan: TablePlan, run: Run) -> list[str]:
    """Partitions past the purge period."""
    return _values(
        spark,
        expired_partitions(F.lit(run.run_date), plan.purge_months, plan.partition_format, run.mode, run.stock_start),
    )


def event_source_partitions(spark: SparkSession, clock: EventClock, run: Run) -> list[str]:
    """Partitions of the event table to read."""
    return _values(spark, event_partitions(F.lit(run.run_date), clock.frequency, clock.value_format))


def plan_partitions(config: DataFrame, run: Run, months_column: str) -> DataFrame:
    """The partition plan of a whole configuration: one row per table and partition value.

    ``months_column`` is the keeping or the purge duration. A table without a readable
    duration stops the query, for it would be left out otherwise.
    """
    tables = config.groupBy(*TABLE_KEY).agg(
        F.min_by(F.struct("partition_value_format", months_column), F.col("column_name")).alias("s")
    )
    unreadable = F.raise_error(F.concat(F.lit(f"no readable {months_column} for "), "base", F.lit("."), "table_name"))
    months = F.coalesce(F.col(f"s.{months_column}"), unreadable.cast("int"))
    values = expired_partitions(
        F.lit(run.run_date), months, F.col("s.partition_value_format"), run.mode, run.stock_start
    )
    return tables.select(*TABLE_KEY, F.explode(values).alias("partition_value"))
