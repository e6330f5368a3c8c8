"""Rows of persons whose retention clock, started by an event, has run out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lethe.functions.calendar import event_month
from lethe.identifiers import column_path
from lethe.operators.masking import MaskContext, masked_columns, permuted
from lethe.specs import Rule

_FLAG = "__expired"
_KEY = "__person"
_WANTED = "__wanted"


def with_event_month(events: DataFrame, process_column: str, fmt: str, name: str = "event_month") -> DataFrame:
    return events.withColumn(name, event_month(F.col(column_path(process_column)).cast("string"), fmt))


def unreadable_events(process_column: str, fmt: str) -> Column:
    """Is there an event date that cannot be read?"""
    text = F.col(column_path(process_column)).cast("string")
    return text.isNotNull() & event_month(text, fmt).isNull()


def event_months(events: DataFrame, process_column: str, fmt: str) -> DataFrame:
    """Distinct months in which an event fell."""
    return (
        with_event_month(events, process_column, fmt)
        .where(F.col("event_month").isNotNull())
        .select("event_month")
        .distinct()
    )


def expired_keys(events: DataFrame, key: str, process_column: str, fmt: str, before_month: str) -> DataFrame:
    """Distinct persons with an event in a month before the limit (texts ``yyyyMM``)."""
    months = with_event_month(events, process_column, fmt)
    return months.where(F.col("event_month") < before_month).select(F.col(column_path(key))).distinct()


def expired_ids(data: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The expired persons who have rows in the data.

    The keys are made distinct before the join (which costs nothing when they are
    already), so a person with many events and many rows does not multiply them.
    """
    return data.select(key).join(keys.select(key).distinct(), key, "left_semi").distinct()


def expired_row_counts(data: DataFrame, keys: DataFrame, key: str, partition_column: str) -> DataFrame:
    """Partitions in which expired persons have rows, with the number of such rows."""
    return partition_counts(data, keys, key, partition_column).select(partition_column, "expired_rows")


def partition_counts(data: DataFrame, keys: DataFrame, key: str, partition_column: str) -> DataFrame:
    """Partitions in which expired persons have rows, with the number of such rows and of all their rows.

    One pass over the data: each row is flagged, and only counts by partition are shuffled.
    """
    wanted = keys.select(F.col(key).alias(_WANTED)).distinct()
    flagged = data.select(key, partition_column).join(wanted, F.col(key) == F.col(_WANTED), "left")
    counts = flagged.groupBy(partition_column).agg(F.count(_WANTED).alias("expired_rows"), F.count("*").alias("all_rows"))
    return counts.where("expired_rows > 0")


def split_by_keys(df: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is in the set, and all other rows; duplicates are kept."""
    wanted = keys.select(key).distinct()
    return df.join(wanted, key, "left_semi").select(*df.columns), df.join(wanted, key, "left_anti").select(*df.columns)


def distinct_except(left: DataFrame, right: DataFrame) -> DataFrame:
    """Set difference; like every set operation it removes duplicates."""
    return left.subtract(right)


def mask_where(
    df: DataFrame,
    keys: DataFrame,
    key: str,
    rules: Sequence[Rule],
    context: MaskContext,
    person: Column | None = None,
) -> DataFrame:
    """Mask the rows of the given keys and keep the others, in one pass.

    A left join against distinct keys adds no rows; adaptive execution splits the
    partitions of hot keys or broadcasts the keys when they are few. A permutation
    moves values among the masked rows only. ``person`` is what is compared with the
    keys where that is not the column ``key`` itself.
    """
    for c in (_FLAG, _KEY):
        if c in df.columns:
            raise ValueError(f"reserved column name {c}")
    # Distinct over distinct input is free; it guards against callers' duplicates.
    wanted = keys.select(F.col(column_path(key)).alias(_KEY)).distinct().withColumn(_FLAG, F.lit(True))
    compared = F.col(column_path(key)) if person is None else person
    flagged = df.join(wanted, compared == F.col(_KEY), "left")
    masked = masked_columns(df, rules, context)
    flagged = permuted(flagged, rules, context, F.col(_FLAG))
    types = {f.name: f.dataType for f in df.schema}

    def column(c: str):
        kept = F.col(column_path(c))
        if c not in masked:
            return kept
        out = F.when(F.col(_FLAG), masked[c])
        new_type = df.select(masked[c].alias(c)).schema[c].dataType
        # Masked and kept rows share the column, so the kept value follows the mask's type.
        return out.otherwise(kept if new_type == types[c] else kept.cast(new_type)).alias(c)

    return flagged.select(*[column(c) for c in df.columns])
