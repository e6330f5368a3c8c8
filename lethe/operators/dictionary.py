"""Replace values by names of a table, drawn by the hash of the row key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lethe.functions import prf
from lethe.functions.text import let
from lethe.identifiers import column_path

_INDEX, _NAME, _RANGE = "__index", "__name", "__range"
# Rows without a value are dealt over so many numbers that no name has.
_NOWHERE = 4096
#: Names drawn to lay ranges over a table of names, and ranges: some 100,000 names in each of a table of 25 million.
SAMPLE, RANGES = 4096, 256


def _bounds(listed: DataFrame) -> list[str]:
    """Names at which ranges of about equal size begin: quantiles of a bounded sample, the names of least hash."""
    drawn = sorted(row[_NAME] for row in listed.orderBy(F.xxhash64(_NAME), _NAME).limit(SAMPLE).collect())
    # Python orders texts by code point, as Spark does by their UTF-8 bytes.
    return sorted({drawn[len(drawn) * k // RANGES] for k in range(1, RANGES)} - {drawn[0]}) if drawn else []


def numbered_names(names: DataFrame) -> tuple[DataFrame, int]:
    """Distinct names of the first column, numbered in their order, and how many there are.

    Every range of names is sorted by itself, and its numbers begin where the names of the ranges before it
    end, so no task holds all names. The driver sees a sample of ``SAMPLE`` names and a count for each range.
    """
    listed = names.select(names[names.columns[0]].cast("string").alias(_NAME)).where(F.col(_NAME).isNotNull()).distinct()
    bounds = F.array(*[F.lit(b) for b in _bounds(listed)]).cast("array<string>")
    ranged = listed.withColumn(_RANGE, let(F.col(_NAME), lambda name: F.size(F.filter(bounds, lambda b: b <= name))))
    sizes = {row[_RANGE]: row["count"] for row in ranged.groupBy(_RANGE).count().collect()}
    before, starts = 0, []
    for k in range(max(sizes, default=-1) + 1):
        starts.append(before)
        before += sizes.get(k, 0)
    if not before:
        return listed.withColumn(_INDEX, F.lit(0).cast("bigint")), 0
    first = F.get(F.array(*[F.lit(s).cast("bigint") for s in starts]), F.col(_RANGE))
    inside = F.row_number().over(Window.partitionBy(_RANGE).orderBy(_NAME))
    return ranged.select(_NAME, (first + inside - 1).cast("bigint").alias(_INDEX)), before


def replace_by_names(
    df: DataFrame, column: str, names: DataFrame, derived_key: str, row_key: Sequence[str], where: Column | None = None
) -> DataFrame:
    """Give each row with a value (that meets ``where``) one of the distinct names of the first column of ``names``.

    The names are numbered in their order, one row for each, and joined by number; Spark
    broadcasts them when they are few. Numbers come from a hash, so no name is hot.
    """
    numbered, count = numbered_names(names)
    if not count:
        raise ValueError(f"the table of names for {column!r} is empty")
    value = F.col(column_path(column))
    taking_part = value.isNotNull() if where is None else value.isNotNull() & F.coalesce(where, F.lit(False))
    draw = prf.number(prf.seed(derived_key, [F.col(column_path(k)) for k in row_key]), 1, 15)
    index = F.when(taking_part, draw % count).otherwise(-1 - draw % _NOWHERE)
    joined = df.withColumn(_INDEX, index).join(numbered, _INDEX, "left")
    new = F.when(taking_part, F.col(_NAME)).otherwise(value.cast("string")).alias(column)
    kept = [c for c in df.columns]
    return joined.select(*[new if c == column else F.col(column_path(c)) for c in kept])
