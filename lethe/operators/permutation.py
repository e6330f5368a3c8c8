"""Permute columns over the rows: every value is kept, at another row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lethe.functions import prf
from lethe.functions.text import null_words
from lethe.identifiers import column_path

_ORDER, _BUCKET, _NEXT, _FIRST, _CELL, _ROW = "__order", "__bucket", "__next", "__first", "__cell", "__row"

# The order is a slice of the hash, and its first digits name the bucket: 65,536 buckets at every size.
_ORDER_DIGITS, _BUCKET_DIGITS = 15, 4
#: Rows with one row key, at most, where several columns are permuted together.
COPIES = 100_000


def _cleaned(df: DataFrame, column: str, where: Column | None) -> DataFrame:
    """Words for null become nulls in the rows that take part."""
    if not isinstance(df.schema[column].dataType, StringType):
        return df
    source = F.col(column_path(column))
    return df.withColumn(column, null_words(source) if where is None else F.when(where, null_words(source)).otherwise(source))


def _links(dealt: DataFrame, group: Sequence[str], value: Column, place: Column) -> DataFrame:
    """For each bucket the first value of the next one that has rows, the last bucket that of the first.

    The whole rows go into the aggregation, so its input is the very exchange that deals out the rows, and Spark makes
    that once for both; after it a row for each bucket is left, 65,536 for each column at most.
    """
    every = F.struct(*[F.col(column_path(c)) for c in dealt.columns], value.alias(_NEXT))
    firsts = dealt.groupBy(*group, _BUCKET).agg(F.min_by(every, place).alias(_FIRST)).select(
        *group, _BUCKET, F.col(f"{_FIRST}.{_NEXT}").alias(_NEXT))
    along = Window.partitionBy(*group).orderBy(_BUCKET) if group else Window.orderBy(_BUCKET)
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(F.lead(_NEXT).over(along), F.first(_NEXT).over(whole))
    return firsts.select(*group, _BUCKET, following.alias(_NEXT))


def permute(
    df: DataFrame, column: str, derived_key: str, row_key: Sequence[str], where: Column | None = None
) -> DataFrame:
    """Give each row the value of the next row in keyed hash order of the row key; the last takes the first.

    One cycle runs through all rows that take part: those with a value that meet
    ``where`` (the other rows are not shuffled and stay as they are). So the multiset of values
    is kept exactly and, with two rows or more, no row keeps its own cell.

    The cycle is cut at fixed prefixes of the hash. A bucket is ordered by itself, and
    its last row gets the first value of the next bucket that has rows, from a table
    of one row for each bucket. Neither depends on the number of rows or partitions,
    and values never decide where a row goes, so one value in a third of all rows
    does no harm. The row key has to identify rows: rows with equal keys share a bucket.
    """
    source = F.col(column_path(column))
    taking_part = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    df = _cleaned(df, column, None if where is None else taking_part)
    keys = [F.col(column_path(k)) for k in row_key]
    taking_part = taking_part & source.isNotNull()
    seed = prf.seed(derived_key, keys)
    dealt = df.where(taking_part).withColumns(
        {_ORDER: prf.number(seed, 1, _ORDER_DIGITS), _BUCKET: F.substring(seed, 1, _BUCKET_DIGITS)}
    ).repartition(_BUCKET)
    place = F.struct(_ORDER, *[k.alias(f"k{i}") for i, k in enumerate(keys)], source.alias("v"))
    links = _links(dealt, (), source, place)
    inside = Window.partitionBy(_BUCKET).orderBy(_ORDER, *keys, source)
    # The join works on the buckets as they lie; only the links move to them. A link is always there: an outer
    # join keeps the planner from adding a filter on this side, which would make the two exchanges differ.
    moved = dealt.withColumn(_ORDER, F.lead(source).over(inside)).join(links.hint("merge"), _BUCKET, "left")
    value = F.coalesce(F.col(_ORDER), F.col(_NEXT)).alias(column)
    changed = moved.select(*[value if c == column else F.col(column_path(c)) for c in df.columns])
    return changed.union(df.where(~taking_part))


def permute_all(
    df: DataFrame, columns: Sequence[tuple[str, str]], row_key: Sequence[str], where: Column | None = None
) -> DataFrame:
    """``permute`` for several columns, given with their derived keys, at the price of one shuffle of the rows.

    Each row sends a cell for each of the columns, with its place in that column's order and its number, a hash of the
    row key, so that all cycles run over one exchange of narrow cells. The moved cells come back by that number and meet the rows
    there, which are shuffled once however many columns there are. The results are those of permuting one column after another:
    among rows of one number each takes the cell that its own value has sent. Such rows meet in one
    list, so more than ``COPIES`` of them are an error.
    """
    if len(columns) == 1:
        return permute(df, *columns[0], row_key, where)
    taking_part = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    for column, _ in columns:
        df = _cleaned(df, column, None if where is None else taking_part)
    keys = [F.col(column_path(k)) for k in row_key]
    places = range(len(columns))
    values = [F.col(column_path(c)) for c, _ in columns]
    seeds = [prf.seed(key, keys) for _, key in columns]
    number = prf.number(seeds[0], 1, _ORDER_DIGITS)

    def cell(i: int) -> Column:
        carried = [(values[j] if i == j else F.lit(None).cast(df.schema[columns[j][0]].dataType)).alias(f"v{j}") for j in places]
        return F.struct(
            F.lit(i).alias(_CELL), prf.number(seeds[i], 1, _ORDER_DIGITS).alias(_ORDER),
            F.substring(seeds[i], 1, _BUCKET_DIGITS).alias(_BUCKET), *carried)

    own = [k.alias(f"{_ROW}{i}") for i, k in enumerate(keys)]
    cells = df.where(taking_part).select(number.alias(_ROW), *own, F.explode(F.array(*[cell(i) for i in places])).alias("c"))
    present = reduce(Column.__or__, [F.col(f"c.v{i}").isNotNull() for i in places])
    dealt = cells.where(present).select(_ROW, *[f"{_ROW}{i}" for i in range(len(keys))], "c.*").repartition(_CELL, _BUCKET)
    held = F.struct(*[F.col(f"v{i}") for i in places])
    along = [_ORDER, *[f"{_ROW}{i}" for i in range(len(keys))], *[f"v{i}" for i in places]]
    links = _links(dealt, (_CELL,), held, F.struct(*along))
    inside = Window.partitionBy(_CELL, _BUCKET).orderBy(*along)
    moved = dealt.withColumn(_FIRST, F.lead(held).over(inside)).join(links.hint("merge"), [_CELL, _BUCKET], "left")
    new = F.coalesce(_FIRST, _NEXT)
    back = moved.groupBy(_ROW).agg(*[
        F.array_sort(F.collect_list(F.when(F.col(_CELL) == i, F.struct(F.col(f"v{i}").alias("old"), new[f"v{i}"].alias("new"))))).alias(f"{_NEXT}{i}")
        for i in places])

    def sent(i: int) -> Column:
        return F.when(taking_part, values[i])

    # Places among the rows of one number, by the value that has sent the cell.
    numbered = df.withColumn(_ROW, number).repartition(_ROW)
    for i in places:
        numbered = numbered.withColumn(f"{_CELL}{i}", F.row_number().over(Window.partitionBy(_ROW).orderBy(sent(i).asc_nulls_last())))
    many = F.raise_error(F.lit(f"more than {COPIES} rows share a row key: permute the columns by themselves, or name a key that identifies rows"))

    def column(name: str) -> Column:
        for i, (permuted, _) in enumerate(columns):
            if permuted == name:
                found = F.element_at(F.col(f"{_NEXT}{i}"), F.col(f"{_CELL}{i}"))["new"]
                found = F.when(F.col(f"{_CELL}{i}") > COPIES, many.cast(df.schema[name].dataType)).otherwise(found)
                return F.when(sent(i).isNotNull(), found).otherwise(values[i]).alias(name)
        return F.col(column_path(name))

    return numbered.join(back, _ROW, "left").select(*[column(c) for c in df.columns])
