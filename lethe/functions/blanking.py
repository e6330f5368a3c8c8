"""Masks that remove the value: fixed characters, neutral values, nulls, hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

# Characters removed before a text is replaced as a whole.
SEPARATORS = (" ", "-", "/")
KEPT_CARD_DIGITS = 4


def card(value: Column) -> Column:
    """Every digit but the last four becomes X; separators stay."""
    tail = F.regexp_extract(value, r"(?:\d\D*){%d}$" % KEPT_CARD_DIGITS, 0)
    head = F.substring(value, F.lit(1), F.length(value) - F.length(tail))
    # With fewer than four digits there is no tail and nothing to hide.
    return F.when(tail == "", value).otherwise(F.concat(F.translate(head, "0123456789", "X" * 10), tail))


def with_char(value: Column, char: str, removed: Sequence[str]) -> Column:
    """Delete the listed strings, then write one character for each that is left."""
    for text in removed:
        if text:
            value = F.replace(value, F.lit(text), F.lit(""))
    return F.repeat(F.lit(char), F.length(value))


def neutral(dtype: DataType) -> Column:
    """The neutral value of a type."""
    if isinstance(dtype, StringType):
        return F.lit("")
    if isinstance(dtype, NumericType):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, BooleanType):
        return F.lit(False)
    if isinstance(dtype, DateType | TimestampType | TimestampNTZType):
        return F.lit("1970-01-01").cast(dtype)
    raise ValueError(f"no neutral value for {dtype.simpleString()}")


def nothing(dtype: DataType) -> Column:
    return F.lit(None).cast(dtype)


def sha1(value: Column, salt: str) -> Column:
    return F.sha1(F.concat(F.lit(salt), value.cast("string")))


def sha256(value: Column, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(salt), value.cast("string")), 256)
