"""Small text helpers shared by the masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that stand for a missing value.
NULL_WORDS = ("null", "NULL", "Null")


def null_words(value: Column) -> Column:
    """Turn the words for null into real nulls."""
    return F.when(value.isin(*NULL_WORDS), F.lit(None)).otherwise(value)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    A column that is used inside a lambda is computed anew for each element; binding it as the start of a fold over
    nothing avoids that, and unlike the element of an array it is neither copied nor typed anew in each row.
    """
    return F.aggregate(F.array(), value, lambda bound, _: bound, body)
