"""Keyed pseudo-random values from SHA-256.

The same key, column and input give the same value on every executor, after
every retry and under any partitioning. The caller's key itself never enters a
plan: each column works with a key derived from it on the driver.

A hash has 64 hex digits. Four slices of 15 digits (60 bits) are written in
another base and cut to the symbols that are all but equally likely, which
gives many characters for each hash without a loop over characters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lethe.functions.text import let

SLICE_DIGITS = 15
SLICES = 4
# The last digits of a hash belong to no slice.
REST_START, REST_DIGITS = 61, 4

DIGITS = "0123456789"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS_AND_DIGITS = "0123456789abcdefghijklmnopqrstuvwxyz"
# Alphabet -> symbols kept of a slice, and digits of 2 ** 60 in that base.
_KEPT = {DIGITS: (15, 19), LETTERS: (11, 13), LETTERS_AND_DIGITS: (9, 12)}

# The 64 signs of base 64 folded onto digits (6 or 7 signs each) and letters (2 or 3 each).
_SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_AS_DIGITS = "".join(DIGITS[i % len(DIGITS)] for i in range(len(_SIGNS)))
_AS_LETTERS = "".join(LETTERS[i % len(LETTERS)] for i in range(len(_SIGNS)))
# Full signs that one hash gives.
SIGNS_PER_HASH = 42

# A plan may show the derived keys; this pattern lets Spark redact them.
DERIVED_KEY_PATTERN = r"\b[0-9a-f]{64}\b"


def column_key(key: str, column: str) -> str:
    """Key of one column, 64 hex digits."""
    if not key:
        raise ValueError("this mask needs a key")
    return hashlib.sha256(f"{key}|{column}".encode()).hexdigest()


def seed(derived_key: str, inputs: Sequence[Column]) -> Column:
    """64 hex digits for the inputs; a null input counts as empty text."""
    texts = [F.coalesce(c.cast("string"), F.lit("")) for c in inputs]
    return F.sha2(F.concat_ws("|", F.lit(derived_key), *texts), 256)


def next_hash(seed_hex: Column, block: Column) -> Column:
    """Further hashes of a seed; block 0 is the seed itself."""
    return F.when(block == 0, seed_hex).otherwise(F.sha2(F.concat_ws("|", seed_hex, block.cast("string")), 256))


def number(hexadecimal: Column, start: int, digits: int) -> Column:
    """Whole number from a slice of hex digits (first position is 1, at most 15 digits)."""
    return F.conv(F.substring(hexadecimal, start, digits), 16, 10).cast("bigint")


def slice_symbols(hexadecimal: Column, slices: Sequence[int], alphabet: str) -> Column:
    """Characters of an alphabet from some slices of a hash."""
    kept, width = _KEPT[alphabet]
    parts = [
        F.substring(
            F.lpad(F.conv(F.substring(hexadecimal, SLICE_DIGITS * i + 1, SLICE_DIGITS), 16, len(alphabet)), width, "0"),
            width - kept + 1,
            kept,
        )
        for i in slices
    ]
    text = parts[0] if len(parts) == 1 else F.concat(*parts)
    if alphabet == LETTERS:
        # Base 26 counts 0-9, A-P.
        return F.translate(text, "0123456789ABCDEFGHIJKLMNOP", LETTERS)
    return F.lower(text) if alphabet == LETTERS_AND_DIGITS else text


def signs(derived_key: str, inputs: Sequence[Column], length: Column) -> Column:
    """One sign of base 64 per position: the fastest source where slight bias does not matter."""

    def of(hexadecimal: Column) -> Column:
        return F.base64(F.unhex(hexadecimal))

    start = seed(derived_key, inputs)
    blocks = F.sequence(F.lit(0), F.floor((length - 1) / SIGNS_PER_HASH).cast("int"))
    more = let(
        start,
        lambda first: F.array_join(
            F.transform(blocks, lambda b: F.substring(of(next_hash(first, b)), 1, SIGNS_PER_HASH)), ""
        ),
    )
    text = F.when(length <= SIGNS_PER_HASH, of(start)).otherwise(more)
    return F.substring(text, F.lit(1), length)


def sign_as_digit(sign: Column) -> Column:
    return F.translate(sign, _SIGNS, _AS_DIGITS)


def sign_as_letter(sign: Column) -> Column:
    return F.translate(sign, _SIGNS, _AS_LETTERS)


def kept_symbols(alphabet: str) -> int:
    """Characters that one slice gives."""
    return _KEPT[alphabet][0]


def symbols(derived_key: str, inputs: Sequence[Column], alphabet: str, length: int | Column) -> Column:
    """Text of the given length over an alphabet; the work grows linearly with the length."""
    kept = kept_symbols(alphabet)
    start = seed(derived_key, inputs)
    if isinstance(length, int) and length <= SLICES * kept:
        return F.substring(slice_symbols(start, range(-(-length // kept)), alphabet), 1, length)
    n = F.lit(length) if isinstance(length, int) else length
    every = range(SLICES)

    def drawn(first: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((n - 1) / (SLICES * kept)).cast("int"))
        more = F.transform(blocks, lambda b: let(next_hash(first, b), lambda h: slice_symbols(h, every, alphabet)))
        return (
            F.when(n <= kept, slice_symbols(first, [0], alphabet))
            .when(n <= SLICES * kept, slice_symbols(first, every, alphabet))
            .otherwise(F.array_join(more, ""))
        )

    return F.substring(let(start, drawn), F.lit(1), n)
