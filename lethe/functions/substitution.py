"""Consistent masks: equal values of a column get equal substitutes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
)

from lethe.functions import prf
from lethe.functions.text import let

IBAN_START = r"^[A-Za-z]{2}[0-9]{2}"


def characters(text: Column) -> Column:
    return F.split(text, "")


def digits_replaced(text: Column, digits: Column) -> Column:
    """Each digit of a text replaced by the character at its position of another text."""
    return F.array_join(
        F.zip_with(
            characters(text), characters(digits), lambda c, d: F.when(c.between("0", "9"), d).otherwise(c)
        ),
        "",
    )


def alphanumeric(text: Column, derived_key: str, seed_value: Column | None = None) -> Column:
    """Keyed substitution of letters and digits by the whole value.

    Digit for digit and letter for letter of the same case; anything else stays.
    """

    def substitute(char: Column, sign: Column) -> Column:
        return (
            F.when(char.between("a", "z"), F.lower(prf.sign_as_letter(sign)))
            .when(char.between("0", "9"), prf.sign_as_digit(sign))
            .when(char.between("A", "Z"), prf.sign_as_letter(sign))
            .otherwise(char)
        )

    value = text if seed_value is None else seed_value
    drawn = prf.signs(derived_key, [value], F.length(text))
    return F.array_join(F.zip_with(characters(text), characters(drawn), substitute), "")


def _lead_digit(derived_key: str, text: Column) -> Column:
    """A digit from 1 to 9 for a first digit that must not be zero."""
    drawn = prf.number(prf.seed(derived_key, [text]), prf.REST_START, prf.REST_DIGITS)
    return (1 + drawn % 9).cast("string")


def _numeric_text(text: Column, derived_key: str) -> Column:
    drawn = prf.symbols(derived_key, [text], prf.DIGITS, F.length(text))

    def finished(plain: Column) -> Column:
        lost = (F.regexp_extract(text, "[0-9]", 0) != "0") & (F.regexp_extract(plain, "[0-9]", 0) == "0")
        lead = F.concat(F.lit("$1"), _lead_digit(derived_key, text))
        return F.when(lost, F.regexp_replace(plain, F.lit("^([^0-9]*)0"), lead)).otherwise(plain)

    return F.when(text.isNotNull(), let(digits_replaced(text, drawn), finished))


# Longest mantissa that a type prints: 20 for a long, 25 for a double, 40 for a decimal.
_PRINTED = {ByteType: 15, ShortType: 15, IntegerType: 15, LongType: 30, FloatType: 30, DoubleType: 30}
_LONGEST_PRINTED = 45


def numeric(value: Column, dtype: DataType, derived_key: str) -> Column:
    """Keyed substitution of digits; sign, point, exponent and type are kept.

    A first digit other than zero stays other than zero, so the number of digits
    does not change. A result that does not fit the type starts with 1 instead.
    """
    text = value.cast("string")
    if isinstance(dtype, StringType):
        return _numeric_text(text, derived_key)
    # A printed number is a sign, digits, a point and an exponent, all but one of them
    # optional, so the substitute is put together from slices without a loop. Nulls
    # pass through; a guard around the whole would keep Spark from sharing the parts.
    mantissa = F.substring_index(text, "E", 1)
    exponent = F.substring(text, F.length(mantissa) + 1, F.length(text))
    length = F.length(mantissa)
    drawn = prf.symbols(derived_key, [text], prf.DIGITS, _PRINTED.get(type(dtype), _LONGEST_PRINTED))
    sign = F.when(F.startswith(mantissa, F.lit("-")), 1).otherwise(0)
    point = F.instr(mantissa, ".")
    whole = F.when(point > 0, point - 1).otherwise(length) - sign
    first = F.substring(drawn, 1, 1)
    was_first = F.substring(mantissa, sign + 1, F.lit(1))
    lost = (was_first != "0") & (first == "0")
    # Null for NaN and the infinities, which have no digits.
    head = F.when(was_first.between("0", "9"), F.substring(mantissa, F.lit(1), sign))
    tail = F.concat(
        F.substring(drawn, F.lit(2), whole - 1),
        F.when(point > 0, ".").otherwise(""),
        F.substring(drawn, whole + 1, F.when(point > 0, length - point).otherwise(0)),
        exponent,
    )
    masked = F.concat(head, F.when(lost, _lead_digit(derived_key, text)).otherwise(first), tail)
    small = "10" if isinstance(dtype, ByteType) else "1"
    fitted = F.concat(head, F.lit(small), F.substring(tail, F.lit(len(small)), F.length(tail)))
    choices = [masked.try_cast(dtype), fitted.try_cast(dtype)]
    if isinstance(dtype, FloatType | DoubleType):
        choices.append(F.when(F.isnan(value) | F.abs(value).cast("string").eqNullSafe("Infinity"), value))
    return F.coalesce(*choices)


def mod_97(text: Column) -> Column:
    """Remainder by 97 of a text whose letters count as 10 to 35."""

    def step(rest: Column, char: Column) -> Column:
        digit = F.when(char.between("0", "9"), F.ascii(char) - 48).otherwise(F.ascii(char) - 55)
        return F.when(digit < 10, (rest * 10 + digit) % 97).otherwise((rest * 100 + digit) % 97)

    return F.aggregate(characters(text), F.lit(0), step)


def iban(value: Column, derived_key: str) -> Column:
    """Country and length stay, the account part is substituted, the check digits are recomputed.

    A value that does not start like an account number is substituted as a whole.
    """
    country = F.substring(value, 1, 2)
    account = alphanumeric(F.substring(value, F.lit(5), F.length(value)), derived_key, value)

    def assembled(body: Column) -> Column:
        bare = F.upper(F.regexp_replace(F.concat(body, country), "[^0-9A-Za-z]", ""))
        check = F.lpad((98 - mod_97(F.concat(bare, F.lit("00")))).cast("string"), 2, "0")
        return F.concat(country, check, body)

    return F.when(value.rlike(IBAN_START), let(account, assembled)).otherwise(alphanumeric(value, derived_key))
