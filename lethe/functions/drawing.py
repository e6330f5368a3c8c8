"""Random masks: drawn from the row key, independent of the masked value."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from lethe.functions import prf
from lethe.functions.substitution import characters, digits_replaced

# Invented names for the dictionary masks.
FIRST_NAMES = (
    "Alba", "Bastien", "Clara", "Damien", "Elise", "Fabien", "Gaelle", "Hugo",
    "Ines", "Jonas", "Karine", "Loic", "Maud", "Nils", "Odile", "Pascal",
    "Quitterie", "Remi", "Sonia", "Theo", "Ursule", "Valentin", "Wendy", "Yann", "Zoe",
)
LAST_NAMES = (
    "Arnoux", "Bellac", "Carrel", "Dumont", "Estive", "Ferrand", "Gardel", "Hamel",
    "Isnard", "Jourdan", "Kermadec", "Lambel", "Marchal", "Nivelle", "Orsel", "Perrin",
    "Quesnel", "Roussel", "Savary", "Tellier", "Urbain", "Vasseur", "Weber", "Yvert", "Zeller",
)

MAIL_DOMAIN = "example.com"
NEW_MAIL_LENGTH = 10
KEPT_INDICATOR = r"^\+?[0-9]{2}"
NEW_PHONE_DIGITS = 8

DEFAULT_INT_BOUNDS = (0, 2**31)
DEFAULT_LONG_BOUNDS = (0, 2**53)
DEFAULT_REAL_BOUNDS = (0.0, 1.0)
DEFAULT_DATE_BOUNDS = (date(1970, 1, 1), date(2020, 1, 1))
_WIDEST_RANGE = 2**60


def pick(names: Sequence[str], seed: Column) -> Column:
    """One of the names."""
    if not names:
        raise ValueError("the list of names is empty")
    index = (prf.number(seed, 1, 8) % len(names)).cast("int")
    return F.get(F.array(*[F.lit(n) for n in names]), index)


def random_text(
    value: Column, alphabet: str, derived_key: str, row_key: Sequence[Column], length: int, keep_spaces: bool
) -> Column:
    """Random characters: of a given length, or of the length of the value."""
    drawn = prf.symbols(derived_key, row_key, alphabet, length if length > 0 else F.length(value))
    if keep_spaces and length <= 0:
        spaced = F.zip_with(
            characters(value), characters(drawn), lambda c, d: F.when(c == " ", c).otherwise(d)
        )
        drawn = F.array_join(spaced, "")
    return F.when(value.isNotNull(), drawn)


def email(value: Column, derived_key: str, row_key: Sequence[Column], keep_domain: bool) -> Column:
    """A new address, or a new local part of the same length in front of the old domain."""
    if keep_domain:
        domain = F.regexp_extract(value, "@[^@]*$", 0)
        length = F.length(value) - F.length(domain)
        local = prf.symbols(derived_key, row_key, prf.LETTERS_AND_DIGITS, length)
    else:
        domain = F.lit("@" + MAIL_DOMAIN)
        local = prf.symbols(derived_key, row_key, prf.LETTERS_AND_DIGITS, NEW_MAIL_LENGTH)
    return F.when(value.isNotNull(), F.concat(local, domain))


def phone_keeping_indicator(value: Column, derived_key: str, row_key: Sequence[Column]) -> Column:
    """The leading ``+cc`` or first two digits stay, every further digit is drawn."""
    head = F.regexp_extract(value, KEPT_INDICATOR, 0)
    tail = F.substring(value, F.length(head) + 1, F.length(value))
    drawn = digits_replaced(tail, prf.symbols(derived_key, row_key, prf.DIGITS, F.length(tail)))
    return F.when(value.isNotNull(), F.concat(head, drawn))


def new_phone(value: Column, derived_key: str, row_key: Sequence[Column], cell_phone: bool) -> Column:
    """A ten-digit number: 06/07 for cell phones, 01 to 05 otherwise."""
    area = prf.number(prf.seed(derived_key, row_key), prf.REST_START, prf.REST_DIGITS)
    prefix = (6 + area % 2) if cell_phone else (1 + area % 5)
    digits = prf.symbols(derived_key, row_key, prf.DIGITS, NEW_PHONE_DIGITS)
    return F.when(value.isNotNull(), F.concat(F.lit("0"), prefix.cast("string"), digits))


def whole(value: Column, seed: Column, bounds: tuple[int, int], dtype: str) -> Column:
    """Whole number in [low, high)."""
    low, high = bounds
    if not 0 < high - low <= _WIDEST_RANGE:
        raise ValueError(f"bad bounds [{low};{high}]")
    drawn = F.lit(low).cast("bigint") + prf.number(seed, 1, 15) % F.lit(high - low).cast("bigint")
    return F.when(value.isNotNull(), drawn.cast(dtype))


def real(value: Column, seed: Column, bounds: tuple[float, float], dtype: str) -> Column:
    """Number in [low, high) with 24 (float) or 52 (double) random bits."""
    low, high = bounds
    if not low < high:
        raise ValueError(f"bad bounds [{low};{high}]")
    digits = 6 if dtype == "float" else 13
    share = prf.number(seed, 1, digits).cast("double") / F.lit(float(16**digits))
    return F.when(value.isNotNull(), (F.lit(float(low)) + share * F.lit(float(high) - float(low))).cast(dtype))


def day(value: Column, seed: Column, bounds: tuple[date, date]) -> Column:
    """Date in [low, high)."""
    low, high = bounds
    days = (high - low).days
    if days <= 0:
        raise ValueError(f"bad bounds [{low};{high}]")
    return F.when(value.isNotNull(), F.date_add(F.lit(low), (prf.number(seed, 1, 8) % days).cast("int")))


def boolean(value: Column, seed: Column) -> Column:
    return F.when(value.isNotNull(), prf.number(seed, 1, 8) % 2 == 1)
