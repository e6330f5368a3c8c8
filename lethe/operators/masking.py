"""The masking methods by name, and their application to a table."""

from __future__ import annotations

import secrets
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from lethe.functions import blanking, drawing, fpe, prf, substitution
from lethe.functions.text import null_words
from lethe.identifiers import column_path
from lethe.operators.dictionary import replace_by_names
from lethe.operators.options import flag, parse_bounds, to_type
from lethe.operators.permutation import permute, permute_all
from lethe.specs import Rule

PERMUTATION = "keepDistribution"


@dataclass(frozen=True)
class MaskContext:
    """What the masks of one table need besides their options."""

    key: str = field(default="", repr=False)
    row_key: tuple[str, ...] = ()
    first_names: tuple[str, ...] = drawing.FIRST_NAMES
    last_names: tuple[str, ...] = drawing.LAST_NAMES
    # Tables of names, in their first column; they go before the tuples.
    first_table: DataFrame | None = field(default=None, repr=False, compare=False)
    last_table: DataFrame | None = field(default=None, repr=False, compare=False)

    def names_table(self, method: str) -> DataFrame | None:
        return {"firstname": self.first_table, "lastname": self.last_table}.get(method)


@dataclass(frozen=True)
class _Target:
    """One column about to be masked."""

    column: str
    value: Column
    dtype: DataType
    options: Mapping[str, str]
    context: MaskContext

    @property
    def text(self) -> Column:
        return self.value if isinstance(self.dtype, StringType) else self.value.cast("string")

    @property
    def key(self) -> str:
        """Columns with the same ``domain`` share a key, so that consistent masks still join."""
        return prf.column_key(self.context.key, self.options.get("domain") or self.column)

    @property
    def row_key(self) -> list[Column]:
        if not self.context.row_key:
            raise ValueError(f"a random mask on {self.column!r} needs the columns that identify a row")
        return [F.col(column_path(c)) for c in self.context.row_key]

    @property
    def row_seed(self) -> Column:
        return prf.seed(self.key, self.row_key)

    def flag(self, name: str, default: bool = False) -> bool:
        return flag(self.options, name, default)

    def bounds(self, kind: str, default: tuple) -> tuple:
        text = self.options.get(f"{kind}_bounds")
        return parse_bounds(text, kind) if text else default

    def chosen_type(self) -> DataType:
        """The column's own type, or the named one (text unless given)."""
        return self.dtype if self.flag("respect_type") else to_type(self.options.get("data_type") or "string")

    def salt(self) -> str:
        """No salt, a given one, or one drawn for this run and not kept."""
        salt = self.options.get("salt", "")
        # As long as a hash, so that the pattern which redacts derived keys covers it.
        return secrets.token_hex(32) if salt == "random" else salt

    def length(self) -> int:
        return int(self.options.get("length") or -1)


def _email(t: _Target) -> Column:
    return drawing.email(t.text, t.key, t.row_key, t.flag("keep_domaine"))


def _phone(t: _Target) -> Column:
    if t.flag("keep_indicator", True):
        return drawing.phone_keeping_indicator(t.text, t.key, t.row_key)
    return drawing.new_phone(t.text, t.key, t.row_key, t.flag("cell_phone"))


def _names(t: _Target, names: Sequence[str]) -> Column:
    return F.when(t.value.isNotNull(), drawing.pick(names, t.row_seed))


def _random_text(t: _Target, alphabet: str) -> Column:
    return drawing.random_text(t.text, alphabet, t.key, t.row_key, t.length(), t.flag("preserve_spaces"))


def _blanked(t: _Target, default: str | None, removed: Sequence[str]) -> Column:
    char = default if default == "0" else (t.options.get("char") or default)[0]
    return blanking.with_char(t.text, char, removed)


def _removed(t: _Target) -> list[str]:
    return t.options.get("remove_before_blank", "").split(";")


METHODS: dict[str, Callable[[_Target], Column]] = {
    "id": lambda t: substitution.alphanumeric(t.text, t.key),
    "chaine": lambda t: substitution.alphanumeric(t.text, t.key),
    "numeric": lambda t: substitution.numeric(t.value, t.dtype, t.key),
    "iban": lambda t: substitution.iban(t.text, t.key),
    "firstname": lambda t: _names(t, t.context.first_names),
    "lastname": lambda t: _names(t, t.context.last_names),
    "card": lambda t: blanking.card(t.text),
    "email": _email,
    "tel": _phone,
    "blankedWithChar": lambda t: _blanked(t, "*", _removed(t)),
    "XReplace": lambda t: _blanked(t, "X", blanking.SEPARATORS),
    "0Replace": lambda t: _blanked(t, "0", blanking.SEPARATORS),
    "blank": lambda t: blanking.neutral(t.chosen_type()),
    "null": lambda t: blanking.nothing(t.chosen_type()),
    "randomAlphabeticChars": lambda t: _random_text(t, prf.LETTERS),
    "randomNumericChars": lambda t: _random_text(t, prf.DIGITS),
    "randomInts": lambda t: drawing.whole(
        t.value, t.row_seed, t.bounds("int", drawing.DEFAULT_INT_BOUNDS), "int"),
    "randomLongs": lambda t: drawing.whole(
        t.value, t.row_seed, t.bounds("long", drawing.DEFAULT_LONG_BOUNDS), "bigint"),
    "randomFloats": lambda t: drawing.real(
        t.value, t.row_seed, t.bounds("float", drawing.DEFAULT_REAL_BOUNDS), "float"),
    "randomDoubles": lambda t: drawing.real(
        t.value, t.row_seed, t.bounds("double", drawing.DEFAULT_REAL_BOUNDS), "double"),
    "randomDates": lambda t: drawing.day(
        t.value, t.row_seed, t.bounds("date", drawing.DEFAULT_DATE_BOUNDS)),
    "randomBooleans": lambda t: drawing.boolean(t.value, t.row_seed),
    "hashWithSha1": lambda t: blanking.sha1(t.text, t.salt()),
    "hashWithSha256": lambda t: blanking.sha256(t.text, t.salt()),
    "consistentNumericFormatPreserving": lambda t: fpe.number_column(t.value, t.dtype, t.key, True),
    "consistentStringFormatPreserving": lambda t: fpe.text_column(t.text, fpe.TEXT_ALPHABET, t.key, True),
    "consistentNumericFormatPreservingDecryption": lambda t: fpe.number_column(t.value, t.dtype, t.key, False),
    "consistentStringFormatPreservingDecryption": lambda t: fpe.text_column(
        t.text, fpe.TEXT_ALPHABET, t.key, False),
}

ALL_METHODS = (*METHODS, PERMUTATION)


def _check(df: DataFrame, rules: Sequence[Rule]) -> None:
    for rule in rules:
        if rule.method not in ALL_METHODS:
            raise ValueError(f"unknown masking method {rule.method!r} for column {rule.column!r}")
        if rule.column not in df.columns:
            raise ValueError(f"no column {rule.column!r} among {df.columns}")


def masked_column(df: DataFrame, column: str, rules: Sequence[Rule], context: MaskContext) -> Column:
    """The rules of one column composed in order into one expression."""
    value, dtype = F.col(column_path(column)), df.schema[column].dataType
    for rule in rules:
        if isinstance(dtype, StringType):
            value = null_words(value)
        value = METHODS[rule.method](_Target(column, value, dtype, rule.options, context))
        if rule is not rules[-1]:
            dtype = df.select(value.alias(column)).schema[column].dataType
    return value


def masked_columns(df: DataFrame, rules: Sequence[Rule], context: MaskContext) -> dict[str, Column]:
    """One expression for each column that has a rule (permutations aside)."""
    _check(df, rules)
    by_column: dict[str, list[Rule]] = {}
    for rule in rules:
        if rule.method != PERMUTATION and context.names_table(rule.method) is None:
            by_column.setdefault(rule.column, []).append(rule)
    return {c: masked_column(df, c, column_rules, context) for c, column_rules in by_column.items()}


def permuted(
    df: DataFrame, rules: Sequence[Rule], context: MaskContext, where: Column | None = None
) -> DataFrame:
    """The permutations and tables of names among the rules, over all rows or those that meet a condition."""
    moved: dict[str, str] = {}
    for rule in rules:
        names = context.names_table(rule.method)
        if names is None and rule.method != PERMUTATION:
            continue
        what = "names for" if names is not None else "a permutation of"
        if not context.row_key:
            raise ValueError(f"{what} {rule.column!r} needs the columns that identify a row")
        key = prf.column_key(context.key, rule.options.get("domain") or rule.column)
        if names is None and rule.column not in moved and rule.column not in context.row_key:
            # Different columns, and none that identifies rows, can be moved at the same time.
            moved[rule.column] = key
            continue
        if names is not None and sum(other.column == rule.column for other in rules) > 1:
            raise ValueError(f"names of a table are the only mask of a column, not one of several: {rule.column!r}")
        if moved:
            df, moved = permute_all(df, list(moved.items()), context.row_key, where), {}
        if names is not None:
            df = replace_by_names(df, rule.column, names, key, context.row_key, where)
        else:
            df = permute(df, rule.column, key, context.row_key, where)
    return permute_all(df, list(moved.items()), context.row_key, where) if moved else df


def apply_rules(df: DataFrame, rules: Sequence[Rule], context: MaskContext) -> DataFrame:
    """Mask a table: one projection for all row masks.

    Permutations need a shuffle and run first, while the row key is unmasked.
    """
    _check(df, rules)
    df = permuted(df, rules, context)
    masked = masked_columns(df, rules, context)
    if not masked:
        return df
    return df.select(
        *[masked[c].alias(c) if c in masked else F.col(column_path(c)) for c in df.columns]
    )
