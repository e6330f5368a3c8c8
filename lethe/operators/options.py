"""Options of the masking methods as written in the configuration."""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

# Option names; the last one is an addition of this library.
OPTION_NAMES = (
    "respect_type",
    "data_type",
    "keep_domaine",
    "keep_indicator",
    "cell_phone",
    "remove_before_blank",
    "length",
    "char",
    "preserve_spaces",
    "int_bounds",
    "long_bounds",
    "float_bounds",
    "double_bounds",
    "date_bounds",
    "salt",
    "domain",
)

# A dot separates list items, except inside the brackets of bounds.
ITEM_SEPARATOR = r"\.(?![^\[]*\])"

_BOUND_TYPES = {"int": int, "long": int, "float": float, "double": float, "date": date.fromisoformat}


def parse_options(names: str | None, values: str | None) -> dict[str, str]:
    """Zip a dotted list of names with a dotted list of values.

    Lists of different length and unknown names are errors: a mask without its option
    may leave readable what the option was to hide.
    """
    if not (names or "").strip() and not (values or "").strip():
        return {}
    split_names = [n.strip() for n in re.split(ITEM_SEPARATOR, names or "")]
    split_values = [v.strip() for v in re.split(ITEM_SEPARATOR, values or "")]
    if len(split_names) != len(split_values):
        raise ValueError(f"{len(split_names)} option names but {len(split_values)} values: {names!r}, {values!r}")
    unknown = [name for name in split_names if name not in OPTION_NAMES]
    if unknown:
        raise ValueError(f"unknown masking options {unknown}; known: {OPTION_NAMES}")
    return dict(zip(split_names, split_values))


def options_map(names: Column, values: Column) -> Column:
    """The same pairing for a whole configuration: map of option name to value."""
    name_list = F.split(F.coalesce(names, F.lit("")), ITEM_SEPARATOR)
    value_list = F.split(F.coalesce(values, F.lit("")), ITEM_SEPARATOR)
    size = F.least(F.size(name_list), F.size(value_list))
    return F.map_from_arrays(
        F.transform(F.slice(name_list, F.lit(1), size), F.trim),
        F.transform(F.slice(value_list, F.lit(1), size), F.trim),
    )


def parse_bounds(text: str, kind: str) -> tuple:
    """``[low;high]`` in the type of the method."""
    parse = _BOUND_TYPES[kind]
    parts = text.strip()[1:-1].split(";")
    if len(parts) != 2:
        raise ValueError(f"bounds must look like [low;high], not {text!r}")
    return parse(parts[0].strip()), parse(parts[1].strip())


def to_type(name: str) -> DataType:
    """Data type named as in DDL."""
    return StructType.fromDDL(f"value {name}")["value"].dataType


def flag(options: Mapping[str, str], name: str, default: bool) -> bool:
    """A switch; only the text opposite to the default changes it."""
    if default:
        return options.get(name) != "false"
    return options.get(name) == "true"
