"""Checked and quoted names for the few statements that have no DataFrame form."""

from __future__ import annotations

import re

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def quote(name: str) -> str:
    """Back-quote one identifier after checking that it is a plain name."""
    if not _NAME.fullmatch(name):
        raise ValueError(f"not a plain identifier: {name!r}")
    return f"`{name}`"


def quote_table(name: str) -> str:
    """Back-quote a table name of one or more dotted parts."""
    return ".".join(quote(part) for part in name.split("."))


def column_path(name: str) -> str:
    """Back-quote a top-level column so that dots in its name are literal."""
    return "`" + name.replace("`", "``") + "`"


def string_literal(text: str) -> str:
    """A SQL string literal for partition values and locations in DDL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
