"""Proof that a masked copy holds the rows of the original, and holds them masked.

Rows are compared as multisets, by sums of row hashes for each partition, so neither side is sorted or joined and the sums of
files, partitions and tasks add up. The columns without a rule have to agree. A masked column
is proven when masking the original again, under the key of the run or a former one, gives the written values; a
rule whose result cannot be repeated (a permutation, a salt drawn for one run), or one that was changed since, is proven by the cells:
rows are found by the hash of their other columns, and a column fails where more of its cells are unchanged
than half way between chance and all of them. Chance is taken from the distribution of the original values, so a column of few
values is not mistaken for an unmasked one, and a column of one value proves nothing and stops nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lethe.identifiers import column_path
from lethe.operators.masking import PERMUTATION, MaskContext, apply_rules
from lethe.specs import Rule

_PART, _ROW, _COUNT = "__part", "__row", "__count"
_HASH_TYPE = "decimal(20,0)"


def _texts(columns: Sequence[str]) -> list[Column]:
    # As texts, so that formats without types compare; the marker keeps null apart from empty text.
    return [F.coalesce(F.concat(F.lit("="), F.col(column_path(c)).cast("string")), F.lit("-")) for c in columns]


def row_hash(columns: Sequence[str], salt: int = 0) -> Column:
    return F.xxhash64(F.lit(salt), *_texts(columns))


def digest(columns: Sequence[str]) -> Column:
    """Two sums of independent 64-bit row hashes: equal for equal multisets of rows, whatever their order."""
    return F.concat_ws(":", *[F.sum(row_hash(columns, salt).cast(_HASH_TYPE)).cast("string") for salt in (0, 1)])


def digests(df: DataFrame, partition: str, **columns: Sequence[str]) -> dict[str, dict]:
    """Rows and named digests of each partition: a row on the driver for each."""
    found = df.groupBy(F.col(column_path(partition)).cast("string").alias(_PART)).agg(
        F.count("*").alias(_COUNT), *[digest(cols).alias(name) for name, cols in columns.items()])
    return {row[_PART]: row.asDict() for row in found.collect()}


def repeatable(rule: Rule) -> bool:
    """Does masking again give the same result?"""
    return rule.method != PERMUTATION and rule.options.get("salt") != "random"


def unchanged_shares(
    original: DataFrame, written: DataFrame, partition: str, unmasked: Sequence[str], columns: Sequence[str]
) -> dict[str, dict[str, tuple[float, float] | None]]:
    """Partition -> column -> (share of unchanged cells, share by chance); None where no cell can be compared.

    Cells without a value do not count. Rows whose other columns occur more than once in a partition cannot be told apart and do not count.
    """

    def single(df: DataFrame, prefix: str) -> DataFrame:
        values = [F.col(column_path(c)).cast("string").alias(f"{prefix}{i}") for i, c in enumerate(columns)]
        rows = df.select(F.col(column_path(partition)).cast("string").alias(_PART), row_hash(unmasked).alias(_ROW), *values)
        return rows.groupBy(_PART, _ROW).agg(
            F.count("*").alias(_COUNT), *[F.any_value(f"{prefix}{i}").alias(f"{prefix}{i}") for i in range(len(columns))]
        ).where(F.col(_COUNT) == 1).drop(_COUNT)

    pairs = single(original, "o").join(single(written, "w"), [_PART, _ROW])
    has, same = (lambda i: F.col(f"o{i}").isNotNull()), (lambda i: F.col(f"o{i}").eqNullSafe(F.col(f"w{i}")))
    counts = pairs.groupBy(_PART).agg(
        *[F.count_if(has(i)).alias(f"n{i}") for i in range(len(columns))],
        *[F.count_if(has(i) & same(i)).alias(f"s{i}") for i in range(len(columns))])
    chances: dict[tuple[str, int], float] = {}
    for i, c in enumerate(columns):
        value = F.col(column_path(c)).cast("string")
        sizes = original.where(value.isNotNull()).groupBy(
            F.col(column_path(partition)).cast("string").alias(_PART), value.alias("v")).agg(F.count("*").alias("n"))
        total = sizes.groupBy(_PART).agg((F.sum(F.col("n").cast("double") ** 2) / F.sum("n").cast("double") ** 2).alias("chance"))
        chances |= {(row[_PART], i): row["chance"] for row in total.collect()}
    return {
        row[_PART]: {c: (row[f"s{i}"] / row[f"n{i}"], chances.get((row[_PART], i), 0.0)) if row[f"n{i}"] else None
                     for i, c in enumerate(columns)}
        for row in counts.collect()}


def _stay_clear(shares: dict[str, tuple[float, float] | None], columns: Sequence[str]) -> list[str]:
    """Columns whose cells do not show a mask."""
    return [c for c in columns if shares.get(c) is not None and 1 > shares[c][1] and shares[c][0] > (1 + shares[c][1]) / 2]


def unproven(
    original: DataFrame, written: DataFrame, partition: str, rules: Sequence[Rule], context: MaskContext,
    former_keys: Sequence[str] = (),
) -> dict[str, str]:
    """Partitions of ``original`` for which ``written`` is not proven to be the masked copy, each with the reason."""
    masked = list(dict.fromkeys(rule.column for rule in rules))
    unmasked = [c for c in original.columns if c not in masked and c != partition]
    again = [rule for rule in rules if repeatable(rule)]
    fixed = {rule.column for rule in rules if not repeatable(rule)}
    same = [c for c in masked if c not in fixed]
    before = digests(original, partition, plain=unmasked)
    after = digests(written, partition, plain=unmasked, full=[*unmasked, *same])
    reasons: dict[str, str] = {}
    for part, row in before.items():
        if part not in after or after[part][_COUNT] != row[_COUNT]:
            reasons[part] = "the masked output does not hold as many rows"
        elif after[part]["plain"] != row["plain"]:
            reasons[part] = "columns without a mask differ"
    wanted = [p for p in before if p not in reasons]
    open_ = set(wanted)
    for key in (context.key, *former_keys):
        if not same or not open_:
            break
        rows = original.where(F.col(column_path(partition)).cast("string").isin(sorted(open_)))
        # Rules of a column that also has a rule of the other kind are proven by its cells.
        repeated = apply_rules(rows, [rule for rule in again if rule.column in same], replace(context, key=key))
        found = digests(repeated, partition, full=[*unmasked, *same])
        open_ -= {p for p, row in found.items() if row["full"] == after[p]["full"]}
    if not same:
        open_ = set()
    by_cells = wanted if fixed else sorted(open_)
    if by_cells:
        where = lambda df: df.where(F.col(column_path(partition)).cast("string").isin(sorted(by_cells)))
        shares = unchanged_shares(where(original), where(written), partition, unmasked, masked)
        for part in by_cells:
            columns = masked if part in open_ else sorted(fixed)
            clear = _stay_clear(shares.get(part, {}), columns)
            if part not in shares and before[part][_COUNT]:
                reasons[part] = "no row can be told from the others, so no mask is proven"
            elif clear:
                reasons[part] = f"cells of {', '.join(clear)} are unchanged"
    return reasons
