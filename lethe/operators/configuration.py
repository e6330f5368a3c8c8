"""Queries over the typed configuration table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from lethe.functions.calendar import DAY_FORMATS
from lethe.operators.options import parse_options
from lethe.sources.config import CONFIG_COLUMNS
from lethe.specs import EventClock, InputSpec, OutputSpec, Rule, TablePlan

# Configuration columns that describe one masked column.
RULE_COLUMNS = (
    "column_name",
    "anonymisation_methode",
    "anonymisation_methode_options",
    "anonymisation_methode_options_values",
)
TABLE_KEY = ("base", "table_name")
_TABLE_COLUMNS = tuple(c for c in CONFIG_COLUMNS if c not in RULE_COLUMNS + TABLE_KEY)

# The trigger whose clock is the run date, and the suffix of masked tables.
EXECUTION_TRIGGER = "execution"
MASKED_SUFFIX = "_desensitized"


def rules_for(config: DataFrame, base: str, table: str) -> DataFrame:
    """The configuration rows of one table."""
    return config.where((F.col("base") == base) & (F.col("table_name") == table))


def tables(config: DataFrame) -> DataFrame:
    """Distinct (base, table)."""
    return config.select(*TABLE_KEY).distinct()


def plan_rows(config: DataFrame) -> DataFrame:
    """One row per table: its rules in column order, its settings, and how many different ones it has."""
    rule = F.struct(*RULE_COLUMNS)
    settings = F.struct(*_TABLE_COLUMNS)
    return config.groupBy(*TABLE_KEY).agg(
        F.array_sort(F.collect_list(rule)).alias("rules"),
        F.min_by(settings, rule).alias("settings"),
        F.size(F.collect_set(settings)).alias("n_settings"),
    )


def _source(row: Row, table: str, prefix: str) -> InputSpec:
    s = row.asDict()
    return InputSpec(
        format=s[f"{prefix}input_format"] or "table",
        path=s[f"{prefix}input_path"] or None,
        table=table,
        partition_column=s[f"{prefix}partition_column"] or "dt",
    )


def _plan(row: Row) -> TablePlan:
    s, name = row.settings, f"{row.base}.{row.table_name}"
    if row.n_settings > 1:
        raise ValueError(f"{name}: the rows of the table have {row.n_settings} different settings")
    if not s.declencheur:
        raise ValueError(f"{name}: no trigger is given")
    for wanted in ("partition_value_format", "output_format"):
        if not s[wanted]:
            raise ValueError(f"{name}: {wanted} is missing")
    if s.conserv_duration is None:
        raise ValueError(f"{name}: conserv_duration is not a whole number of months")
    if s.purge_boolean and s.purge_duration is None:
        raise ValueError(f"{name}: purge_duration is not a whole number of months")
    clock = None
    if s.declencheur != EXECUTION_TRIGGER:
        clock = EventClock(
            source=_source(s, f"{s.declench_database_name}.{s.declench_table_name}", "declench_"),
            value_format=s.declench_partition_column_value_format,
            join_column=s.declench_column_join,
            process_column=s.declench_column_process,
            process_format=s.declench_column_process_value_format,
            frequency=s.declench_table_frequency,
            min_value=s.declench_column_process_min_value or None,
        )
    if clock is not None and clock.process_format not in DAY_FORMATS:
        raise ValueError(f"{name}: unknown event date format {clock.process_format!r}")
    # The source's partitions are partitions of the output too, so that a run replaces its own months only.
    source_column = s.partition_column or "dt"
    output_column = s.output_partitioned_by or source_column
    rules = tuple(
        Rule(r.column_name, r.anonymisation_methode,
             parse_options(r.anonymisation_methode_options, r.anonymisation_methode_options_values))
        for r in row.rules
        if r.anonymisation_methode
    )
    return TablePlan(
        base=row.base,
        table=row.table_name,
        source=_source(s, name, ""),
        output=OutputSpec(
            format=s.output_format,
            path=s.output_path or None,
            table=f"{name}{MASKED_SUFFIX}",
            partition_column=output_column,
            mode="overwrite_partitions",
            rebalance=output_column != source_column,
            further_columns=() if output_column == source_column else (source_column,),
        ),
        partition_format=s.partition_value_format,
        keep_months=s.conserv_duration,
        purge_months=s.purge_duration,
        purge=bool(s.purge_boolean),
        trigger=s.declencheur,
        rules=rules,
        clock=clock,
    )


def plans(config: DataFrame) -> list[TablePlan]:
    """Table plans on the driver: one row per table of the configuration."""
    rows = plan_rows(config).collect()
    return [_plan(row) for row in sorted(rows, key=lambda r: (r.base, r.table_name))]
