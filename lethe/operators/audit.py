"""Audit rows of masking and purge runs."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lethe.identifiers import column_path
from lethe.operators.configuration import RULE_COLUMNS, TABLE_KEY
from lethe.sinks.catalog import add_partition
from lethe.sinks.writers import save
from lethe.sources.readers import load
from lethe.specs import InputSpec, OutputSpec

# Audit columns, in table order.
MASK_AUDIT_COLUMNS = (
    "dataBaseName",
    "tableName",
    "columnNames",
    "desensitizationMethods",
    "desensitizationMethodsOptions",
    "desensitizationMethodsOptionsValue",
    "desensitized_partitions",
    "input_row_count",
    "output_row_count",
    "processing_time",
    "start_date",
    "end_date",
    "principalKeytab",
    "dt",
)
PURGE_AUDIT_COLUMNS = (
    "dataBaseName",
    "tableName",
    "columnNames",
    "purged_partitions",
    "input_row_count",
    "output_row_count",
    "processing_time",
    "start_date",
    "end_date",
    "principalKeytab",
    "dt",
)
AUDIT_DAY_FORMAT = "%Y-%m-%d"
# Partition columns below the day, so that a repeated run replaces its own rows.
RUN_ID, TABLE_ID = "run_id", "table_id"

logger = logging.getLogger(__name__)

_LIST_NAMES = MASK_AUDIT_COLUMNS[2:6]


def audit_lists(config: DataFrame) -> DataFrame:
    """Per table the columns, methods, options and option values as lists in the same order."""
    rule = F.struct(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in RULE_COLUMNS])
    grouped = config.groupBy(*[F.col(k).alias(n) for k, n in zip(TABLE_KEY, MASK_AUDIT_COLUMNS)]).agg(
        F.array_sort(F.collect_list(rule)).alias("rules")
    )
    lists = [F.col(f"rules.{c}").alias(n) for c, n in zip(RULE_COLUMNS, _LIST_NAMES)]
    return grouped.select("dataBaseName", "tableName", *lists)


def row_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows in and rows out."""
    sides = before.select(F.lit(1).alias("i"), F.lit(0).alias("o")).union(
        after.select(F.lit(0).alias("i"), F.lit(1).alias("o"))
    )
    return sides.agg(
        F.coalesce(F.sum("i"), F.lit(0)).alias("input_row_count"),
        F.coalesce(F.sum("o"), F.lit(0)).alias("output_row_count"),
    )


@dataclass(frozen=True)
class TableRun:
    """What one job did to one table."""

    base: str
    table: str
    partitions: tuple[str, ...]
    rows_in: int
    rows_out: int
    start: datetime
    end: datetime
    unreadable_events: int = 0
    kept: tuple[str, ...] = ()


def _audit(
    config: DataFrame, runs: Sequence[TableRun], principal: str, partition_name: str, columns: Sequence[str]
) -> DataFrame:
    """One row for each table run, next to the lists of the configuration."""
    schema = (
        f"dataBaseName string, tableName string, {partition_name} array<string>, input_row_count bigint, "
        "output_row_count bigint, processing_time double, start_date timestamp, end_date timestamp, "
        "principalKeytab string, dt string"
    )
    rows = [
        (r.base, r.table, list(r.partitions), r.rows_in, r.rows_out, (r.end - r.start).total_seconds(),
         r.start, r.end, principal, r.end.strftime(AUDIT_DAY_FORMAT))
        for r in runs
    ]
    done = config.sparkSession.createDataFrame(rows, schema)
    return audit_lists(config).join(done, ["dataBaseName", "tableName"]).select(*columns)


def mask_audit(config: DataFrame, runs: Sequence[TableRun], principal: str) -> DataFrame:
    """Audit of masked tables: rows read and rows written."""
    return _audit(config, runs, principal, "desensitized_partitions", MASK_AUDIT_COLUMNS)


def purge_audit(config: DataFrame, runs: Sequence[TableRun], principal: str) -> DataFrame:
    """Audit of purged tables: rows of the partitions before and after."""
    return _audit(config, runs, principal, "purged_partitions", PURGE_AUDIT_COLUMNS)


def union_audits(audits: Sequence[DataFrame]) -> DataFrame:
    """Audits of several tables, matched by column name."""
    return reduce(DataFrame.unionByName, audits)


def _earlier(spark: SparkSession, spec: OutputSpec, run_id: str, table_id: str) -> tuple[bool, Row | None]:
    """Whether the saved audits are laid out by run and table (or there are none), and what an earlier attempt has saved."""
    source = InputSpec(
        format={"csvWithoutHeader": "csv"}.get(spec.format, spec.format), path=spec.path, table=spec.table,
        delimiter=spec.delimiter, partition_column=spec.partition_column)
    if spec.format == "table" and not spark.catalog.tableExists(spec.table):
        return True, None
    try:
        saved = load(spark, source)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            return True, None
        raise
    if RUN_ID not in saved.columns:
        return False, None
    mine = saved.where((F.col(RUN_ID) == run_id) & (F.col(TABLE_ID) == table_id))
    # One row at most, from the one folder of this run and table.
    return True, mine.withColumn(spec.partition_column, F.col(column_path(spec.partition_column)).cast("string")).first()


def _with_earlier(audit: DataFrame, row: Row) -> DataFrame:
    """The audit of a purge together with what the earlier attempt has dropped: what is gone is not dropped twice."""
    sums = ("input_row_count", "output_row_count", "processing_time")
    dropped = F.array(*[F.lit(v) for v in row["purged_partitions"]]).cast("array<string>")
    return audit.withColumns({
        "purged_partitions": F.array_sort(F.array_union("purged_partitions", dropped)),
        "start_date": F.least("start_date", F.lit(row["start_date"])), **{c: F.col(c) + F.lit(row[c]) for c in sums}})


def replace_audit(audit: DataFrame, spec: OutputSpec, run_id: str, table_id: str, whole: bool = False) -> None:
    """Save the audit of one table in one run, in the place of what an earlier attempt of that run has saved.

    Audits lie in a partition of their own for each run and table, below the day of the first attempt; a repeated run
    overwrites that partition, which Spark stages and then swaps, and no other. Tables that end at the same time
    write different partitions. A purge adds to what earlier attempts have dropped, unless the audit is ``whole`` and
    names that already. Without a partition column, and where audits are saved already that are not laid out like this,
    rows are appended as before.
    """
    if not spec.partition_column:
        append_audit([audit], spec)
        return
    laid_out, earlier = _earlier(audit.sparkSession, spec, run_id, table_id)
    if not laid_out:
        logger.warning("%s holds audits without run identities: a repeated run adds to them", spec.path or spec.table)
        append_audit([audit], spec)
        return
    if earlier is not None:
        if "purged_partitions" in audit.columns and not whole:
            audit = _with_earlier(audit, earlier)
        audit = audit.withColumn(spec.partition_column, F.lit(earlier[spec.partition_column]))
    audit = audit.withColumns({RUN_ID: F.lit(run_id), TABLE_ID: F.lit(table_id)})
    append_audit([audit], replace(spec, mode="overwrite_partitions", further_columns=(*spec.further_columns, RUN_ID, TABLE_ID)))


def append_audit(audits: Sequence[DataFrame], spec: OutputSpec) -> None:
    """Append the audits of a run; register their partitions when a table stands over the path."""
    if not audits:
        return
    audit = union_audits(audits)
    save(audit, spec)
    if spec.format != "table" and spec.table and spec.path and spec.partition_column:
        spark = audit.sparkSession
        # A run spans one or two days, so this is one or two values.
        for row in audit.select(spec.partition_column).distinct().collect():
            location = f"{spec.path.rstrip('/')}/{spec.partition_column}={row[0]}"
            add_partition(spark, spec.table, row[0], location, spec.partition_column)
