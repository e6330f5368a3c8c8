"""Partition maintenance of catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from lethe.identifiers import quote, quote_table, string_literal

# Partitions dropped by one statement, so that no statement grows without bound.
_DROP_BATCH = 500


class PartitionError(RuntimeError):
    """Some partitions could not be dropped; ``failures`` lists value and reason."""

    def __init__(self, table: str, failures: Sequence[tuple[str, str]], report: DataFrame | None = None):
        self.table, self.failures, self.report = table, list(failures), report
        values = ", ".join(value for value, _ in failures)
        super().__init__(f"{len(failures)} partition(s) of {table} not dropped: {values}")


def _clause(column: str, value: str) -> str:
    return f"PARTITION ({quote(column)}={string_literal(value)})"


def add_partition(spark: SparkSession, table: str, value: str, location: str, column: str = "dt") -> None:
    """Register a partition at a location unless it is there already."""
    spark.sql(
        f"ALTER TABLE {quote_table(table)} ADD IF NOT EXISTS "
        f"{_clause(column, value)} LOCATION {string_literal(location)}"
    )


def drop_partition(spark: SparkSession, table: str, column: str, value: str) -> None:
    """Drop one partition if it exists."""
    spark.sql(f"ALTER TABLE {quote_table(table)} DROP IF EXISTS {_clause(column, value)}")


def existing_partitions(spark: SparkSession, table: str, column: str) -> list[str]:
    """Values of a partition column known to the catalog (the data is not read)."""
    rows = spark.sql(f"SHOW PARTITIONS {quote_table(table)}").collect()
    specs = (dict(part.split("=", 1) for part in row.partition.split("/")) for row in rows)
    return sorted({spec[column] for spec in specs if column in spec})


def is_external(spark: SparkSession, table: str) -> bool:
    """Does the table leave its files behind when a partition is dropped?"""
    rows = spark.sql(f"DESCRIBE EXTENDED {quote_table(table)}").where("col_name = 'Type'").collect()
    return any(row.data_type.upper() == "EXTERNAL" for row in rows)


def drop_partitions(
    spark: SparkSession, table: str, column: str, values: Sequence[str], drop_one=drop_partition
) -> DataFrame:
    """Drop many partitions, going on after failures.

    Values go out in batches of one statement each; when a batch fails its values
    are tried one by one. Returns (value, ok, error) when all went well and raises
    ``PartitionError`` at the end otherwise.
    """
    results: list[tuple[str, bool, str | None]] = []
    values = list(values)
    for start in range(0, len(values), _DROP_BATCH):
        batch = values[start : start + _DROP_BATCH]
        if drop_one is drop_partition:
            clauses = ", ".join(_clause(column, v) for v in batch)
            try:
                spark.sql(f"ALTER TABLE {quote_table(table)} DROP IF EXISTS {clauses}")
                results += [(v, True, None) for v in batch]
                continue
            except Exception:  # noqa: BLE001 - each value is retried and reported below
                pass
        for value in batch:
            try:
                drop_one(spark, table, column, value)
                results.append((value, True, None))
            except Exception as error:  # noqa: BLE001 - reported to the caller at the end
                results.append((value, False, str(error)))
    report = spark.createDataFrame(results, "value string, ok boolean, error string")
    failures = [(value, error or "") for value, ok, error in results if not ok]
    if failures:
        raise PartitionError(table, failures, report)
    return report
