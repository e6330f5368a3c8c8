"""Save a DataFrame by format name."""

from __future__ import annotations

from contextlib import AbstractContextManager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from lethe.identifiers import quote_table
from lethe.session import setting
from lethe.sources.readers import CSV_DELIMITER, JSON_TIMESTAMP_FORMAT, load
from lethe.specs import InputSpec, OutputSpec

MODES = ("append", "overwrite_partitions")


def dynamic_overwrite(spark: SparkSession) -> AbstractContextManager[None]:
    """Let an overwriting insert replace only the partitions that occur in the data."""
    return setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic")


def _csv_options(writer: DataFrameWriter, spec: OutputSpec, header: bool) -> DataFrameWriter:
    return writer.format("csv").option("header", header).option("sep", spec.delimiter or CSV_DELIMITER)


WRITERS = {
    "csv": lambda w, s: _csv_options(w, s, s.header),
    "csvWithoutHeader": lambda w, s: _csv_options(w, s, False),
    "json": lambda w, s: w.format("json").option("timestampFormat", JSON_TIMESTAMP_FORMAT),
    "orc": lambda w, s: w.format("orc"),
    "parquet": lambda w, s: w.format("parquet"),
    "avro": lambda w, s: w.format("avro"),
    "table": lambda w, s: w.format("orc"),
}


def _save_table(df: DataFrame, writer: DataFrameWriter, spec: OutputSpec) -> None:
    """Catalog table stored as ORC, at a path when one is given."""
    if not spec.table:
        raise ValueError("a table output needs a table name")
    spark = df.sparkSession
    exists = spark.catalog.tableExists(spec.table)
    if spec.mode == "overwrite_partitions" and exists:
        columns = spark.table(spec.table).columns
        laid_out = {c.name for c in spark.catalog.listColumns(spec.table) if c.isPartition}
        if not set(spec.partitions) <= laid_out:
            raise ValueError(f"{spec.table} is not partitioned by {spec.partitions}: overwriting would lose other rows")
        # An insert into a table takes the overwrite mode from the session, not from the writer.
        with dynamic_overwrite(spark):
            df.select(*columns).write.insertInto(quote_table(spec.table), overwrite=True)
        return
    if spec.path:
        writer = writer.option("path", spec.path)
    writer.mode("append").saveAsTable(spec.table)


def save(df: DataFrame, spec: OutputSpec) -> None:
    """Write by format name, partitioned by the output column when there is one."""
    configure = WRITERS.get(spec.format)
    if configure is None:
        raise ValueError(f"unknown output format {spec.format!r}; known: {sorted(WRITERS)}")
    if spec.mode not in MODES:
        raise ValueError(f"unknown write mode {spec.mode!r}; known: {MODES}")
    if spec.mode == "overwrite_partitions" and not spec.partitions:
        raise ValueError("overwrite_partitions needs a partition column: without one it would replace everything")
    if spec.rebalance and spec.partitions:
        # Adaptive execution splits hot values and joins small ones.
        df = df.hint("rebalance", *spec.partitions)
    writer = configure(df.write, spec)
    if spec.partitions:
        writer = writer.partitionBy(*spec.partitions)
    if spec.format == "table":
        _save_table(df, writer, spec)
        return
    if not spec.path:
        raise ValueError("a file output needs a path")
    if spec.mode == "overwrite_partitions":
        writer = writer.option("partitionOverwriteMode", "dynamic").mode("overwrite")
    else:
        writer = writer.mode("append")
    writer.save(spec.path)


def convert(spark: SparkSession, source: InputSpec, target: OutputSpec) -> None:
    """Read one format and write another."""
    save(load(spark, source), target)
