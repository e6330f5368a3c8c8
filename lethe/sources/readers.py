"""Load a DataFrame by format name."""

from __future__ import annotations

import re
from collections.abc import Sequence
from contextlib import AbstractContextManager
from datetime import datetime

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    IntegralType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from lethe.identifiers import column_path
from lethe.session import setting
from lethe.specs import InputSpec

# Defaults of the file formats.
CSV_DELIMITER = ","
JSON_TIMESTAMP_FORMAT = "yyyy/MM/dd HH:mm:ss ZZ"

# Tasks of rows that are spread, for each core.
TASKS_A_CORE = 4

# How partition formats write a day, or a month as its first day, by the length of the text.
_DAY_PATTERNS = {8: "%Y%m%d", 10: "%Y-%m-%d", 6: "%Y%m", 7: "%Y-%m"}
_INFERENCE = "spark.sql.sources.partitionColumnTypeInference.enabled"


def string_partitions(spark: SparkSession) -> AbstractContextManager[None]:
    """Read partition folders as strings: ``dt=0007`` must not become 7."""
    return setting(spark, _INFERENCE, "false")


def _located(spark: SparkSession, reader: DataFrameReader, spec: InputSpec) -> tuple[DataFrameReader, str | list[str]]:
    """Where to read from. To infer a schema only the wanted partition folders are opened, if they are there."""
    if spec.schema is not None or not spec.partition_values or not spec.path:
        return reader, spec.path
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    base = spec.path.rstrip("/")
    wanted = [f"{base}/{spec.partition_column}={value}" for value in spec.partition_values]
    files = hadoop.Path(base).getFileSystem(conf)
    found = [folder for folder in wanted if files.exists(hadoop.Path(folder))]
    return (reader.option("basePath", base), found) if found else (reader, spec.path)


def _read_csv(spark: SparkSession, spec: InputSpec) -> DataFrame:
    reader = (
        spark.read.option("sep", spec.delimiter or CSV_DELIMITER)
        .option("header", spec.header)
        .option("encoding", spec.encoding)
    )
    if spec.schema is not None:
        return reader.schema(spec.schema).csv(spec.path)
    reader, where = _located(spark, reader.option("inferSchema", True), spec)
    return reader.csv(where)


def _read_json(spark: SparkSession, spec: InputSpec) -> DataFrame:
    reader = spark.read.option("timestampFormat", JSON_TIMESTAMP_FORMAT)
    if spec.schema is not None:
        reader = reader.schema(spec.schema)
    reader, where = _located(spark, reader, spec)
    return reader.json(where)


def _read_self_describing(spark: SparkSession, spec: InputSpec) -> DataFrame:
    reader = spark.read.format(spec.format)
    if spec.schema is not None:
        reader = reader.schema(spec.schema)
    return reader.load(spec.path)


def _read_xml(spark: SparkSession, spec: InputSpec) -> DataFrame:
    reader = (
        spark.read.format("xml")
        .option("rootTag", spec.root_tag)
        .option("rowTag", spec.row_tag)
        .option("encoding", spec.encoding)
    )
    if spec.schema is not None:
        reader = reader.schema(spec.schema)
    reader, where = _located(spark, reader, spec)
    return reader.load(where)


def _partition_fields(lines: DataFrame) -> list[str]:
    return [name for name in lines.columns if name != "value"]


def _read_text(spark: SparkSession, spec: InputSpec) -> DataFrame:
    """Delimited text without header; the schema, or else the first line, gives the columns.

    A line with more fields is an error: dropping them would lose data.
    """
    lines = spark.read.text(spec.path)
    delimiter = (spec.delimiter or CSV_DELIMITER)[0]
    if spec.schema is not None:
        schema = spec.schema if isinstance(spec.schema, StructType) else StructType.fromDDL(spec.schema)
        names, types = schema.names, [f.dataType for f in schema]
    else:
        first = lines.select("value").head(1)
        width = len(first[0].value.split(delimiter)) if first else 0
        names, types = [f"col{i + 1}" for i in range(width)], [StringType()] * width
    split = F.split("value", re.escape(delimiter), -1)
    problem = F.raise_error(F.concat(F.lit(f"a line has more than {len(names)} fields: "), F.size(split).cast("string")))
    parts = F.when(F.size(split) <= len(names), split).otherwise(problem.cast("array<string>"))
    fields = [F.get(parts, i).cast(dtype).alias(name) for i, (name, dtype) in enumerate(zip(names, types))]
    return lines.select(*fields, *_partition_fields(lines))


def _read_positional(spark: SparkSession, spec: InputSpec) -> DataFrame:
    """Fixed-width text; a block that starts behind the end of its line is null."""
    if not spec.widths or any(w <= 0 for w in spec.widths):
        raise ValueError("fixed-width input needs positive block widths")
    lines = spark.read.text(spec.path)
    starts = [sum(spec.widths[:i]) for i in range(len(spec.widths))]
    names = [f"C{i}" for i in range(len(spec.widths))]
    if spec.header:
        first = lines.select("value").head(1)
        if first:
            header = first[0].value
            names = [header[s : s + w].strip() for s, w in zip(starts, spec.widths)]
            # Every file of the folder may carry the same header line.
            lines = lines.where(F.col("value") != F.lit(header))
    types = [StringType()] * len(names)
    if spec.schema is not None:
        schema = spec.schema if isinstance(spec.schema, StructType) else StructType.fromDDL(spec.schema)
        if len(schema) != len(names):
            raise ValueError("the schema and the block widths differ in length")
        names, types = schema.names, [f.dataType for f in schema]
    blocks = [
        F.when(F.length("value") > start, F.trim(F.substring("value", start + 1, width)))
        .cast(dtype)
        .alias(name)
        for start, width, name, dtype in zip(starts, spec.widths, names, types)
    ]
    return lines.select(*blocks, *_partition_fields(lines))


def _read_table(spark: SparkSession, spec: InputSpec) -> DataFrame:
    if not spec.table:
        raise ValueError("a table input needs a table name")
    return spark.table(spec.table)


READERS = {
    "csv": _read_csv,
    "json": _read_json,
    "orc": _read_self_describing,
    "parquet": _read_self_describing,
    "avro": _read_self_describing,
    "xml": _read_xml,
    "text": _read_text,
    "positional": _read_positional,
    "table": _read_table,
}


def in_partitions(df: DataFrame, column: str, values: Sequence[str]) -> Column:
    """Partition membership that Catalyst turns into a partition filter.

    The values are turned into the column's type, never the column into text, so the
    metastore can prune by them; a value that does not fit is an error.
    """
    if not values:
        raise ValueError("the list of partition values is empty")
    if column not in df.columns:
        raise ValueError(f"no partition column {column!r} among {df.columns}")
    return F.col(column_path(column)).isin([_partition_value(df.schema[column].dataType, v) for v in values])


def _partition_value(dtype: DataType, text: str):
    """A partition value of a plan in the type of the partition column."""
    if isinstance(dtype, StringType):
        return text
    if isinstance(dtype, IntegralType):
        return int(text)
    if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        day = datetime.strptime(text, _DAY_PATTERNS.get(len(text), "%Y-%m-%d"))
        return day.date() if isinstance(dtype, DateType) else day
    raise ValueError(f"partition value {text!r} cannot be turned into {dtype.simpleString()}")


def load(spark: SparkSession, spec: InputSpec) -> DataFrame:
    """Load by format name, restricted to the partition values when given."""
    reader = READERS.get(spec.format)
    if reader is None:
        raise ValueError(f"unknown input format {spec.format!r}; known: {sorted(READERS)}")
    with string_partitions(spark):
        df = reader(spark, spec)
    if spec.partition_values is not None:
        df = df.where(in_partitions(df, spec.partition_column, spec.partition_values))
    if spec.repartition > 0:
        df = df.repartition(spec.repartition)
    return df


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over all cores: a file of few row groups is read by as few tasks, which is too few for masks that cost far more than a shuffle."""
    return df.repartition(TASKS_A_CORE * df.sparkSession.sparkContext.defaultParallelism)


def load_columns(
    spark: SparkSession,
    spec: InputSpec,
    columns: Sequence[str],
    min_value: object | None = None,
    cond_column: str | None = None,
) -> DataFrame:
    """Chosen columns of some partitions, optionally with ``cond_column >= min_value``."""
    df = load(spark, spec)
    if cond_column and min_value not in (None, ""):
        dtype = df.schema[cond_column].dataType
        df = df.where(F.col(column_path(cond_column)) >= F.lit(min_value).cast(dtype))
    return df.select(*[F.col(column_path(c)) for c in columns])
