"""Which partitions of a table can hold which persons, so that a daily run opens only those.

For every partition the index has the distinct prefixes of its persons' keyed hashes and a stamp of its files (names, sizes,
times). A run compares the stamps, which takes a listing and opens no file, indexes the partitions that
are new or were written since, and asks for those that share a prefix with its persons. A prefix is 32 bits:
an accidental match costs one partition more, never a person. The index belongs to an epoch of the key, as the hashes do.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lethe.identifiers import column_path
from lethe.operators.persons import PERSON, epoch_of, person_hash
from lethe.sinks.writers import dynamic_overwrite
from lethe.sources.readers import load, string_partitions
from lethe.specs import InputSpec, Run

_FOLDER = "_person_index"
_PART, _PREFIX, _STAMP = "__part", "prefix", "stamp"
_SCHEMA = f"{_PREFIX} long, {_STAMP} long, {_PART} string"
_PREFIX_DIGITS = 8


def index_path(history: str, run: Run) -> str:
    return f"{history}{_FOLDER}/epoch={epoch_of(run.key)}"


def _prefix(hashed: Column) -> Column:
    return F.conv(F.substring(hashed, 1, _PREFIX_DIGITS), 16, 10).cast("bigint")


def stamps(spark: SparkSession, source: InputSpec) -> DataFrame:
    """Partition and stamp of each partition of files below a path; only names are read."""
    with string_partitions(spark):
        files = spark.read.format("binaryFile").load(source.path)
    if source.partition_column not in files.columns:
        raise ValueError(f"{source.path} has no folders {source.partition_column}=...: an index of persons needs them")
    one = F.xxhash64("path", "length", "modificationTime")
    return files.groupBy(F.col(column_path(source.partition_column)).cast("string").alias(_PART)).agg(
        F.bit_xor(one).alias(_STAMP))


def _stored(spark: SparkSession, path: str) -> DataFrame:
    try:
        with string_partitions(spark):
            return spark.read.schema(_SCHEMA).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        return spark.createDataFrame([], _SCHEMA)


def refresh(spark: SparkSession, source: InputSpec, person_column: str, path: str, run: Run) -> int:
    """Index the partitions that are new or have changed; how many there were."""
    known = _stored(spark, path).groupBy(_PART).agg(F.max(_STAMP).alias("known"), F.min(_STAMP).alias("least"))
    now = stamps(spark, source)
    same = (F.col("known") == F.col(_STAMP)) & (F.col("least") == F.col(_STAMP))
    changed = now.join(known, _PART, "left").where(~F.coalesce(same, F.lit(False))).select(_PART, _STAMP)
    # One row for each partition of the table, at most.
    todo = [row[_PART] for row in changed.collect()]
    if not todo:
        return 0
    rows = load(spark, source)
    column = F.col(column_path(source.partition_column)).cast("string")
    rows = rows.where(column.isin([v for v in todo if v is not None]) | (column.isNull() if None in todo else F.lit(False)))
    prefixes = rows.select(column.alias(_PART), _prefix(person_hash(run.key, F.col(column_path(person_column)))).alias(_PREFIX)).distinct()
    # A partition without persons keeps a row without prefix, so that it is not looked through again.
    entries = changed.join(prefixes, changed[_PART].eqNullSafe(prefixes[_PART]), "left").select(prefixes[_PREFIX], changed[_STAMP], changed[_PART])
    with dynamic_overwrite(spark):
        entries.repartition(_PART).sortWithinPartitions(_PREFIX).write.partitionBy(_PART).mode("overwrite").parquet(path)
    return len(todo)


def partitions_of(spark: SparkSession, path: str, persons: DataFrame) -> list[str]:
    """Partitions that can hold some of the persons (column ``PERSON``, hashed under the run's key)."""
    wanted = persons.select(_prefix(F.col(PERSON)).alias(_PREFIX)).distinct()
    found = _stored(spark, path).join(wanted, _PREFIX, "left_semi").select(_PART).distinct().collect()
    return sorted(row[_PART] for row in found if row[_PART] is not None)
