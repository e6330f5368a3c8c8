"""The configuration table: one row per column to protect."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lethe.sources.readers import load
from lethe.specs import InputSpec

# The columns of the configuration table, in file order.
CONFIG_COLUMNS = (
    "base",
    "table_name",
    "column_name",
    "input_path",
    "input_format",
    "partition_column",
    "partition_column_type",
    "partition_value_format",
    "output_path",
    "output_format",
    "output_partitioned_by",
    "anonomysed_data",
    "conserv_duration",
    "purge_duration",
    "purge_boolean",
    "anonymisation_methode",
    "anonymisation_methode_options",
    "anonymisation_methode_options_values",
    "declencheur",
    "declench_database_name",
    "declench_table_name",
    "declench_input_path",
    "declench_input_format",
    "declench_partition_column",
    "declench_partition_column_type",
    "declench_partition_column_value_format",
    "declench_column_join",
    "declench_column_process",
    "declench_column_process_value_format",
    "declench_table_frequency",
    "declench_column_process_min_value",
    "processing_frequency",
    "commentaire",
    "avis_metier",
    "avis_confirmite",
    "finality",
    "user_typology",
    "concerned_processing",
)

# Columns without which a row says nothing.
REQUIRED_COLUMNS = ("base", "table_name", "column_name")

# Phrases of the two banner lines in the exported sheet.
CONFIG_BANNERS = (
    "Données à compléter par le Métier",
    "Commentaire,données à anonymiser",
)

_INT_COLUMNS = ("conserv_duration", "purge_duration")


def typed_config(config: DataFrame) -> DataFrame:
    """Trim every text, type durations and the purge switch, add absent columns as nulls."""
    absent = [c for c in REQUIRED_COLUMNS if c not in config.columns]
    if absent:
        raise ValueError(f"the configuration lacks the columns {absent}")
    out = []
    for name in CONFIG_COLUMNS:
        value = F.trim(F.col(name).cast("string")) if name in config.columns else F.lit(None).cast("string")
        if name in _INT_COLUMNS:
            value = value.try_cast("int")
        elif name == "purge_boolean":
            value = F.coalesce(F.lower(value) == "true", F.lit(False))
        out.append(value.alias(name))
    return config.select(*out)


def load_config(spark: SparkSession, spec: InputSpec, run_date: date) -> DataFrame:
    """The configuration rows of the month of the run."""
    month = run_date.strftime("%Y%m")
    return typed_config(load(spark, replace(spec, partition_values=(month,))))


def clean_config_csv(
    lines: DataFrame,
    schema: StructType | str,
    banners: Sequence[str] = CONFIG_BANNERS,
    delimiter: str = ",",
) -> DataFrame:
    """Drop banner and empty lines of an exported sheet, then parse what is left.

    ``lines`` is a text DataFrame with the single column ``value``.
    """
    ddl = schema if isinstance(schema, str) else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema
    )
    keep = F.length("value") > 0
    for phrase in banners:
        keep = keep & ~F.col("value").contains(phrase)
    parsed = F.from_csv("value", ddl, {"sep": delimiter})
    return lines.where(keep).select(parsed.alias("row")).select("row.*")
