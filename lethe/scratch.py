"""A folder for intermediate tables that every executor can reach."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_base: str | None = None


def _base(spark: SparkSession) -> str:
    global _local_base
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="lethe-")
        atexit.register(shutil.rmtree, _local_base, ignore_errors=True)
    return _local_base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared checkpoint folder of the session."""
    return f"{_base(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def scratch_database(spark: SparkSession, label: str) -> str:
    """A fresh database whose managed tables live under the shared folder."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{scratch_path(spark, name)}'")
    return name


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute once and keep in the checkpoint folder, safe from lost executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(_base(df.sparkSession))
    return df.checkpoint()
