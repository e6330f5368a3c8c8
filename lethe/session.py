"""Session settings that the jobs change for a moment, and those they want throughout."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from lethe.functions.prf import DERIVED_KEY_PATTERN

# Settings for a session that runs the jobs; the caller's own values win.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Checkpoints hold keys of persons: remove them when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Hash keys of columns are literals of the plan: keep them out of printed plans.
    "spark.sql.redaction.string.regex": DERIVED_KEY_PATTERN,
}

# The masking key; the name makes Spark hide the value wherever it lists settings.
KEY_SETTING = "spark.lethe.secret.key"


def recommended(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the settings that the jobs want."""
    for name, value in RECOMMENDED.items():
        builder = builder.config(name, value)
    return builder


def masking_key(spark: SparkSession, setting: str = KEY_SETTING) -> str:
    """The key that the caller put into a session setting."""
    key = spark.conf.get(setting, None)
    if not key:
        raise ValueError(f"set {setting} to the masking key")
    return key


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Change one session setting for the length of a block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
