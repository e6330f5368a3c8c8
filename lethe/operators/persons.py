"""The persons that event runs have masked, kept as keyed hashes from run to run.

Without this memory a later run, which sees the clear source again, would write the rows of
earlier persons in clear. The hashes belong to an epoch, named by a fingerprint of the key, and
within it to a run date, so a repeated run replaces its own persons and no others.

A hash under one key says nothing under another. A run with a new key therefore carries the persons
of all earlier epochs over: it hashes the persons that it can see in clear under the former and under the new key
and keeps those that the former epoch holds. Whoever it cannot see has no rows, and is looked for again by
each later run. A run that is not given the key of an epoch that has persons stops before it writes anything.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lethe.functions import prf
from lethe.specs import Run, TablePlan

PERSON = "__person"
_BEFORE = "__before"
_EPOCH, _DAY, _ORIGIN = "epoch", "run_date", "origin"
_SCHEMA = f"{PERSON} string, {_BEFORE} string, {_EPOCH} string, {_DAY} string, {_ORIGIN} string"
_OWN = "own"
# A leading underscore hides the folder from readers of the output.
_FOLDER = "_persons"
_FINGERPRINT_DIGITS = 16


class KeyEpochError(RuntimeError):
    """The history holds persons under a key that the run was not given."""


def person_hash(key: str, person: Column) -> Column:
    """Keyed hash of a person's key; null stays null, so it matches nobody."""
    return F.when(person.isNotNull(), prf.seed(prf.column_key(key, "person"), [person]))


def epoch_of(key: str) -> str:
    """Fingerprint of a key: names its epoch, tells nothing about the key."""
    return prf.column_key(key, "epoch")[:_FINGERPRINT_DIGITS]


def history_path(plan: TablePlan, run: Run) -> str:
    if run.history:
        return f"{run.history.rstrip('/')}/{plan.name}"
    if not plan.output.path:
        raise ValueError(f"{plan.name}: an event run needs a history folder or an output path to keep its persons")
    return f"{plan.output.path.rstrip('/')}/{_FOLDER}"


def _history(spark: SparkSession, path: str) -> DataFrame | None:
    """Everything kept so far, or None before the first run."""
    try:
        return spark.read.schema(_SCHEMA).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        return None


def former_epochs(spark: SparkSession, path: str, run: Run) -> dict[str, str]:
    """Keys of the earlier epochs that have persons, by fingerprint; refuses when one is not known."""
    history = _history(spark, path)
    if history is None:
        return {}
    # Partition values only: one row for each epoch.
    found = {row[0] for row in history.select(_EPOCH).distinct().collect()} - {epoch_of(run.key)}
    if None in found:
        raise KeyEpochError(f"{path} holds persons without an epoch, of an earlier layout: their key is not known")
    known = {epoch_of(key): key for key in run.former_keys}
    missing = sorted(found - known.keys())
    if missing:
        raise KeyEpochError(
            f"{path} holds persons hashed under other keys (fingerprints {', '.join(missing)}): give these keys as "
            "former_keys, or their rows would be written in clear"
        )
    return {name: known[name] for name in sorted(found)}


def remember(spark: SparkSession, path: str, persons: DataFrame, run: Run) -> DataFrame:
    """Keep the persons of a run, hashed under its key, and read them back."""
    own = f"{path}/{_EPOCH}={epoch_of(run.key)}/{_DAY}={run.run_date.isoformat()}/{_ORIGIN}={_OWN}"
    persons.select(PERSON, F.lit(None).cast("string").alias(_BEFORE)).write.mode("overwrite").parquet(own)
    return spark.read.schema(f"{PERSON} string").parquet(own)


def carry(spark: SparkSession, path: str, run: Run, former: dict[str, str], persons: DataFrame) -> int:
    """Bring persons of former epochs into that of the run's key; the number of epochs with persons still open.

    ``persons`` holds in its only column whom the run can see in clear. Those that were carried before are not sought again, so
    a history without open persons costs one comparison of two small tables.
    """
    still_open = 0
    now = epoch_of(run.key)
    for name, key in former.items():
        history = _history(spark, path)
        carried = history.where((F.col(_EPOCH) == now) & (F.col(_ORIGIN) == name)).select(F.col(_BEFORE).alias(PERSON))
        sought = history.where(F.col(_EPOCH) == name).select(PERSON).distinct().join(carried, PERSON, "left_anti")
        if sought.isEmpty():
            continue
        still_open += 1
        clear = persons.columns[0]
        seen = persons.where(F.col(clear).isNotNull()).distinct()
        pairs = seen.select(person_hash(run.key, F.col(clear)).alias(PERSON), person_hash(key, F.col(clear)).alias(_BEFORE))
        found = pairs.join(sought.withColumnRenamed(PERSON, _BEFORE), _BEFORE, "left_semi").select(PERSON, _BEFORE)
        # Appended: a repeated run does not seek again whom its first attempt has carried.
        found.write.mode("append").parquet(f"{path}/{_EPOCH}={now}/{_DAY}={run.run_date.isoformat()}/{_ORIGIN}={name}")
    return still_open


def remembered(spark: SparkSession, path: str, run: Run) -> DataFrame:
    """Distinct persons of all runs so far, hashed under the run's key."""
    return _history(spark, path).where(F.col(_EPOCH) == epoch_of(run.key)).select(PERSON).distinct()

