"""What a run has finished, kept so that a killed run goes on where it stopped.

A log of steps lies in a folder: one row for each run, table, phase and partition, added after the step has been
checked. ``masked`` says that the written partition had the rows of its original; ``purging`` names a partition about to be
dropped, with its rows, so that an attempt killed between the drop and its audit loses nothing from the audit.

A step counts for a later attempt only if the table's plan, its rules and the key are what they were, told by a fingerprint.
Rows are added by Spark's commit protocol, never changed, and the last one of a partition holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lethe.operators.persons import epoch_of
from lethe.specs import Run, TablePlan

MASKED, PURGING = "masked", "purging"
_RUN, _TABLE = "run_id", "table_id"
_SCHEMA = (
    "plan string, phase string, value string, rows_in bigint, rows_out bigint, unreadable bigint, "
    f"begun timestamp, ended timestamp, {_RUN} string, {_TABLE} string"
)
_FINGERPRINT_DIGITS = 16


@dataclass(frozen=True)
class Step:
    """One partition in one phase; a table without partitions to mask has a step of the value None."""

    rows_in: int
    rows_out: int
    begun: datetime
    ended: datetime
    unreadable: int = 0


def fingerprint(plan: TablePlan, run: Run) -> str:
    """Names everything that the masked rows of a table depend on, without telling the key."""
    rules = [(r.column, r.method, sorted(r.options.items())) for r in plan.rules]
    parts = (
        plan.source.format, plan.source.path, plan.source.table, plan.source.partition_column, plan.output, plan.trigger,
        plan.keep_months, plan.purge_months, plan.clock, rules, run.row_keys.get(plan.name, ()), run.first_names, run.last_names,
        epoch_of(run.key),
    )
    return hashlib.sha256(repr(parts).encode()).hexdigest()[:_FINGERPRINT_DIGITS]


@dataclass(frozen=True)
class RunState:
    """The steps of one table in one run."""

    spark: SparkSession
    path: str
    run_id: str
    table_id: str
    plan_id: str

    def steps(self, phase: str) -> dict[str | None, Step]:
        """The last step of each partition: one row for each partition on the driver."""
        try:
            log = self.spark.read.schema(_SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
                raise
            return {}
        mine = log.where(
            (F.col(_RUN) == self.run_id) & (F.col(_TABLE) == self.table_id)
            & (F.col("plan") == self.plan_id) & (F.col("phase") == phase)
        )
        last = mine.groupBy("value").agg(F.max_by(F.struct("rows_in", "rows_out", "begun", "ended", "unreadable"), "ended").alias("s"))
        return {r.value: Step(**r.s.asDict()) for r in last.collect()}

    def record(self, phase: str, steps: Mapping[str | None, Step]) -> None:
        """Add steps; they are there as a whole or not at all."""
        if not steps:
            return
        rows = [
            (self.plan_id, phase, value, s.rows_in, s.rows_out, s.unreadable, s.begun, s.ended, self.run_id, self.table_id)
            for value, s in steps.items()
        ]
        log = self.spark.createDataFrame(rows, _SCHEMA).coalesce(1)
        log.write.mode("append").partitionBy(_RUN, _TABLE).parquet(self.path)


def state_of(spark: SparkSession, plan: TablePlan, run: Run) -> RunState | None:
    """The state of a table in a run, or None for a run that keeps none."""
    if not run.state:
        return None
    return RunState(spark, run.state.rstrip("/"), run.identity, plan.name, fingerprint(plan, run))
