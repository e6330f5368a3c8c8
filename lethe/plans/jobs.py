"""The jobs: mask what has expired, purge originals, audit both."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegralType, StringType, StructField, StructType

from lethe.functions.calendar import EVENT_MONTH_FORMAT
from lethe.identifiers import column_path
from lethe.operators.audit import TableRun, mask_audit, purge_audit, replace_audit
from lethe.operators.configuration import EXECUTION_TRIGGER, plans
from lethe.operators.events import expired_keys, mask_where, partition_counts, unreadable_events
from lethe.operators.masking import ALL_METHODS, PERMUTATION, MaskContext, apply_rules
from lethe.operators.personindex import index_path, partitions_of, refresh
from lethe.operators.persons import PERSON, carry, former_epochs, history_path, person_hash, remember, remembered
from lethe.operators.proof import unproven
from lethe.operators.runstate import MASKED, PURGING, RunState, Step, state_of
from lethe.plans.partitions import constant, event_source_partitions, mask_partitions, purge_partitions
from lethe.scratch import scratch_path
from lethe.sinks.catalog import PartitionError, drop_partitions, existing_partitions, is_external
from lethe.sinks.writers import dynamic_overwrite, save
from lethe.sources.readers import in_partitions, load, load_columns, string_partitions
from lethe.specs import InputSpec, OutputSpec, Run, TablePlan

logger = logging.getLogger(__name__)

# What a key takes in a broadcast table: 64 characters and the row around them.
_BYTES_PER_KEY = 128
_HASH, _MINE = "__hash", "__mine"


@dataclass
class RunReport:
    """What a whole run did, the partitions it did not dare to purge, and the tables that failed."""

    masked: list[TableRun] = field(default_factory=list)
    purged: list[TableRun] = field(default_factory=list)
    kept: dict[str, tuple[str, ...]] = field(default_factory=dict)
    failures: dict[str, Exception] = field(default_factory=dict)


class RunError(RuntimeError):
    """Some tables of a run failed; ``report`` holds what was done and the failures."""

    def __init__(self, report: RunReport):
        self.report = report
        super().__init__("; ".join(f"{name}: {error}" for name, error in report.failures.items()))


class PurgeError(RuntimeError):
    """Some partitions could not be dropped; ``done`` tells which were."""

    def __init__(self, done: TableRun, cause: Exception):
        self.done = done
        super().__init__(str(cause))


def _context(spark: SparkSession, plan: TablePlan, run: Run) -> MaskContext:
    names = {}
    for part, given in (("first", run.first_names), ("last", run.last_names)):
        if isinstance(given, InputSpec):
            names[f"{part}_table"] = load(spark, given)
        elif given:
            names[f"{part}_names"] = given
    return MaskContext(key=run.key, row_key=tuple(run.row_keys.get(plan.name, ())), **names)


def _check_plan(plan: TablePlan) -> None:
    """Refuse plans that cannot work: unknown methods, masked partition columns, output over input."""
    for rule in plan.rules:
        if rule.method not in ALL_METHODS:
            raise ValueError(f"{plan.name}: unknown masking method {rule.method!r}")
    by_run_date = plan.trigger == EXECUTION_TRIGGER
    if plan.purge and by_run_date and plan.rules and (plan.purge_months or 0) < (plan.keep_months or 0):
        raise ValueError(f"{plan.name}: purging after {plan.purge_months} months would drop rows before they are masked")
    partition_columns = {plan.source.partition_column, *plan.output.partitions}
    masked = [r.column for r in plan.rules if r.column in partition_columns]
    if masked:
        raise ValueError(f"{plan.name}: partition column {masked[0]!r} cannot be masked")
    source, target = (p.rstrip("/") if p else None for p in (plan.source.path, plan.output.path))
    if source and source == target:
        raise ValueError(f"{plan.name}: the output path is the input path")


def _partition_rows(df: DataFrame, column: str) -> dict[str, int]:
    """Rows per partition value: one row on the driver for each partition.

    Only the partition column is read, which for ORC and Parquet means footers.
    """
    counts = df.groupBy(F.col(column_path(column)).cast("string").alias("value")).agg(F.count("*").alias("n"))
    return {row.value: row.n for row in counts.collect()}


def _written(
    spark: SparkSession, output: OutputSpec, masked: DataFrame, column: str, partitions: Sequence[str]
) -> DataFrame:
    """The written partitions, read back."""
    source = InputSpec(
        format={"csvWithoutHeader": "csv"}.get(output.format, output.format),
        path=output.path,
        table=output.table,
        delimiter=output.delimiter,
        header=output.header and output.format != "csvWithoutHeader",
        partition_column=column,
        partition_values=tuple(partitions),
        # Known here, so nothing has to be read to infer it.
        schema=masked.schema,
    )
    return load(spark, source)


def _is_absent(error: AnalysisException) -> bool:
    """Does the error say that there is no such path or table?"""
    condition = error.getCondition() or ""
    return "PATH_NOT_FOUND" in condition or "TABLE_OR_VIEW_NOT_FOUND" in condition


def _save_checked(
    spark: SparkSession, plan: TablePlan, masked: DataFrame, expected: dict[str, int]
) -> int:
    """Write, then compare the rows of every partition with what was read.

    A difference stops the run, so that no original is purged after a bad write.
    """
    column = plan.source.partition_column
    if column not in plan.output.partitions:
        raise ValueError(f"{plan.name}: the output must be partitioned by {column}, or runs would replace other months")
    save(masked, plan.output)
    # Counted from the files rather than by a counter during the write: a counter
    # counts a task again when a lost executor makes it run twice.
    written = _partition_rows(_written(spark, plan.output, masked, column, sorted(expected)), column)
    if written != expected:
        wrong = sorted(v for v in expected if written.get(v) != expected[v])
        raise RuntimeError(f"{plan.name}: row counts differ after the write in partitions {wrong}")
    return sum(written.values())


def _still_masked(
    spark: SparkSession, plan: TablePlan, data: DataFrame, known: dict[str, Step], present: dict[str, int]
) -> dict[str, Step]:
    """The steps on record that still hold: the original has the rows it had, or is purged, and so has the output."""
    same = {v: s for v, s in known.items() if present.get(v, s.rows_in) == s.rows_in}
    if not same:
        return {}
    column = plan.source.partition_column
    try:
        written = _partition_rows(_written(spark, plan.output, data, column, sorted(same)), column)
    except AnalysisException as error:
        if not _is_absent(error):
            raise
        return {}
    return {v: s for v, s in same.items() if written.get(v) == s.rows_out}


def _batches(plan: TablePlan, run: Run, values: Sequence[str]) -> list[Sequence[str]]:
    """The partitions of each step; a permutation mixes the rows of all, so it takes them at once."""
    whole = not run.state or run.step_partitions <= 0 or any(r.method == PERMUTATION for r in plan.rules)
    size = len(values) if whole else run.step_partitions
    return [values[i : i + size] for i in range(0, len(values), size)] if values else []


def retain_mask(spark: SparkSession, plan: TablePlan, run: Run) -> TableRun:
    """Mask the partitions that have expired by the run date.

    With ``Run.state`` each checked step is put on record, and partitions that an earlier attempt of this run
    has masked are not masked again.
    """
    _check_plan(plan)
    start = datetime.now()
    partitions = mask_partitions(spark, plan, run)
    state = state_of(spark, plan, run)
    rows_in = rows_out = 0
    if partitions:
        column = plan.source.partition_column
        data = load(spark, replace(plan.source, partition_values=tuple(partitions)))
        expected = _partition_rows(data, column)
        if state is not None:
            known = {v: s for v, s in state.steps(MASKED).items() if v in set(partitions)}
            done = _still_masked(spark, plan, data, known, expected)
            expected = {v: n for v, n in expected.items() if v not in done}
            rows_in, rows_out = sum(s.rows_in for s in done.values()), sum(s.rows_out for s in done.values())
            start = min([start, *(s.begun for s in done.values())])
        rows_in += sum(expected.values())
        steps = _batches(plan, run, sorted(expected))
        for step in steps:
            begun, own = datetime.now(), {v: expected[v] for v in step}
            # A run without a state has one step, of all that was loaded.
            rows = data if state is None else data.where(in_partitions(data, column, step))
            rows_out += _save_checked(spark, plan, apply_rules(rows, plan.rules, _context(spark, plan, run)), own)
            if state is not None:
                ended = datetime.now()
                state.record(MASKED, {v: Step(n, n, begun, ended) for v, n in own.items()})
    return TableRun(plan.base, plan.table, tuple(partitions), rows_in, rows_out, start, datetime.now())


def _before_month(spark: SparkSession, run: Run, keep_months: int) -> str:
    return constant(spark, F.date_format(F.add_months(F.lit(run.run_date), -keep_months), EVENT_MONTH_FORMAT))


def _fits_broadcast(keys: DataFrame) -> bool:
    """Are the keys known to be small enough to go to every executor, by the session's own limit?"""
    limit = keys.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return keys.count() * _BYTES_PER_KEY <= limit


def _in_clear(spark: SparkSession, data: DataFrame, key: str, person: Column, mine: DataFrame, everybody: DataFrame) -> DataFrame | None:
    """The keys in the data whose hashes are among all persons, and whether they are among this run's (``_MINE``).

    Each key is hashed once and the rows meet keys of their own kind, so no shuffle of rows carries hashes. None for
    keys of other types than texts and whole numbers, where equal keys may be written, and so hashed, differently.
    """
    if not (data.schema[key].dataType == StringType() or isinstance(data.schema[key].dataType, IntegralType)):
        return None
    seen = data.select(F.col(column_path(key))).where(F.col(column_path(key)).isNotNull()).distinct()
    hashed = seen.withColumn(_HASH, person)
    current = mine.select(F.col(PERSON).alias(_HASH), F.lit(True).alias(_MINE)).distinct()
    found = hashed.join(everybody.select(F.col(PERSON).alias(_HASH)), _HASH, "left_semi").join(current, _HASH, "left")
    path = scratch_path(spark, "keys")
    found.select(F.col(column_path(key)), F.coalesce(_MINE, F.lit(False)).alias(_MINE)).write.parquet(path)
    return spark.read.schema(StructType([data.schema[key], StructField(_MINE, BooleanType())])).parquet(path)


def _forget(keys: DataFrame) -> None:
    """Remove the files of keys in clear."""
    spark = keys.sparkSession
    for file in {name.rsplit("/", 1)[0] for name in keys.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _event_run_of(plan: TablePlan, state: RunState) -> TableRun | None:
    """What an earlier attempt of this run has done to a table by events, if it came to its end."""
    steps = state.steps(MASKED)
    end = steps.pop(None, None)
    if end is None:
        return None
    values = tuple(sorted(v for v, s in steps.items() if s.ended == end.ended))
    return TableRun(plan.base, plan.table, values, end.rows_in, end.rows_out, end.begun, end.ended, end.unreadable)


def retain_mask_by_event(spark: SparkSession, plan: TablePlan, run: Run) -> TableRun:
    """Mask by events (``_mask_by_event``); with ``Run.state`` a table that an earlier attempt of this run has finished is left as it is."""
    state = state_of(spark, plan, run)
    done = None if state is None else _event_run_of(plan, state)
    if done is None:
        done = _mask_by_event(spark, plan, run)
        if state is not None:
            # All in one write: the row without a partition holds the sums and says that the rest is complete.
            sums = Step(done.rows_in, done.rows_out, done.start, done.end, done.unreadable_events)
            state.record(MASKED, {None: sums} | {v: Step(0, 0, done.start, done.end) for v in done.partitions})
    return done


def _mask_by_event(spark: SparkSession, plan: TablePlan, run: Run) -> TableRun:
    """Mask the rows of persons whose event lies before run month - keep.

    The partitions in which such persons have rows are rewritten as a whole: the persons
    of this run and of all earlier ones masked, the rows of others unchanged. The persons
    are kept as keyed hashes beside the output (``lethe.operators.persons``). Keys
    under the session's broadcast limit are broadcast, so that the rows stay
    where they are; with more the join deals the rows out by person, and they are
    gathered by partition again before the write.
    """
    _check_plan(plan)
    start = datetime.now()
    clock, key = plan.clock, plan.clock.join_column
    source = replace(clock.source, partition_values=tuple(event_source_partitions(spark, clock, run)))
    events = load_columns(
        spark, source, [clock.join_column, clock.process_column], clock.min_value, clock.process_column
    )
    unreadable = events.where(unreadable_events(clock.process_column, clock.process_format)).count()
    if unreadable:
        logger.warning("%s: %d events have no readable date and start no clock", plan.name, unreadable)
    expired_persons = expired_keys(
        events, key, clock.process_column, clock.process_format, _before_month(spark, run, plan.keep_months)
    )
    history = history_path(plan, run)
    # Refuses before anything is written if the key of earlier persons is not known.
    former = former_epochs(spark, history, run)
    person = person_hash(run.key, F.col(column_path(key)))
    mine = remember(spark, history, expired_persons.select(person.alias(PERSON)).where(F.col(PERSON).isNotNull()), run)
    everything = load(spark, plan.source)
    if former:
        # Whoever has no row in the table needs no mask; events do not matter here.
        carry(spark, history, run, former, everything.select(F.col(column_path(key))))
    everybody = remembered(spark, history, run)
    column = plan.source.partition_column
    if run.person_index:
        index = index_path(history, run)
        refresh(spark, plan.source, key, index, run)
        candidates = partitions_of(spark, index, mine)
        if not candidates:
            return TableRun(plan.base, plan.table, (), 0, 0, start, datetime.now(), unreadable)
        everything = everything.where(in_partitions(everything, column, candidates))
    # This run's persons are among all persons, so one measure holds for both.
    small = _fits_broadcast(everybody)
    clear = None
    if small:
        mine, everybody = F.broadcast(mine), F.broadcast(everybody)
    else:
        if plan.output.partitions:
            plan = replace(plan, output=replace(plan.output, rebalance=True))
        clear = _in_clear(spark, everything, key, person, mine, everybody)
    try:
        # One row for each partition that holds expired persons: theirs, and all of its rows.
        partition = F.col(column_path(column)).cast("string").alias(column)
        if clear is None:
            counts = partition_counts(everything.select(person.alias(PERSON), partition), mine, PERSON, column).collect()
        else:
            counts = partition_counts(everything.select(F.col(column_path(key)), partition), clear.where(_MINE), key, column).collect()
        if not counts:
            return TableRun(plan.base, plan.table, (), 0, 0, start, datetime.now(), unreadable)
        expected = {row[column]: row.all_rows for row in counts}
        if None in expected:
            raise ValueError(f"{plan.name}: expired persons have rows without a value of {column}")
        to_mask = sum(row.expired_rows for row in counts)
        data = everything.where(in_partitions(everything, column, sorted(expected)))
        context = _context(spark, plan, run)
        if clear is None:
            masked = mask_where(data, everybody, PERSON, plan.rules, context, person)
        else:
            masked = mask_where(data, clear, key, plan.rules, context)
        written = _save_checked(spark, plan, masked, expected)
    finally:
        if clear is not None:
            _forget(clear)
    kept = sum(expected.values()) - to_mask
    return TableRun(plan.base, plan.table, tuple(sorted(expected)), to_mask, written - kept, start, datetime.now(), unreadable)


def _unmasked(spark: SparkSession, plan: TablePlan, run: Run, data: DataFrame) -> dict[str, str]:
    """Partitions whose masked copy in the output is not proven, with the reasons."""
    column = plan.source.partition_column
    before = sorted(_partition_rows(data, column))
    if not before:
        return {}
    context = _context(spark, plan, run)
    try:
        written = _written(spark, plan.output, apply_rules(data, plan.rules, context), column, before)
    except AnalysisException as error:
        if not _is_absent(error):
            raise
        return dict.fromkeys(before, "there is no masked output")
    return unproven(data, written, column, plan.rules, context, run.former_keys)


def purge(
    spark: SparkSession, plan: TablePlan, run: Run, metadata_only: bool = False, only_masked: bool = False
) -> TableRun:
    """Drop the partitions past the purge period.

    Dropping a partition of an external table leaves its files in place. That is
    refused unless ``metadata_only`` says that it is wanted. With ``only_masked`` a
    partition stays unless the output is proven to hold its rows masked
    (``lethe.operators.proof``; ``kept`` names those that stay). If some partitions cannot be dropped, ``PurgeError`` tells which were.
    With ``Run.state`` the result also names what earlier attempts of this run have dropped, killed ones too.
    """
    start = datetime.now()
    table, column = plan.source.table, plan.source.partition_column
    if not metadata_only and is_external(spark, table):
        raise ValueError(f"{table} is external: dropping its partitions would keep the files")
    wanted = set(purge_partitions(spark, plan, run))
    existing = existing_partitions(spark, table, column)
    partitions = [v for v in existing if v in wanted]
    state = state_of(spark, plan, run)
    # Partitions that an earlier attempt was about to drop, and that are gone.
    gone = {} if state is None else {v: s for v, s in state.steps(PURGING).items() if v not in set(existing)}
    kept: dict[str, str] = {}
    rows_in = rows_out = 0
    problem: Exception | None = None
    if partitions and only_masked:
        data = load(spark, InputSpec("table", table=table))
        kept = _unmasked(spark, plan, run, data.where(in_partitions(data, column, partitions)))
        partitions = [v for v in partitions if v not in kept]
        for value, reason in sorted(kept.items()):
            logger.warning("%s: partition %s stays: %s", plan.name, value, reason)
    if partitions:
        data = load(spark, InputSpec("table", table=table))
        before = _partition_rows(data.where(in_partitions(data, column, partitions)), column)
        if state is not None:
            now = datetime.now()
            state.record(PURGING, {v: Step(before.get(v, 0), 0, start, now) for v in partitions})
        try:
            drop_partitions(spark, table, column, partitions)
        except PartitionError as error:
            problem = error
            failed = {value for value, _ in error.failures}
            partitions = [v for v in partitions if v not in failed]
        rows_in = sum(before.get(v, 0) for v in partitions)
        if partitions:
            data = load(spark, InputSpec("table", table=table))
            rows_out = data.where(in_partitions(data, column, partitions)).count()
    rows_in += sum(s.rows_in for s in gone.values())
    start = min([start, *(s.begun for s in gone.values())])
    partitions = [*partitions, *sorted(gone)]
    done = TableRun(plan.base, plan.table, tuple(partitions), rows_in, rows_out, start, datetime.now(), kept=tuple(sorted(kept)))
    if problem is not None:
        raise PurgeError(done, problem)
    return done


def _work_on(spark: SparkSession, plan: TablePlan, run: Run) -> RunReport:
    """Mask one table, then purge its originals."""
    logger.info("processing %s, trigger %s", plan.name, plan.trigger)
    report = RunReport()
    by_run_date = plan.trigger == EXECUTION_TRIGGER
    if plan.rules:
        job = retain_mask if by_run_date else retain_mask_by_event
        report.masked.append(job(spark, plan, run))
    if plan.purge and by_run_date:
        try:
            done = purge(spark, plan, run, only_masked=bool(plan.rules))
            report.purged.append(done)
            if done.kept:
                report.kept[plan.name] = done.kept
        except Exception as error:  # noqa: BLE001 - the masking of this table still gets its audit row
            report.failures[plan.name] = error
            if isinstance(error, PurgeError) and error.done.partitions:
                report.purged.append(error.done)
    return report


def run(
    spark: SparkSession,
    config: DataFrame,
    run: Run,
    mask_audit_spec: OutputSpec | None = None,
    purge_audit_spec: OutputSpec | None = None,
    parallel: int = 1,
) -> RunReport:
    """Work through a typed configuration; both audits are saved as each table ends, in the place of those of an earlier attempt.

    Every plan is checked before the first table is touched. A table is masked
    before its originals are purged. A table that fails does not stop the others:
    what was done is audited, then ``RunError`` names the failures. ``parallel``
    tables are worked on at a time, each as ordinary Spark jobs. With ``Run.state`` a run that was killed goes on
    where it stopped.
    """
    todo = plans(config)
    for plan in todo:
        _check_plan(plan)

    def guarded(plan: TablePlan) -> RunReport:
        try:
            return _work_on(spark, plan, run)
        except Exception as error:  # noqa: BLE001 - reported at the end of the run
            logger.exception("%s failed", plan.name)
            return RunReport(failures={plan.name: error})

    report = RunReport()
    # Held for the whole run, since tables worked on at the same time share the session.
    with string_partitions(spark), dynamic_overwrite(spark), ThreadPoolExecutor(parallel) as pool:
        for part in pool.map(guarded, todo):
            report.masked += part.masked
            report.purged += part.purged
            report.kept |= part.kept
            report.failures |= part.failures
            # A later crash must not take the audit of what was already done with it.
            for spec, audit, done in ((mask_audit_spec, mask_audit, part.masked), (purge_audit_spec, purge_audit, part.purged)):
                if spec is not None and done:
                    named = f"{done[0].base}.{done[0].table}"
                    replace_audit(audit(config, done, run.principal), spec, run.identity, named, whole=bool(run.state))
    if report.failures:
        raise RunError(report)
    return report
