"""Runs that are killed and go on where they stopped."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lethe.operators.runstate import MASKED, PURGING, RunState, Step, fingerprint, state_of
from lethe.plans import jobs
from lethe.scratch import scratch_database
from lethe.sources import load, typed_config
from lethe.specs import InputSpec, OutputSpec, Rule, Run
from tests.test_jobs import BASE, config_rows, counted, event_plan, plan_for

RUN = Run(date(2000, 3, 10), mode="stock", key="k", principal="me", stock_start=date(1999, 1, 1))


class Killed(BaseException):
    """Ends an attempt like a killed driver: no handler of the run may catch it."""


@pytest.fixture
def data(spark):
    return spark.createDataFrame(
        [(i, f"p{i % 3}", f"secret {i}", m) for i, m in enumerate(["199901", "199902", "199902", "199903", "199904"] * 4)],
        "id int, person string, v string, dt string",
    )


@pytest.fixture
def writes(monkeypatch):
    """The partitions of each write of masked rows."""
    seen, real = [], jobs._save_checked

    def spy(spark, plan, masked, expected):
        seen.append(sorted(expected))
        return real(spark, plan, masked, expected)

    monkeypatch.setattr(jobs, "_save_checked", spy)
    return seen


def whole_run(spark, data, path):
    database = scratch_database(spark, "resumed")
    data.write.partitionBy("dt").saveAsTable(f"{database}.t")
    config = typed_config(config_rows(spark, BASE | {
        "base": database, "input_format": "table", "output_path": path("out"), "output_partitioned_by": "dt", "conserv_duration": "10",
        "purge_duration": "11", "purge_boolean": "true", "anonymisation_methode": "hashWithSha1"}))
    audits = [OutputSpec("orc", path(kind), partition_column="dt") for kind in ("masked", "purged")]
    return database, config, audits


def saved(spark, audits):
    mask, purge = (load(spark, InputSpec("orc", spec.path)).collect() for spec in audits)
    return ([(r.desensitized_partitions, r.input_row_count, r.output_row_count) for r in mask],
            [(sorted(r.purged_partitions), r.input_row_count, r.output_row_count) for r in purge])


@pytest.mark.parametrize("where", ["before the purge", "after the drop", "before the audit", "nowhere"])
def test_a_killed_run_goes_on(spark, data, path, monkeypatch, writes, where):
    """Wherever the attempts are killed, rows are masked once and both audits end as those of one whole run."""
    database, config, audits = whole_run(spark, data, path)
    run = replace(RUN, state=path("state"))

    def kill(*args, **kwargs):
        raise Killed

    with monkeypatch.context() as m:
        if where == "before the purge":
            m.setattr(jobs, "purge", kill)
        elif where == "after the drop":
            real = jobs.drop_partitions
            m.setattr(jobs, "drop_partitions", lambda *a: (real(*a), kill()))
        elif where == "before the audit":
            m.setattr(jobs, "replace_audit", kill)
        if where == "nowhere":
            jobs.run(spark, config, run, *audits)
        else:
            with pytest.raises(Killed):
                jobs.run(spark, config, run, *audits)
    assert writes == [["199901", "199902", "199903", "199904"]]
    for _ in range(2):
        jobs.run(spark, config, run, *audits)
        partitions = jobs.mask_partitions(spark, jobs.plans(config)[0], run)
        assert saved(spark, audits) == ([(partitions, 20, 20)], [(["199901", "199902", "199903"], 16, 0)])
    assert len(writes) == 1
    assert sorted({r.dt for r in spark.table(f"{database}.t").collect()}) == ["199904"]
    out = load(spark, InputSpec(BASE["output_format"], path("out")))
    assert out.count() == 20 and out.where(F.col("v").contains("secret")).count() == 0


def test_steps_resume_at_the_partition_that_was_not_done(spark, data, path, writes):
    plan, run = plan_for(data, path, keep_months=10), replace(RUN, state=path("state"), step_partitions=1)
    real = RunState.record

    def second_fails(self, phase, steps):
        if "199902" in steps:
            raise Killed
        real(self, phase, steps)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(RunState, "record", second_fails)
        with pytest.raises(Killed):
            jobs.retain_mask(spark, plan, run)
    assert writes == [["199901"], ["199902"]]
    done = jobs.retain_mask(spark, plan, run)
    assert writes[2:] == [["199902"], ["199903"], ["199904"]] and (done.rows_in, done.rows_out) == (20, 20)
    once = counted(load(spark, InputSpec("parquet", path("out"))))
    jobs.retain_mask(spark, replace(plan, output=replace(plan.output, path=path("other"))), replace(run, state=None))
    assert counted(load(spark, InputSpec("parquet", path("other")))) == once and writes[5] == ["199901", "199902", "199903", "199904"]


def test_what_has_changed_is_masked_again(spark, data, path, writes):
    plan, run = plan_for(data, path, keep_months=10), replace(RUN, state=path("state"))
    jobs.retain_mask(spark, plan, run)
    spark.createDataFrame([(99, "p", "late", "199903")], data.schema).write.mode("append").partitionBy("dt").parquet(path("in"))
    done = jobs.retain_mask(spark, plan, run)
    assert writes[1:] == [["199903"]] and (done.rows_in, done.rows_out) == (21, 21)
    # Another rule, another key, another run or a lost output: nothing on record holds.
    everything = ["199901", "199902", "199903", "199904"]
    jobs.retain_mask(spark, replace(plan, rules=(Rule("v", "0Replace"),)), run)
    jobs.retain_mask(spark, plan, replace(run, key="other"))
    jobs.retain_mask(spark, plan, replace(run, run_date=date(2000, 3, 11)))
    jobs.retain_mask(spark, replace(plan, output=replace(plan.output, path=path("moved"))), run)
    assert writes[2:] == [everything] * 4


def test_permutations_take_all_partitions_in_one_step(spark, data, path, writes):
    plan = plan_for(data, path, keep_months=10, rules=(Rule("v", "keepDistribution"),))
    run = replace(RUN, state=path("state"), step_partitions=1, row_keys={"b.t": ("id",)})
    jobs.retain_mask(spark, plan, run)
    assert writes == [["199901", "199902", "199903", "199904"]]


def test_event_tables_are_not_done_twice(spark, data, path, writes):
    events = spark.createDataFrame([("p0", "19990815", "200002")], "person string, left string, dt string")
    plan, run = event_plan(spark, data, path, events), replace(RUN, mode="normal", state=path("state"))
    first = jobs.retain_mask_by_event(spark, plan, run)
    again = jobs.retain_mask_by_event(spark, plan, run)
    assert len(writes) == 1 and first.rows_in > 0
    assert (again.partitions, again.rows_in, again.rows_out, again.start) == (first.partitions, first.rows_in, first.rows_out, first.start)


def test_log(spark, data, path):
    plan, run = plan_for(data, path), replace(RUN, state=path("state"))
    assert state_of(spark, plan, RUN) is None
    state = state_of(spark, plan, run)
    assert state.steps(MASKED) == {}
    state.record(MASKED, {})
    moment = lambda n: datetime(2000, 1, n)
    state.record(MASKED, {"199901": Step(1, 1, moment(1), moment(2)), None: Step(5, 5, moment(1), moment(2), 3)})
    state.record(MASKED, {"199901": Step(2, 2, moment(3), moment(4))})
    state.record(PURGING, {"199902": Step(7, 0, moment(3), moment(4))})
    assert state.steps(MASKED) == {"199901": Step(2, 2, moment(3), moment(4)), None: Step(5, 5, moment(1), moment(2), 3)}
    assert list(state.steps(PURGING)) == ["199902"]
    assert state_of(spark, plan, replace(run, run_date=date(2000, 1, 3))).steps(MASKED) == {}
    assert state_of(spark, replace(plan, table="u"), run).steps(MASKED) == {}
    assert fingerprint(plan, run) != fingerprint(plan, replace(run, key="other")) and "k" != fingerprint(plan, run)
