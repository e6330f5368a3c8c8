"""Whole jobs: results, reruns, refusals."""

from __future__ import annotations

from collections import Counter
from dataclasses import replace
from datetime import date, datetime

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lethe.operators.audit import TableRun, append_audit, mask_audit, replace_audit
from lethe.operators.configuration import plan_rows, plans, rules_for
from lethe.operators.events import expired_keys, mask_where, split_by_keys
from lethe.operators.masking import MaskContext
from lethe.operators.personindex import partitions_of, refresh
from lethe.operators.persons import PERSON, KeyEpochError, person_hash
from lethe.plans import jobs
from lethe.scratch import scratch_database
from lethe.sources import CONFIG_COLUMNS, load, load_config, typed_config
from lethe.specs import EventClock, InputSpec, OutputSpec, Rule, Run, TablePlan

RUN = Run(date(2000, 3, 10), key="k", principal="me")


@pytest.fixture
def data(spark):
    return spark.createDataFrame(
        [(i, f"p{i % 3}", f"secret {i}", m) for i, m in enumerate(["199901", "199902", "199902", "199903", "199904"] * 4)],
        "id int, person string, v string, dt string",
    )


def plan_for(data, path, **changes):
    data.write.mode("overwrite").partitionBy("dt").parquet(path("in"))
    plan = TablePlan(
        "b", "t", InputSpec("parquet", path("in")),
        OutputSpec("parquet", path("out"), None, "dt", mode="overwrite_partitions"),
        "yyyyMM", 12, 24, True, "execution", (Rule("v", "XReplace"),),
    )
    return replace(plan, **changes)


def counted(df):
    return Counter(tuple(r) for r in df.select("id", "person", "v", "dt").collect())


def test_normal_run_masks_the_newly_expired_month_and_can_be_repeated(spark, data, path):
    plan = plan_for(data, path)
    outcome = jobs.retain_mask(spark, plan, RUN)
    assert outcome.partitions == ("199902",) and (outcome.rows_in, outcome.rows_out) == (8, 8)
    first = counted(load(spark, InputSpec("parquet", path("out"))))
    assert {r[3] for r in first} == {"199902"} and all(set(r[2]) == {"X"} for r in first)
    jobs.retain_mask(spark, plan, RUN)
    assert counted(load(spark, InputSpec("parquet", path("out")))) == first


def test_stock_run_and_empty_run(spark, data, path):
    plan = plan_for(data, path)
    outcome = jobs.retain_mask(spark, plan, replace(RUN, mode="stock", stock_start=date(1999, 1, 1)))
    assert outcome.partitions == ("199901", "199902") and outcome.rows_out == 12
    nothing = jobs.retain_mask(spark, plan, replace(RUN, run_date=date(2030, 1, 1)))
    assert (nothing.rows_in, nothing.rows_out) == (0, 0)


def test_rerun_after_the_originals_are_gone_keeps_the_masked_rows(spark, data, path):
    plan = plan_for(data, path)
    jobs.retain_mask(spark, plan, RUN)
    before = counted(load(spark, InputSpec("parquet", path("out"))))
    plan_for(data.where("dt <> '199902'"), path)
    assert jobs.retain_mask(spark, plan, RUN).rows_in == 0
    assert counted(load(spark, InputSpec("parquet", path("out")))) == before


def test_refusals(spark, data, path):
    plan = plan_for(data, path)
    with pytest.raises(ValueError, match="output path is the input path"):
        jobs.retain_mask(spark, replace(plan, output=replace(plan.output, path=path("in") + "/")), RUN)
    with pytest.raises(ValueError, match="cannot be masked"):
        jobs.retain_mask(spark, replace(plan, rules=(Rule("dt", "id"),)), RUN)


def test_a_write_that_loses_rows_stops_the_run(spark, data, path, monkeypatch):
    plan = plan_for(data, path)
    real = jobs.save
    monkeypatch.setattr(jobs, "save", lambda df, spec: real(df.where("id % 2 = 0"), spec))
    with pytest.raises(RuntimeError, match="199902"):
        jobs.retain_mask(spark, plan, RUN)


def event_plan(spark, data, path, events, frequency="mois"):
    events.write.mode("overwrite").partitionBy("dt").parquet(path("events"))
    clock = EventClock(InputSpec("parquet", path("events")), "yyyyMM", "person", "left", "yyyyMMdd", frequency, "19000101")
    return plan_for(data, path, trigger="leaving", keep_months=6, clock=clock)


@pytest.mark.parametrize("most", ["10m", "-1"])
def test_event_clock(spark, data, path, request, most):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    events = spark.createDataFrame(
        [("p0", "19990815", "200002"), ("p0", "19990815", "200002"), ("p0", "20000101", "200002"),
         ("p1", "19990901", "200002"), ("p2", "19990101", "199912"), ("p9", "19990101", "200002")],
        "person string, left string, dt string",
    )
    outcome = jobs.retain_mask_by_event(spark, event_plan(spark, data, path, events), RUN)
    # March 2000 less six months: events before September 1999, in the snapshot of February 2000.
    expected = Counter((r.id, r.person, "X" * len(r.v.replace(" ", "")) if r.person == "p0" else r.v, r.dt) for r in data.collect())
    assert counted(load(spark, InputSpec("parquet", path("out")))) == expected
    n = sum(1 for r in data.collect() if r.person == "p0")
    assert (outcome.rows_in, outcome.rows_out) == (n, n)


def test_rows_are_not_shuffled_with_hashes_of_persons(spark, data, path, request, monkeypatch):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    seen, real = [], jobs.partition_counts
    monkeypatch.setattr(jobs, "partition_counts", lambda rows, *rest: seen.append((rows.columns, rest[0].inputFiles())) or real(rows, *rest))
    events = spark.createDataFrame([("p0", "19990815", "200002")], "person string, left string, dt string")
    jobs.retain_mask_by_event(spark, event_plan(spark, data, path, events), RUN)
    [(columns, files)] = seen
    assert columns == ["person", "dt"]
    # The keys in clear are gone with the run.
    assert files and not any(Path(f.removeprefix("file:")).exists() for f in files)


def test_event_clock_without_expired_persons(spark, data, path):
    events = spark.createDataFrame([("p0", "20000101", "200002")], "person string, left string, dt string")
    outcome = jobs.retain_mask_by_event(spark, event_plan(spark, data, path, events), RUN)
    assert outcome.partitions == () and outcome.rows_in == 0


def test_mask_where_with_a_hot_person_and_repeated_keys(spark):
    data = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 != 0, "hot").otherwise(F.col("id").cast("string")).alias("person"), F.lit("s e").alias("v")
    )
    twice = data.unionByName(data)
    keys = spark.createDataFrame([("hot",), ("hot",), ("6",), (None,)], "person string")
    out = mask_where(twice, keys, "person", [Rule("v", "XReplace")], MaskContext())
    got = Counter((r.person in ("hot", "6"), r.v) for r in out.collect())
    assert got == {(True, "XX"): 4002, (False, "s e"): 1998}
    expired, kept = split_by_keys(twice, keys, "person")
    assert (expired.count(), kept.count()) == (4002, 1998)


def test_permutation_among_the_expired_rows(spark):
    data = spark.createDataFrame(
        [(i, f"p{i % 4}", None if i % 11 == 0 else ("null" if i % 13 == 0 else f"v{i}")) for i in range(400)],
        "id int, person string, v string",
    )
    keys = spark.createDataFrame([("p1",), ("p2",)], "person string")
    out = mask_where(data, keys, "person", [Rule("v", "keepDistribution")], MaskContext("k", ("id",)))
    before, after = ({r.id: r for r in df.collect()} for df in (data, out))
    expired = [i for i, r in before.items() if r.person in ("p1", "p2")]
    clean = {i: None if before[i].v == "null" else before[i].v for i in expired}
    assert all(after[i] == r for i, r in before.items() if i not in clean)
    assert Counter(after[i].v for i in expired) == Counter(clean.values())
    assert all((after[i].v is None) == (v is None) and (v is None or after[i].v != v) for i, v in clean.items())


def test_expired_keys_are_distinct(spark):
    events = spark.createDataFrame([("a", "19990101"), ("a", "19990102"), ("b", "bad"), ("c", "20010101")], "p string, d string")
    assert [r.p for r in expired_keys(events, "p", "d", "yyyyMMdd", "200001").collect()] == ["a"]


def config_rows(spark, *rows):
    schema = ", ".join(f"{c} string" for c in CONFIG_COLUMNS)
    return spark.createDataFrame([tuple(r.get(c) for c in CONFIG_COLUMNS) for r in rows], schema)


BASE = {
    "base": "b", "table_name": "t", "column_name": "v", "partition_value_format": "yyyyMM", "output_format": "parquet",
    "conserv_duration": "12", "declencheur": "execution", "anonymisation_methode": "id",
}


@pytest.mark.parametrize("change, message", [
    ({"declencheur": ""}, "no trigger"),
    ({"conserv_duration": "a year"}, "conserv_duration"),
    ({"purge_boolean": "true"}, "purge_duration"),
    ({"output_format": None}, "output_format"),
])
def test_bad_configurations(spark, change, message):
    with pytest.raises(ValueError, match=message):
        plans(typed_config(config_rows(spark, BASE | change)))


def test_plans(spark):
    config = typed_config(config_rows(
        spark, BASE | {"column_name": "z", "anonymisation_methode": "XReplace", "anonymisation_methode_options": "char",
                       "anonymisation_methode_options_values": "#"},
        BASE, BASE | {"table_name": "u", "declencheur": "depart", "declench_column_join": "p",
                      "declench_column_process_value_format": "yyyyMMdd"}))
    first, second = plans(config)
    assert first.name == "b.t" and first.rules == (Rule("v", "id"), Rule("z", "XReplace", {"char": "#"}))
    assert first.keep_months == 12 and not first.purge and first.clock is None
    assert second.clock.join_column == "p" and second.output.table == "b.u_desensitized"
    assert rules_for(config, "b", "t").count() == 2 and plan_rows(config).count() == 2
    with pytest.raises(ValueError, match="lacks"):
        typed_config(config.drop("base"))


def test_config_load(spark, path):
    rows = config_rows(spark, BASE | {"conserv_duration": " 7 "}).withColumn("dt", F.lit("200003"))
    rows.unionByName(rows.withColumn("dt", F.lit("200002"))).write.partitionBy("dt").parquet(path("config"))
    config = load_config(spark, InputSpec("parquet", path("config")), RUN.run_date)
    assert [(r.conserv_duration, r.purge_boolean) for r in config.collect()] == [(7, False)]


def test_whole_run(spark, data, path):
    database = scratch_database(spark, "run")
    data.write.partitionBy("dt").saveAsTable(f"{database}.t")
    config = typed_config(config_rows(spark, BASE | {
        "base": database, "input_format": "table", "partition_column": "dt", "output_path": path("out"),
        "output_partitioned_by": "dt", "purge_duration": "13", "purge_boolean": "true", "anonymisation_methode": "hashWithSha1"}))
    audits = [OutputSpec("orc", path(kind), partition_column="dt") for kind in ("masked", "purged")]
    # January's originals were never masked, so this run's purge leaves them alone.
    assert jobs.run(spark, config, RUN).kept == {f"{database}.t": ("199901",)}
    jobs.run(spark, config, replace(RUN, run_date=date(2000, 2, 10)))
    for _ in range(2):
        report = jobs.run(spark, config, RUN, *audits)
    assert not report.kept and report.masked[0].partitions == ("199902",) and report.purged[0].partitions == ()
    mask, purge = (load(spark, InputSpec("orc", spec.path)).orderBy("start_date").collect() for spec in audits)
    # The second attempt has replaced the audits of the first; what that one has purged stays on record.
    assert [(r.tableName, r.columnNames, r.input_row_count, r.output_row_count) for r in mask] == [("t", ["v"], 8, 8)]
    assert [(r.purged_partitions, r.input_row_count, r.output_row_count) for r in purge] == [(["199901"], 4, 0)]
    assert mask[0].principalKeytab == "me" and mask[0].processing_time >= 0
    assert sorted({r.dt for r in spark.table(f"{database}.t").collect()}) == ["199902", "199903", "199904"]


def test_a_failing_table_does_not_stop_the_others(spark, data, path):
    database = scratch_database(spark, "many")
    rows = []
    for name in ("a", "b", "c"):
        if name != "b":
            data.write.partitionBy("dt").saveAsTable(f"{database}.{name}")
        rows.append(BASE | {"base": database, "table_name": name, "input_format": "table", "output_path": path(name),
                            "output_partitioned_by": "dt", "anonymisation_methode": "XReplace"})
    config, spec = typed_config(config_rows(spark, *rows)), OutputSpec("orc", path("audit"), partition_column="dt")
    with pytest.raises(jobs.RunError) as caught:
        jobs.run(spark, config, RUN, spec, parallel=3)
    assert list(caught.value.report.failures) == [f"{database}.b"]
    assert sorted(r.tableName for r in load(spark, InputSpec("orc", path("audit"))).collect()) == ["a", "c"]
    assert spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == "true"
    bad = typed_config(config_rows(spark, *rows[:1], rows[2] | {"anonymisation_methode": "rot13"}))
    with pytest.raises(ValueError, match="rot13"):
        jobs.run(spark, bad, RUN)


@pytest.mark.parametrize("fmt", ["csv", "csvWithoutHeader", "json", "orc", "table"])
def test_output_formats(spark, data, path, fmt):
    table = f"{scratch_database(spark, 'out')}.masked"
    output = OutputSpec(fmt, path("out"), table, "dt", mode="overwrite_partitions")
    for _ in range(2):
        outcome = jobs.retain_mask(spark, plan_for(data, path, output=output), RUN)
    assert (outcome.rows_in, outcome.rows_out) == (8, 8)


def test_purge_refuses_external_tables(spark, data, path):
    name = f"{scratch_database(spark, 'ext')}.t"
    data.write.partitionBy("dt").option("path", path("ext")).saveAsTable(name)
    plan = plan_for(data, path, source=InputSpec("table", table=name), purge_months=13)
    with pytest.raises(ValueError, match="external"):
        jobs.purge(spark, plan, RUN)
    outcome = jobs.purge(spark, plan, RUN, metadata_only=True)
    assert outcome.partitions == ("199901",) and spark.read.parquet(path("ext")).count() == 20


@pytest.mark.parametrize("layout", [None, "person"])
def test_masked_months_survive_later_runs(spark, data, path, layout):
    data.write.partitionBy("dt").parquet(path("in"))
    row = BASE | {"input_format": "parquet", "input_path": path("in"), "output_path": path("out"),
                  "output_partitioned_by": layout, "anonymisation_methode": "XReplace"}
    config = typed_config(config_rows(spark, row))
    for month in (2, 3, 4, 3):
        report = jobs.run(spark, config, replace(RUN, run_date=date(2000, month, 10)))
        assert report.masked[0].rows_in == report.masked[0].rows_out > 0
    found = counted(load(spark, InputSpec("parquet", path("out"))))
    expected = counted(data.where("dt < '199904'").withColumn("v", F.expr("repeat('X', length(v) - 1)")))
    assert found == expected


def test_event_runs_keep_earlier_persons_masked(spark, data, path):
    events = spark.createDataFrame(
        [("p0", "19990801", "20000309"), ("p1", "19990801", "20000310"), ("p2", "x", "20000310"), ("p2", "20000101", "20000310")],
        "person string, left string, dt string")
    plan = event_plan(spark, data, path, events, "jours")
    plan = replace(plan, clock=replace(plan.clock, value_format="yyyyMMdd"))

    def masked_persons():
        out = load(spark, InputSpec("parquet", path("out"))).collect()
        return {r.person for r in out if set(r.v) == {"X"}}, Counter(r.person for r in out)

    jobs.retain_mask_by_event(spark, plan, RUN)
    assert masked_persons()[0] == {"p0"}
    for _ in range(2):
        outcome = jobs.retain_mask_by_event(spark, plan, replace(RUN, run_date=date(2000, 3, 11)))
        assert outcome.unreadable_events == 1
        assert masked_persons() == ({"p0", "p1"}, Counter(r.person for r in data.collect()))


def test_a_half_failed_purge_is_audited(spark, data, path, monkeypatch):
    from lethe.sinks import catalog

    database = scratch_database(spark, "half")
    data.write.partitionBy("dt").saveAsTable(f"{database}.t")
    config = typed_config(config_rows(spark, BASE | {
        "base": database, "input_format": "table", "output_path": path("out"), "conserv_duration": "10",
        "purge_duration": "10", "purge_boolean": "true", "anonymisation_methode": "hashWithSha1"}))

    def drop_one(spark, table, column, value):
        if value == "199902":
            raise RuntimeError("locked")
        catalog.drop_partition(spark, table, column, value)

    real = catalog.drop_partitions
    monkeypatch.setattr(jobs, "drop_partitions", lambda *a: real(*a, drop_one=drop_one))
    audit = OutputSpec("orc", path("purged"), partition_column="dt")
    with pytest.raises(jobs.RunError):
        jobs.run(spark, config, replace(RUN, mode="stock", stock_start=date(1999, 1, 1)), None, audit)
    row = load(spark, InputSpec("orc", path("purged"))).first()
    assert row.purged_partitions == ["199901", "199903", "199904"] and (row.input_row_count, row.output_row_count) == (12, 0)


@pytest.mark.parametrize("change, message", [
    ({"purge_boolean": "true", "purge_duration": "3"}, "before they are masked"),
])
def test_purging_before_masking_is_refused(spark, change, message):
    with pytest.raises(ValueError, match=message):
        jobs.run(spark, typed_config(config_rows(spark, BASE | change)), RUN)


def test_conflicting_settings_are_refused(spark):
    rows = config_rows(spark, BASE, BASE | {"column_name": "z", "conserv_duration": "6"})
    with pytest.raises(ValueError, match="different settings"):
        plans(typed_config(rows))


def test_one_domain_keeps_joins(spark):
    from lethe.operators.masking import apply_rules

    left, right = (spark.createDataFrame([(f"A{i}",) for i in range(30)], f"{c} string") for c in ("cust", "client"))
    for method in ("id", "consistentStringFormatPreserving"):
        def joined(options):
            a = apply_rules(left, [Rule("cust", method, options)], MaskContext("k"))
            b = apply_rules(right, [Rule("client", method, options)], MaskContext("k"))
            return a.join(b, F.col("cust") == F.col("client")).count()

        assert joined({"domain": "person"}) >= 30 > joined({})


def daily_events(spark, data, path):
    events = spark.createDataFrame(
        [("p0", "19990801", "20000309"), ("p1", "19990801", "20000310"), ("p2", "19990801", "20000311")],
        "person string, left string, dt string")
    plan = event_plan(spark, data, path, events, "jours")
    return replace(plan, clock=replace(plan.clock, value_format="yyyyMMdd"))


def masked_persons(spark, path):
    return {r.person for r in load(spark, InputSpec("parquet", path("out"))).collect() if set(r.v) == {"X"}}


def day(n, **changes):
    return replace(RUN, run_date=date(2000, 3, n), **changes)


def test_a_new_key_keeps_earlier_persons_masked(spark, data, path):
    plan = daily_events(spark, data, path)
    jobs.retain_mask_by_event(spark, plan, day(10))
    before = counted(load(spark, InputSpec("parquet", path("out"))))
    with pytest.raises(KeyEpochError, match="former_keys"):
        jobs.retain_mask_by_event(spark, plan, day(11, key="k2"))
    with pytest.raises(KeyEpochError):
        jobs.retain_mask_by_event(spark, plan, day(11, key="k2", former_keys=("other",)))
    assert counted(load(spark, InputSpec("parquet", path("out")))) == before, "a refused run has written"
    for _ in range(2):
        jobs.retain_mask_by_event(spark, plan, day(11, key="k2", former_keys=("k",)))
        assert masked_persons(spark, path) == {"p0", "p1"}
    # A third key: persons carried before are carried on, with both former keys given.
    with pytest.raises(KeyEpochError):
        jobs.retain_mask_by_event(spark, plan, day(12, key="k3", former_keys=("k2",)))
    jobs.retain_mask_by_event(spark, plan, day(12, key="k3", former_keys=("k2", "k")))
    assert masked_persons(spark, path) == {"p0", "p1", "p2"}


def test_persons_who_come_back_after_a_key_change_are_known_again(spark, data, path):
    """A person without rows on the day of the change is carried once rows appear."""
    plan = daily_events(spark, data, path)
    jobs.retain_mask_by_event(spark, plan, day(10))
    data.where("person <> 'p0'").write.mode("overwrite").partitionBy("dt").parquet(path("in"))
    jobs.retain_mask_by_event(spark, plan, day(11, key="k2", former_keys=("k",)))
    assert masked_persons(spark, path) == {"p1"}
    data.write.mode("overwrite").partitionBy("dt").parquet(path("in"))
    jobs.retain_mask_by_event(spark, plan, day(12, key="k2", former_keys=("k",)))
    assert masked_persons(spark, path) == {"p0", "p1", "p2"}


def test_index_of_persons(spark, path):
    """With the index the results are those without it, and only partitions with expired persons are opened."""
    rows = [(i, f"p{i % 3}" if i % 4 == 0 else f"q{i}", f"secret {i}", f"1999{i // 8 + 1:02}") for i in range(96)]
    rows += [(200, None, "nobody", "199912"), (201, "p0", "x y", "1998 odd/day")]
    data = spark.createDataFrame(rows, "id int, person string, v string, dt string")
    plan = daily_events(spark, data, path)
    plain = replace(plan, output=replace(plan.output, path=path("plain")))
    for n in (10, 11, 11):
        jobs.retain_mask_by_event(spark, plain, day(n))
        outcome = jobs.retain_mask_by_event(spark, plan, day(n, person_index=True))
        found = counted(load(spark, InputSpec("parquet", path("out"))))
        assert found == counted(load(spark, InputSpec("parquet", path("plain"))))
    assert outcome.rows_in == sum(r[1] == "p1" for r in rows)


def test_index_follows_changed_partitions(spark, data, path):
    source = plan_for(data, path).source
    index = path("index")
    run = day(10)
    persons = lambda *names: spark.createDataFrame([(n,) for n in names], "p string").select(person_hash("k", F.col("p")).alias(PERSON))
    assert refresh(spark, source, "person", index, run) == 4
    assert refresh(spark, source, "person", index, run) == 0
    assert partitions_of(spark, index, persons("p0")) == ["199901", "199902", "199903", "199904"]
    assert partitions_of(spark, index, persons("p9")) == partitions_of(spark, index, persons()) == []
    more = spark.createDataFrame([(900, "p9", "v", "199902"), (901, "p9", "v", "199905"), (902, None, "v", "199906")], data.schema)
    more.write.mode("append").partitionBy("dt").parquet(path("in"))
    assert refresh(spark, source, "person", index, run) == 3
    assert partitions_of(spark, index, persons("p9")) == ["199902", "199905"]
    assert refresh(spark, source, "person", index, run) == 0
    with pytest.raises(ValueError, match="no folders"):
        refresh(spark, replace(source, partition_column="day"), "person", path("other"), run)


@pytest.mark.parametrize("fmt", ["orc", "parquet", "table"])
@pytest.mark.parametrize("mode", ["append", "overwrite_partitions"])
def test_a_repeated_run_replaces_its_audits(spark, data, path, fmt, mode):
    """Two equal runs over two tables leave one set of rows, on whatever day and in whatever mode."""
    database = scratch_database(spark, "twice")
    rows = []
    for name in ("a", "b"):
        data.write.partitionBy("dt").saveAsTable(f"{database}.{name}")
        rows.append(BASE | {"base": database, "table_name": name, "input_format": "table", "output_path": path(name),
                            "output_partitioned_by": "dt", "anonymisation_methode": "XReplace"})
    config = typed_config(config_rows(spark, *rows))
    spec = OutputSpec(fmt, None if fmt == "table" else path("audit"), f"{database}.audit" if fmt == "table" else None, "dt", mode=mode)
    saved = lambda: load(spark, InputSpec(fmt, spec.path, spec.table)).collect()
    for _ in range(2):
        jobs.run(spark, config, RUN, spec, parallel=2)
        assert sorted((r.tableName, r.run_id) for r in saved()) == [("a", "2000-03-10-normal"), ("b", "2000-03-10-normal")]
    days = {r.dt for r in saved()}
    # A later attempt keeps the day, another run has rows of its own.
    audit = mask_audit(config, [TableRun(database, "a", (), 1, 1, datetime(2030, 1, 1), datetime(2030, 1, 1))], "me")
    replace_audit(audit, spec, RUN.identity, f"{database}.a")
    assert {r.dt for r in saved()} == days and sorted((r.tableName, r.input_row_count) for r in saved()) == [("a", 1), ("b", 8)]
    jobs.run(spark, config, replace(RUN, run_date=date(2000, 4, 10)), spec)
    assert len(saved()) == 4


def test_audits_of_an_earlier_layout_are_added_to(spark, data, path):
    row = BASE | {"input_format": "parquet", "input_path": path("in"), "output_path": path("out"), "anonymisation_methode": "XReplace"}
    data.write.partitionBy("dt").parquet(path("in"))
    config, spec = typed_config(config_rows(spark, row)), OutputSpec("orc", path("audit"), partition_column="dt")
    audit = mask_audit(config, [TableRun("b", "t", (), 1, 1, datetime(2030, 1, 1), datetime(2030, 1, 1))], "me")
    append_audit([audit], spec)
    jobs.run(spark, config, RUN, spec)
    assert len(load(spark, InputSpec("orc", path("audit"))).collect()) == 2
