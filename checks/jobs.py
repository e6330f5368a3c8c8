"""Configuration, events, audits and the whole jobs."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.files import month_table
from checks.masks import number, seed
from lethe.operators import audit, events
from lethe.operators.configuration import plan_rows, plans, rules_for, tables
from lethe.operators.masking import apply_rules
from lethe.operators.options import options_map
from lethe.plans import jobs
from lethe.scratch import scratch_path
from lethe.sources import CONFIG_COLUMNS, load, typed_config
from lethe.specs import EventClock, InputSpec, OutputSpec, Rule, Run, TablePlan

QUERIES, ORACLES = {}, {}


def query(name: str, oracle: str):
    def register(function):
        QUERIES[name], ORACLES[name] = function, oracle
        return function

    return register


# --- Configuration -------------------------------------------------------------------------

TYPED_DUCK = f"""SELECT base, table_name, column_name, partition_value_format,
  CAST(trim(conserv_duration) AS INT) AS conserv_duration, CAST(purge_duration AS INT) AS purge_duration,
  purge_boolean = 'true' AS purge_boolean, anonymisation_methode, anonymisation_methode_options,
  anonymisation_methode_options_values, declencheur FROM ({fx.CONFIG_DUCK}) AS c"""


def config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_config(fx.config(spark, sf_dir))


@query("config_rules_for", f"""SELECT column_name, anonymisation_methode, anonymisation_methode_options
  FROM ({TYPED_DUCK}) AS t WHERE base = 'b2' AND table_name = 't7'""")  # fmt: skip
def config_rules_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules_for(config(spark, sf_dir), "b2", "t7").select(
        "column_name", "anonymisation_methode", "anonymisation_methode_options"
    )


@query("config_tables", f"SELECT DISTINCT base, table_name FROM ({TYPED_DUCK}) AS t")
def config_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(config(spark, sf_dir))


@query("config_plans", f"""SELECT base, table_name,
    string_agg(column_name || ':' || anonymisation_methode, ',' ORDER BY column_name) AS rules,
    min(partition_value_format) AS partition_value_format, min(conserv_duration) AS conserv_duration,
    bool_or(purge_boolean) AS purge_boolean, min(declencheur) AS declencheur
  FROM ({TYPED_DUCK}) AS t GROUP BY base, table_name""")  # fmt: skip
def config_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = F.transform("rules", lambda r: F.concat_ws(":", r["column_name"], r["anonymisation_methode"]))
    return plan_rows(config(spark, sf_dir)).select(
        "base", "table_name", F.array_join(rule, ",").alias("rules"), "settings.partition_value_format",
        "settings.conserv_duration", "settings.purge_boolean", "settings.declencheur",
    )


@query("options_parsed", f"""SELECT base, table_name, column_name,
    coalesce(array_to_string(list_transform(range(1, least(len(n), len(v)) + 1), lambda i: n[i] || '=' || v[i]), ';'), '')
      AS options
  FROM (SELECT base, table_name, column_name,
    CASE WHEN o IS NULL THEN [''] ELSE string_split(o, '.') END AS n,
    CASE WHEN w IS NULL THEN [''] ELSE regexp_extract_all(w, '(\\[[^\\]]*\\]|[^.\\[\\]])+') END AS v
    FROM (SELECT base, table_name, column_name, anonymisation_methode_options AS o,
      anonymisation_methode_options_values AS w FROM ({TYPED_DUCK}) AS t) AS x) AS y""")  # fmt: skip
def options_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = options_map(F.col("anonymisation_methode_options"), F.col("anonymisation_methode_options_values"))
    text = F.array_join(
        F.transform(F.map_entries(pairs), lambda e: F.concat_ws("=", e["key"], e["value"])), ";"
    )
    return config(spark, sf_dir).select("base", "table_name", "column_name", text.alias("options"))


# --- Audits ----------------------------------------------------------------------------------


def _list_duck(column: str) -> str:
    return f"string_agg(coalesce({column}, ''), ',' ORDER BY column_name)"


@query("audit_lists", f"""SELECT base AS "dataBaseName", table_name AS "tableName",
    {_list_duck('column_name')} AS "columnNames", {_list_duck('anonymisation_methode')} AS "desensitizationMethods",
    {_list_duck('anonymisation_methode_options')} AS "desensitizationMethodsOptions",
    {_list_duck('anonymisation_methode_options_values')} AS "desensitizationMethodsOptionsValue"
  FROM ({TYPED_DUCK}) AS t GROUP BY base, table_name""")  # fmt: skip
def audit_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = audit.audit_lists(config(spark, sf_dir))
    return lists.select(
        "dataBaseName", "tableName", *[F.array_join(c, ",").alias(c) for c in lists.columns[2:]]
    )


START, END = datetime(2000, 1, 15, 5, 0, 0), datetime(2000, 1, 15, 5, 1, 30)


@query("mask_audit", f"""SELECT base AS "dataBaseName", table_name AS "tableName",
    {_list_duck('column_name')} AS "columnNames", {_list_duck('anonymisation_methode')} AS "desensitizationMethods",
    '199901,199902' AS desensitized_partitions, (SELECT count(*) FROM orders) AS input_row_count,
    (SELECT count(*) FROM orders) AS output_row_count, 90.0::DOUBLE AS processing_time,
    'batch' AS "principalKeytab", '2000-01-15' AS dt
  FROM ({TYPED_DUCK}) AS t WHERE base = 'b2' AND table_name = 't7' GROUP BY base, table_name""")  # fmt: skip
def mask_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "orders").count()
    done = audit.TableRun("b2", "t7", ("199901", "199902"), rows, rows, START, END)
    row = audit.mask_audit(config(spark, sf_dir), [done], "batch")
    joined = ("columnNames", "desensitizationMethods", "desensitized_partitions")
    return row.select(
        "dataBaseName", "tableName", *[F.array_join(c, ",").alias(c) for c in joined], "input_row_count",
        "output_row_count", "processing_time", "principalKeytab", "dt",
    )


@query("purge_audit", f"""SELECT base AS "dataBaseName", table_name AS "tableName",
    {_list_duck('column_name')} AS "columnNames", '199901' AS purged_partitions,
    (SELECT count(*) FROM orders) AS input_row_count, 0::BIGINT AS output_row_count, 90.0::DOUBLE AS processing_time,
    'batch' AS "principalKeytab", '2000-01-15' AS dt
  FROM ({TYPED_DUCK}) AS t WHERE base = 'b2' AND table_name = 't7' GROUP BY base, table_name""")  # fmt: skip
def purge_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "orders").count()
    done = audit.TableRun("b2", "t7", ("199901",), rows, 0, START, END)
    row = audit.purge_audit(config(spark, sf_dir), [done], "batch")
    return row.select(
        "dataBaseName", "tableName", *[F.array_join(c, ",").alias(c) for c in ("columnNames", "purged_partitions")],
        "input_row_count", "output_row_count", "processing_time", "principalKeytab", "dt",
    )


# --- Events ------------------------------------------------------------------------------------

EVENT_RULES = (Rule("o_orderpriority", "XReplace"), Rule("o_totalprice", "blank", {"respect_type": "true"}))
BARE_PRIORITY = "replace(replace(replace(o_orderpriority, ' ', ''), '-', ''), '/', '')"


def keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = fx.person_events(spark, sf_dir)
    return events.expired_keys(people, "custkey", "event_date", "yyyyMMdd", fx.EVENT_LIMIT).withColumnRenamed(
        "custkey", "o_custkey"
    )


@query("event_months", f"SELECT DISTINCT substr(event_date, 1, 6) AS event_month FROM ({fx.PERSON_EVENTS_DUCK}) AS e")
def event_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.event_months(fx.person_events(spark, sf_dir), "event_date", "yyyyMMdd")


@query("event_ids", f"SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IN ({fx.EXPIRED_DUCK})")
def event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.expired_ids(fx.table(spark, sf_dir, "orders"), keys(spark, sf_dir), "o_custkey")


@query("event_partitions", f"""SELECT strftime(o_orderdate, '%Y%m') AS dt, count(*) AS expired_rows FROM orders
  WHERE o_custkey IN ({fx.EXPIRED_DUCK}) GROUP BY ALL""")  # fmt: skip
def event_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.expired_row_counts(fx.dated_orders(spark, sf_dir), keys(spark, sf_dir), "o_custkey", "dt")


@query("split_expired", f"SELECT * FROM orders WHERE o_custkey IN ({fx.EXPIRED_DUCK})")
def split_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.split_by_keys(fx.table(spark, sf_dir, "orders"), keys(spark, sf_dir), "o_custkey")[0]


@query("split_kept", f"SELECT * FROM orders WHERE o_custkey NOT IN ({fx.EXPIRED_DUCK})")
def split_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.split_by_keys(fx.table(spark, sf_dir, "orders"), keys(spark, sf_dir), "o_custkey")[1]


MASKED_BY_EVENT = f"""SELECT o_orderkey, o_custkey, o_orderstatus,
    CASE WHEN e THEN 0.0::DOUBLE ELSE o_totalprice END AS o_totalprice, o_orderdate,
    CASE WHEN e THEN repeat('X', length({BARE_PRIORITY})) ELSE o_orderpriority END AS o_orderpriority
  FROM (SELECT *, o_custkey IN ({fx.EXPIRED_DUCK}) AS e FROM orders) AS o"""


@query("mask_event_rows", MASKED_BY_EVENT)
def mask_event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders")
    return events.mask_where(orders, keys(spark, sf_dir), "o_custkey", EVENT_RULES, fx.context("o_orderkey"))


@query("mask_event_permuted", f"""
  WITH o AS (SELECT o_orderkey, o_orderpriority, o_custkey IN ({fx.EXPIRED_DUCK}) AS e FROM orders)
  SELECT o_orderkey, coalesce(lead(o_orderpriority) OVER w, first_value(o_orderpriority) OVER
      (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS o_orderpriority
  FROM o WHERE e WINDOW w AS (ORDER BY {number(seed('o_orderpriority', 'o_orderkey'), 1, 15)}, o_orderkey)
  UNION ALL SELECT o_orderkey, o_orderpriority FROM o WHERE NOT e""")  # fmt: skip
def mask_event_permuted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values permuted among the rows of expired persons only."""
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    rules = [Rule("o_orderpriority", "keepDistribution")]
    masked = events.mask_where(orders, keys(spark, sf_dir), "o_custkey", rules, fx.context("o_orderkey"))
    return masked.select("o_orderkey", "o_orderpriority")


@query("mask_union", MASKED_BY_EVENT)
def mask_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked expired rows and untouched rows put together again."""
    expired, kept = events.split_by_keys(fx.table(spark, sf_dir, "orders"), keys(spark, sf_dir), "o_custkey")
    return apply_rules(expired, EVENT_RULES, fx.context("o_orderkey")).unionByName(kept)


@query("except_rows", f"""SELECT o_custkey, o_orderstatus FROM orders EXCEPT
  SELECT o_custkey, o_orderstatus FROM orders WHERE o_custkey IN ({fx.EXPIRED_DUCK})""")  # fmt: skip
def except_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus")
    return events.distinct_except(orders, events.split_by_keys(orders, keys(spark, sf_dir), "o_custkey")[0])


@query("mask_row_counts", f"""SELECT (SELECT count(*) FROM orders) AS input_row_count,
  (SELECT count(*) FROM ({MASKED_BY_EVENT}) AS m) AS output_row_count""")  # fmt: skip
def mask_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.row_counts(fx.table(spark, sf_dir, "orders"), mask_event_rows(spark, sf_dir))


# --- Jobs ----------------------------------------------------------------------------------------

JOB_RULES = (
    Rule("c_name", "hashWithSha256"),
    Rule("o_orderpriority", "XReplace"),
    Rule("o_totalprice", "blank", {"respect_type": "true"}),
)
RUN = Run(fx.RUN_DATE, mode="stock", key=fx.CHECK_KEY, principal="batch", stock_start=fx.STOCK_START)


def order_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the customer's name, dated by month."""
    customer = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return fx.dated_orders(spark, sf_dir).join(customer, "o_custkey").select(
        "o_orderkey", "o_custkey", "c_name", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "dt"
    )


def execution_plan(source: InputSpec, output_path: str) -> TablePlan:
    return TablePlan(
        base="sales",
        table="orders",
        source=source,
        output=OutputSpec("parquet", output_path, "sales.orders_desensitized", "dt", mode="overwrite_partitions"),
        partition_format="yyyyMM",
        keep_months=12,
        purge_months=24,
        purge=True,
        trigger="execution",
        rules=JOB_RULES,
    )


@query("job_mask_execution", f"""SELECT o_orderkey, o_custkey, sha256(c_name) AS c_name, o_orderstatus,
    0.0::DOUBLE AS o_totalprice, o_orderdate, repeat('X', length({BARE_PRIORITY})) AS o_orderpriority,
    strftime(o_orderdate, '%Y%m') AS dt
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE o_orderdate >= DATE '1995-01-01' AND o_orderdate < DATE '1999-01-01'""")  # fmt: skip
def job_mask_execution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: mask the months older than the keeping period and read them back."""
    source = InputSpec("parquet", fx.stored(order_data(spark, sf_dir), "orders"))
    plan = execution_plan(source, scratch_path(spark, "masked"))
    jobs.retain_mask(spark, plan, RUN)
    return load(spark, InputSpec("parquet", plan.output.path))


def months_job(layout: str | None):
    """Three monthly runs, the second one twice; everything masked so far has to be there once."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = fx.stored(order_data(spark, sf_dir), "orders")
        row = {"base": "sales", "table_name": "orders", "input_format": "parquet", "input_path": source, "partition_column": "dt",
               "partition_value_format": "yyyyMM", "output_format": "parquet", "output_path": scratch_path(spark, "months"),
               "output_partitioned_by": layout, "conserv_duration": "12", "declencheur": "execution",
               "column_name": "o_orderpriority", "anonymisation_methode": "XReplace"}
        schema = ", ".join(f"{c} string" for c in CONFIG_COLUMNS)
        config = typed_config(spark.createDataFrame([tuple(row.get(c) for c in CONFIG_COLUMNS)], schema))
        counts = {}
        for month in (2, 3, 3, 4):
            report = jobs.run(spark, config, replace(RUN, run_date=date(1998, month, 15), mode="normal"))
            counts[month] = report.masked[0].rows_out
        found = load(spark, InputSpec("parquet", row["output_path"]))
        return found.select("o_orderkey", "o_orderpriority", "dt", F.lit(sum(counts.values())).alias("rows_out"))

    return run


for _name, _layout in (("job_mask_months", None), ("job_mask_months_by_status", "o_orderstatus")):
    query(_name, f"""SELECT o_orderkey, repeat('X', length({BARE_PRIORITY})) AS o_orderpriority, strftime(o_orderdate, '%Y%m') AS dt,
        CAST(count(*) OVER () AS INT) AS rows_out
      FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1997-04-01'""")(months_job(_layout))  # fmt: skip


@query("job_purge_unmasked", """SELECT strftime(o_orderdate, '%Y%m') AS dt, count(*) AS row_count FROM orders
  WHERE strftime(o_orderdate, '%Y%m') NOT IN ('199703', '199704') GROUP BY ALL""")  # fmt: skip
def job_purge_unmasked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only two months were masked, so a purge of everything old leaves the other months where they are."""
    source = InputSpec("table", table=month_table(spark, sf_dir, "unmasked"))
    plan = replace(execution_plan(source, scratch_path(spark, "masked")), purge_months=12, rules=EVENT_RULES)
    for month in (4, 5):
        jobs.retain_mask(spark, plan, replace(RUN, run_date=date(1998, month, 15), mode="normal"))
    jobs.purge(spark, plan, replace(RUN, run_date=date(1998, 6, 15)), only_masked=True)
    return load(spark, source).groupBy("dt").agg(F.count("*").alias("row_count"))


@query("job_purge_clear_copy", """SELECT strftime(o_orderdate, '%Y%m') AS dt, count(*) AS row_count FROM orders
  WHERE strftime(o_orderdate, '%Y%m') NOT IN ('199703', '199704') GROUP BY ALL""")  # fmt: skip
def job_purge_clear_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The output holds every month in as many rows, but only two of them masked: the purge drops these and no others."""
    source = InputSpec("table", table=month_table(spark, sf_dir, "clear"))
    plan = replace(execution_plan(source, scratch_path(spark, "masked")), purge_months=12, rules=EVENT_RULES)
    load(spark, source).where("dt NOT IN ('199703', '199704')").hint("rebalance", "dt").write.partitionBy("dt").parquet(plan.output.path)
    for month in (4, 5):
        jobs.retain_mask(spark, plan, replace(RUN, run_date=date(1998, month, 15), mode="normal"))
    jobs.purge(spark, plan, replace(RUN, run_date=date(1998, 6, 15)), only_masked=True)
    return load(spark, source).groupBy("dt").agg(F.count("*").alias("row_count"))


@query("job_purge", """SELECT strftime(o_orderdate, '%Y%m') AS dt, count(*) AS row_count FROM orders
  WHERE strftime(o_orderdate, '%Y%m') >= '199801' GROUP BY ALL""")  # fmt: skip
def job_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per month left after the months past the purge period are dropped."""
    source = InputSpec("table", table=month_table(spark, sf_dir, "purge"))
    jobs.purge(spark, execution_plan(source, ""), RUN)
    return load(spark, source).groupBy("dt").agg(F.count("*").alias("row_count"))


# Run on 15 January 1997 with a keeping period of 7 months: events before June 1996 have expired.
EVENT_RUN = replace(RUN, run_date=date(1997, 1, 15), mode="normal")


def event_plan(spark: SparkSession, sf_dir: str) -> TablePlan:
    """Orders masked by the first order date of each customer, kept as a monthly snapshot."""
    people = fx.person_events(spark, sf_dir).withColumnRenamed("custkey", "o_custkey")
    snapshots = people.withColumn("dt", F.explode(F.array(F.lit("199611"), F.lit("199612"))))
    clock = EventClock(
        source=InputSpec("parquet", fx.stored(snapshots, "people")),
        value_format="yyyyMM",
        join_column="o_custkey",
        process_column="event_date",
        process_format="yyyyMMdd",
        frequency="mois",
        min_value="19900101",
    )
    plan = execution_plan(
        InputSpec("parquet", fx.stored(fx.dated_orders(spark, sf_dir), "orders")), scratch_path(spark, "masked")
    )
    return replace(plan, keep_months=7, purge=False, trigger="depart", rules=EVENT_RULES, clock=clock)


@query("job_mask_event", f"""SELECT m.*, strftime(m.o_orderdate, '%Y%m') AS dt FROM ({MASKED_BY_EVENT}) AS m
  WHERE strftime(m.o_orderdate, '%Y%m') IN
    (SELECT strftime(o_orderdate, '%Y%m') FROM orders WHERE o_custkey IN ({fx.EXPIRED_DUCK}))""")  # fmt: skip
def job_mask_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = event_plan(spark, sf_dir)
    jobs.retain_mask_by_event(spark, plan, EVENT_RUN)
    return load(spark, InputSpec("parquet", plan.output.path))


DAYS_DUCK = f"""SELECT m.o_orderkey, CASE WHEN e THEN repeat('X', length({BARE_PRIORITY})) ELSE o_orderpriority END AS o_orderpriority
  FROM (SELECT *, o_custkey IN ({fx.EXPIRED_DUCK}) AS e, strftime(o_orderdate, '%Y%m') AS dt FROM orders) AS m
  WHERE dt IN (SELECT strftime(o_orderdate, '%Y%m') FROM orders WHERE o_custkey IN ({fx.EXPIRED_DUCK}))"""


def daily_runs(spark: SparkSession, sf_dir: str, *runs: Run) -> DataFrame:
    """Persons of even and of odd number expire on two days; what the runs leave."""
    plan = event_plan(spark, sf_dir)
    people = load(spark, plan.clock.source).where("dt = '199612'").drop("dt")
    days = people.withColumn("dt", F.when(F.col("o_custkey") % 2 == 0, "19970114").otherwise("19970115"))
    clock = replace(plan.clock, source=InputSpec("parquet", fx.stored(days, "days")), value_format="yyyyMMdd", frequency="jours")
    plan = replace(plan, clock=clock, rules=EVENT_RULES[:1])
    for run in runs:
        jobs.retain_mask_by_event(spark, plan, run)
    return load(spark, InputSpec("parquet", plan.output.path)).select("o_orderkey", "o_orderpriority")


def on_day(day: int, **changes) -> Run:
    return replace(EVENT_RUN, run_date=date(1997, 1, day), **changes)


@query("job_mask_event_days", DAYS_DUCK)
def job_mask_event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over disjoint groups of persons, the second one twice: both groups stay masked."""
    return daily_runs(spark, sf_dir, *[on_day(day) for day in (15, 16, 16)])


@query("job_mask_event_rekeyed", DAYS_DUCK)
def job_mask_event_rekeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second day runs, twice, under another key: the persons of the first day stay masked."""
    later = on_day(16, key="another-key", former_keys=(fx.CHECK_KEY,))
    return daily_runs(spark, sf_dir, on_day(15), later, later)


@query("job_mask_event_indexed", DAYS_DUCK)
def job_mask_event_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same days with an index of persons, which decides what is opened and changes no result."""
    return daily_runs(spark, sf_dir, *[on_day(day, person_index=True) for day in (15, 16, 16)])


def run_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configuration of three tables: two on the run date, one of them purged, and one on events."""
    orders = month_table(spark, sf_dir, "run")
    database = orders.split(".")[0]
    fx.table(spark, sf_dir, "lineitem").withColumn("dt", F.date_format("l_shipdate", "yyyy-MM")).hint(
        "rebalance", "dt"
    ).write.partitionBy("dt").saveAsTable(f"{database}.lines_by_month")
    plan = event_plan(spark, sf_dir)
    common = {"base": database, "input_format": "table", "partition_column": "dt", "output_format": "parquet",
              "output_partitioned_by": "dt", "conserv_duration": "7", "purge_duration": "12",
              "purge_boolean": "false", "declencheur": "execution"}
    by_orders = common | {"table_name": "orders_by_month", "partition_value_format": "yyyyMM", "purge_boolean": "true",
                          "output_path": scratch_path(spark, "out")}
    by_lines = common | {"table_name": "lines_by_month", "partition_value_format": "yyyy-MM",
                         "output_path": scratch_path(spark, "out")}
    by_event = common | {
        "table_name": "people_orders", "partition_value_format": "yyyyMM", "output_path": scratch_path(spark, "out"),
        "input_format": "parquet", "input_path": plan.source.path, "declencheur": "depart",
        "declench_database_name": "crm", "declench_table_name": "people", "declench_input_format": "parquet",
        "declench_input_path": plan.clock.source.path, "declench_partition_column": "dt",
        "declench_partition_column_value_format": "yyyyMM", "declench_column_join": "o_custkey",
        "declench_column_process": "event_date", "declench_column_process_value_format": "yyyyMMdd",
        "declench_table_frequency": "mois",
    }
    rows = [
        by_orders | {"column_name": "o_orderpriority", "anonymisation_methode": "XReplace"},
        by_orders | {"column_name": "o_totalprice", "anonymisation_methode": "blank",
                     "anonymisation_methode_options": "respect_type", "anonymisation_methode_options_values": "true"},
        by_lines | {"column_name": "l_extendedprice", "anonymisation_methode": "null"},
        by_event | {"column_name": "o_orderpriority", "anonymisation_methode": "0Replace"},
    ]
    schema = ", ".join(f"{c} string" for c in CONFIG_COLUMNS)
    return typed_config(spark.createDataFrame([tuple(r.get(c) for c in CONFIG_COLUMNS) for r in rows], schema))


AUDIT_DUCK = f"""
  WITH o AS (SELECT o_custkey, strftime(o_orderdate, '%Y%m') AS dt FROM orders),
  e AS (SELECT dt FROM o WHERE o_custkey IN ({fx.EXPIRED_DUCK}))
  SELECT 'mask' AS kind, 'orders_by_month' AS "tableName", 'o_orderpriority,o_totalprice' AS "columnNames",
    'XReplace,blank' AS methods, CAST(17 AS INT) AS partitions, count(*) AS input_row_count, count(*) AS output_row_count
  FROM o WHERE dt < '199606'
  UNION ALL SELECT 'mask', 'lines_by_month', 'l_extendedprice', 'null', 17, count(*), count(*)
  FROM lineitem WHERE strftime(l_shipdate, '%Y%m') < '199606'
  UNION ALL SELECT 'mask', 'people_orders', 'o_orderpriority', '0Replace', CAST(count(DISTINCT dt) AS INT), count(*), count(*) FROM e
  UNION ALL SELECT 'purge', 'orders_by_month', 'o_orderpriority,o_totalprice', NULL, CAST(count(DISTINCT dt) AS INT), count(*), 0
  FROM o WHERE dt < '199601'"""


@query("job_run_audit", AUDIT_DUCK)
def job_run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run over a configuration; its saved audits of both kinds."""
    base = scratch_path(spark, "audit")
    specs = [OutputSpec("orc", f"{base}/{kind}", partition_column="dt") for kind in ("mask", "purge")]
    jobs.run(spark, run_config(spark, sf_dir), replace(EVENT_RUN, mode="stock"), *specs)
    return audit_summary(spark, specs)


def audit_summary(spark: SparkSession, specs: list[OutputSpec]) -> DataFrame:
    """The saved audits of masks and purges, one below the other."""
    mask, purge = (load(spark, InputSpec("orc", spec.path)) for spec in specs)

    def summary(kind: str, df: DataFrame, partitions: str) -> DataFrame:
        methods = "desensitizationMethods" if "desensitizationMethods" in df.columns else None
        return df.select(
            F.lit(kind).alias("kind"), "tableName", F.array_join("columnNames", ",").alias("columnNames"),
            (F.array_join(methods, ",") if methods else F.lit(None).cast("string")).alias("methods"),
            F.size(partitions).alias("partitions"), "input_row_count", "output_row_count",
        )

    return summary("mask", mask, "desensitized_partitions").unionByName(summary("purge", purge, "purged_partitions"))


@query("job_run_repeated", AUDIT_DUCK)
def job_run_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run, and again the tables whose originals were not purged, several at a time: the audits are there once."""
    base, config = scratch_path(spark, "audit"), run_config(spark, sf_dir)
    specs = [OutputSpec("orc", f"{base}/{kind}", partition_column="dt") for kind in ("mask", "purge")]
    jobs.run(spark, config, replace(EVENT_RUN, mode="stock"), *specs, parallel=3)
    jobs.run(spark, config.where("table_name <> 'orders_by_month'"), replace(EVENT_RUN, mode="stock"), *specs, parallel=3)
    return audit_summary(spark, specs)


@query("job_run_resumed", AUDIT_DUCK)
def job_run_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An attempt that masks, five partitions at a time, and stops before it purges or audits; the next one goes on: the audits are those of one run."""
    base, config = scratch_path(spark, "audit"), run_config(spark, sf_dir)
    specs = [OutputSpec("orc", f"{base}/{kind}", partition_column="dt") for kind in ("mask", "purge")]
    run = replace(EVENT_RUN, mode="stock", state=f"{base}/state", step_partitions=5)
    for plan in plans(config):
        (jobs.retain_mask_by_event if plan.clock else jobs.retain_mask)(spark, plan, run)
    jobs.run(spark, config, run, *specs)
    return audit_summary(spark, specs)
