"""Retention calendar over the days and keys of the orders, and partition availability."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from lethe.functions import calendar
from lethe.operators import readiness
from lethe.plans import plan_partitions
from lethe.sources import load, typed_config
from lethe.specs import InputSpec, Run

QUERIES, ORACLES = {}, {}


def query(name: str, oracle: str):
    def register(function):
        QUERIES[name], ORACLES[name] = function, oracle
        return function

    return register


def months_before(day: str, months: str | int) -> str:
    return f"CAST({day} - to_months(CAST({months} AS INT)) AS DATE)"


def summary(values: Column) -> list[Column]:
    """A list of partition values as a few scalars that fix it completely."""
    ordered = F.array_sort(values)
    return [
        F.size(ordered).alias("n"),
        F.get(ordered, F.lit(0)).alias("first_value"),
        F.sha2(F.array_join(ordered, ","), 256).alias("digest"),
    ]


def summary_duck(days: str, fmt: str) -> str:
    """The same for a DuckDB list of dates."""
    values = f"list_sort(list_transform({days}, lambda d: strftime(d, '{fmt}')))"
    return (
        f"CAST(len({days}) AS INT) AS n, {values}[1] AS first_value, "
        f"sha256(coalesce(array_to_string({values}, ','), '')) AS digest"
    )


KEEP = 12
CUT = months_before("run_date", KEEP)
MONTH_DAYS = (
    f"generate_series(date_trunc('month', {months_before(CUT, 1)}), "
    f"last_day({months_before(CUT, 1)}), INTERVAL 1 DAY)"
)


@query(
    "cal_cutoff",
    f"SELECT o_orderkey, {months_before('CAST(o_orderdate AS DATE)', 'o_orderkey % 40')} AS cutoff FROM orders",
)
def cal_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = calendar.cutoff(F.to_date("o_orderdate"), (F.col("o_orderkey") % 40).cast("int"))
    return fx.table(spark, sf_dir, "orders").select("o_orderkey", cut.alias("cutoff"))


def _month_partitions(fmt: str):
    def function(spark: SparkSession, sf_dir: str) -> DataFrame:
        values = calendar.month_partitions(calendar.cutoff(F.col("run_date"), KEEP), fmt)
        return fx.run_dates(spark, sf_dir).select("run_date", *summary(values))

    return function


QUERIES["cal_days"] = _month_partitions("yyyyMMdd")
ORACLES["cal_days"] = f"SELECT run_date, {summary_duck(MONTH_DAYS, '%Y%m%d')} FROM ({fx.RUN_DATES_DUCK}) AS r"
QUERIES["cal_days_dashed"] = _month_partitions("yyyy-MM-dd")
ORACLES["cal_days_dashed"] = f"SELECT run_date, {summary_duck(MONTH_DAYS, '%Y-%m-%d')} FROM ({fx.RUN_DATES_DUCK}) AS r"
QUERIES["cal_month"] = _month_partitions("yyyyMM")
ORACLES["cal_month"] = (
    f"SELECT run_date, {summary_duck('[' + months_before(CUT, 1) + ']', '%Y%m')} FROM ({fx.RUN_DATES_DUCK}) AS r"
)


def _stock(fmt: str):
    def function(spark: SparkSession, sf_dir: str) -> DataFrame:
        cut = calendar.cutoff(F.col("run_date"), KEEP)
        values = calendar.stock_partitions(cut, fmt, date(1995, 3, 10))
        return fx.run_dates(spark, sf_dir).select("run_date", *summary(values))

    return function


QUERIES["cal_stock_days"] = _stock("yyyy-MM-dd")
ORACLES["cal_stock_days"] = f"""SELECT run_date, {summary_duck('days', '%Y-%m-%d')} FROM (
  SELECT run_date, CASE WHEN {CUT} > DATE '1995-03-10' THEN generate_series(DATE '1995-03-10',
    CAST({CUT} - INTERVAL 1 DAY AS DATE), INTERVAL 1 DAY) ELSE [] END AS days FROM ({fx.RUN_DATES_DUCK}) AS r) AS s"""
QUERIES["cal_stock_months"] = _stock("yyyyMM")
ORACLES["cal_stock_months"] = f"""SELECT run_date, {summary_duck('months', '%Y%m')} FROM (
  SELECT run_date, CASE WHEN date_trunc('month', {CUT}) > DATE '1995-03-01' THEN generate_series(DATE '1995-03-01',
    CAST(date_trunc('month', {CUT}) - INTERVAL 1 MONTH AS DATE), INTERVAL 1 MONTH) ELSE [] END AS months
  FROM ({fx.RUN_DATES_DUCK}) AS r) AS s"""


@query(
    "cal_event_days",
    f"""SELECT run_date, strftime(run_date - 1, '%Y%m%d') AS daily,
      array_to_string(list_transform(generate_series(run_date - 7, run_date - 1, INTERVAL 1 DAY),
        lambda d: strftime(d, '%Y%m%d')), ',') AS weekly,
      strftime({months_before('run_date', 1)}, '%Y%m') AS monthly
    FROM ({fx.RUN_DATES_DUCK}) AS r""",
)
def cal_event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("run_date")
    return fx.run_dates(spark, sf_dir).select(
        day,
        F.array_join(calendar.event_partitions(day, "jours", "yyyyMMdd"), ",").alias("daily"),
        F.array_join(calendar.event_partitions(day, "semaine", "yyyyMMdd"), ",").alias("weekly"),
        F.array_join(calendar.event_partitions(day, "mois", "yyyyMM"), ",").alias("monthly"),
    )


@query(
    "event_month_of",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN strftime(o_orderdate, '%Y%m') END AS compact,
         strftime(o_orderdate, '%Y%m') AS dashed, CAST(NULL AS VARCHAR) AS other FROM orders""",
)
def event_month_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    compact = F.when(F.col("o_orderkey") % 11 == 0, "n/a").otherwise(F.date_format(day, "yyyyMMdd"))
    return fx.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        calendar.event_month(compact, "yyyyMMdd").alias("compact"),
        calendar.event_month(F.date_format(day, "yyyy-MM-dd"), "yyyy-MM-dd").alias("dashed"),
        # Texts in another format than the stated one; an unknown format would be an error.
        calendar.event_month(F.date_format(day, "dd/MM/yyyy"), "yyyyMMdd").alias("other"),
    )


@query(
    "cal_expired_months",
    """SELECT o_orderkey, coalesce(array_to_string(list_transform(CASE WHEN first <= last
         THEN generate_series(first, last, INTERVAL 1 MONTH) ELSE [] END, lambda d: strftime(d, '%Y%m')), ','), '')
         AS months
       FROM (SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS first,
         CAST(DATE '2000-01-01' - to_months(CAST(o_orderkey % 30 + 1 AS INT)) AS DATE) AS last FROM orders) AS o""",
)
def cal_expired_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep = (F.col("o_orderkey") % 30).cast("int")
    months = calendar.expired_months(F.to_date("o_orderdate"), F.lit(fx.RUN_DATE), keep)
    return fx.table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(months, ",").alias("months"))


MS = "event_id * 7654321 + 1700000000000"


@query(
    "fmt_ts",
    f"""SELECT event_id, strftime(ts, '%Y-%m-%d') AS dashed, strftime(ts, '%Y%m%d') AS compact,
          strftime(ts, '%d/%m/%Y %H:%M:%S.%g') AS long_form
        FROM (SELECT event_id, make_timestamp(({MS}) * 1000) AS ts FROM events) AS e""",
)
def fmt_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = F.expr(MS)
    return fx.table(spark, sf_dir, "events").select(
        "event_id",
        calendar.fmt_ts(ms, "yyyy-MM-dd").alias("dashed"),
        calendar.fmt_ts(ms, "yyyyMMdd").alias("compact"),
        calendar.fmt_ts(ms, "dd/MM/yyyy HH:mm:ss.SSS").alias("long_form"),
    )


# --- Partition plans of a configuration ------------------------------------------------

RUN = Run(date(2000, 3, 31))
STOCK_RUN = Run(date(2000, 3, 31), mode="stock", stock_start=fx.STOCK_START)
DUCK_VALUE = """CASE f WHEN 'yyyyMMdd' THEN strftime(d, '%Y%m%d') WHEN 'yyyyMM' THEN strftime(d, '%Y%m')
  WHEN 'yyyy-MM-dd' THEN strftime(d, '%Y-%m-%d') ELSE strftime(d, '%Y-%m') END"""


def _plan_duck(months: str, stock: bool) -> str:
    cut = f"CAST(DATE '2000-03-31' - to_months(CAST(trim({months}) AS INT)) AS DATE)"
    month = f"CAST({cut} - INTERVAL 1 MONTH AS DATE)"
    first = "DATE '1995-01-01'" if stock else f"date_trunc('month', {month})"
    day_end = f"CAST({cut} - INTERVAL 1 DAY AS DATE)" if stock else f"last_day({month})"
    return f"""
      SELECT base, table_name, {DUCK_VALUE} AS partition_value FROM (
        SELECT DISTINCT base, table_name, partition_value_format AS f, unnest(CASE WHEN length(partition_value_format) IN (8, 10)
            THEN generate_series({first}, {day_end}, INTERVAL 1 DAY)
            ELSE generate_series({first}, date_trunc('month', {month}), INTERVAL 1 MONTH) END) AS d
        FROM ({fx.CONFIG_DUCK}) AS c) AS p"""


def _plan_query(run: Run, months: str):
    def function(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plan_partitions(typed_config(fx.config(spark, sf_dir)), run, months)

    return function


QUERIES["plan_mask_partitions"] = _plan_query(STOCK_RUN, "conserv_duration")
ORACLES["plan_mask_partitions"] = _plan_duck("conserv_duration", True)
QUERIES["plan_purge_partitions"] = _plan_query(RUN, "purge_duration")
ORACLES["plan_purge_partitions"] = _plan_duck("purge_duration", False)


# --- Availability ------------------------------------------------------------------------


@query(
    "ready_missing",
    f"""SELECT dataset, partition_value, job, nominal_date, "offset", unit FROM ({fx.WANTED_DUCK}) AS w
        WHERE NOT EXISTS (SELECT 1 FROM ({fx.INVENTORY_DUCK}) AS i
          WHERE i.dataset = w.dataset AND i.partition_value = w.partition_value)""",
)
def ready_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = readiness.missing_partitions(fx.requests(spark, sf_dir), fx.inventory(spark, sf_dir))
    return missing.select("dataset", "partition_value", "job", "nominal_date", "offset", "unit")


@query(
    "ready_latest",
    f"""WITH i AS (SELECT DISTINCT dataset, strptime(partition_value, '%Y%m%d')::DATE AS day FROM ({fx.INVENTORY_DUCK})),
        r AS ({fx.REQUESTS_DUCK})
        SELECT r.job, r.dataset, r.nominal_date, strftime(i.day, '%Y%m%d') AS partition_value
        FROM r ASOF LEFT JOIN i ON r.dataset = i.dataset AND r.nominal_date >= i.day""",
)
def ready_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = readiness.latest_partition(fx.requests(spark, sf_dir), fx.inventory(spark, sf_dir))
    return latest.select("job", "dataset", "nominal_date", "partition_value")


@query(
    "ready_all",
    f"""SELECT job, nominal_date, bool_and(found) AS ready, count(*) AS inputs FROM (
          SELECT w.job, w.nominal_date, EXISTS (SELECT 1 FROM ({fx.INVENTORY_DUCK}) AS i WHERE i.dataset = w.dataset
            AND i.partition_value = w.partition_value AND i.flag = w.flag) AS found FROM ({fx.WANTED_DUCK}) AS w) AS f
        GROUP BY job, nominal_date""",
)
def ready_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readiness.ready(fx.requests(spark, sf_dir), fx.inventory(spark, sf_dir))


NOMINAL = date(1998, 6, 30)


@query(
    "scan_window",
    """SELECT * FROM (SELECT *, strftime(o_orderdate, '%Y%m') AS dt FROM orders) AS o
       WHERE dt BETWEEN '199706' AND '199805'""",
)
def scan_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly partitions from twelve months to one month before the nominal date."""
    orders = load(spark, InputSpec("parquet", fx.stored(fx.dated_orders(spark, sf_dir), "window")))
    bounds = readiness.window_bounds(F.lit(NOMINAL), {"low": (-12, "MONTH"), "high": (-1, "MONTH")}, "yyyyMM")
    return readiness.scan_window(orders, bounds["low"], bounds["high"])


@query(
    "scan_window_days",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS dt FROM orders
       WHERE strftime(o_orderdate, '%Y-%m-%d') BETWEEN '1998-05-05' AND '1998-06-09'""",
)
def scan_window_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days from eight to three weeks before the nominal date."""
    bounds = readiness.window_bounds(F.lit(NOMINAL), {"low": (-56, "DAY"), "high": (-21, "DAY")}, "yyyy-MM-dd")
    dated = fx.dated_orders(spark, sf_dir, "yyyy-MM-dd").select("o_orderkey", "dt")
    return readiness.scan_window(dated, bounds["low"], bounds["high"])


SCHEDULES = ("daily", "monthly", "TUE-SAT", "WED-SAT", "MON-FRI", "MON-SAT")
FIRST_DAY, LAST_DAY = date(1995, 1, 1), date(2001, 12, 31)


@query(
    "cal_nominal",
    f"""WITH days AS (SELECT CAST(unnest(generate_series(DATE '{FIRST_DAY}', DATE '{LAST_DAY}', INTERVAL 1 DAY)) AS DATE) AS d),
        n AS (SELECT 'daily' AS rule, d FROM days UNION ALL SELECT 'monthly', d FROM days WHERE day(d) = 1
          UNION ALL SELECT 'TUE-SAT', d FROM days WHERE dayofweek(d) BETWEEN 2 AND 6
          UNION ALL SELECT 'WED-SAT', d FROM days WHERE dayofweek(d) BETWEEN 3 AND 6
          UNION ALL SELECT 'MON-FRI', d FROM days WHERE dayofweek(d) BETWEEN 1 AND 5
          UNION ALL SELECT 'MON-SAT', d FROM days WHERE dayofweek(d) BETWEEN 1 AND 6),
        o AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS c FROM orders GROUP BY ALL)
        SELECT n.rule, n.d AS nominal_date, coalesce(o.c, 0) AS orders FROM n LEFT JOIN o ON n.d = o.d""",
)
def cal_nominal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders placed on each nominal date of each schedule."""
    placed = fx.table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("nominal_date")).count()
    dates = None
    for rule in SCHEDULES:
        part = readiness.nominal_dates(spark, FIRST_DAY, LAST_DAY, rule).withColumn("rule", F.lit(rule))
        dates = part if dates is None else dates.unionByName(part)
    return dates.join(placed, "nominal_date", "left").select(
        "rule", "nominal_date", F.coalesce("count", F.lit(0)).alias("orders")
    )
