"""Inputs of the check queries, derived from the given tables.

Texts that both engines understand are written once; they only build inputs.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lethe.operators.masking import MaskContext
from lethe.scratch import scratch_path

CHECK_KEY = "check-key"
RUN_DATE = date(2000, 1, 15)
STOCK_START = date(1995, 1, 1)
EVENT_LIMIT = "199606"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def context(*row_key: str) -> MaskContext:
    return MaskContext(key=CHECK_KEY, row_key=row_key)


def from_sql(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    """Run a statement over given tables, passed by name."""
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})


# Personal data of each customer: nulls, null words, accents, separators, short and long texts.
PII = """
SELECT c_custkey,
  CASE c_custkey % 50 WHEN 7 THEN 'null' WHEN 8 THEN 'NULL' WHEN 9 THEN 'Null'
    WHEN 10 THEN '' WHEN 11 THEN NULL WHEN 12 THEN 'é' WHEN 13 THEN repeat('Zürich-Straße 12/a ', 8)
    ELSE 'Cus-' || CAST(c_custkey AS STRING) || '/' || c_mktsegment || ' '
      || chr(CAST(65 + c_custkey % 26 AS INT)) END AS label,
  CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 17 = 1 THEN 'none'
    ELSE 'GB29NWBK' || lpad(CAST(c_custkey * 7919 AS STRING), 14, '0') END AS iban,
  CASE WHEN c_custkey % 17 = 2 THEN NULL WHEN c_custkey % 17 = 3 THEN '123'
    WHEN c_custkey % 2 = 0 THEN '4970 1000 ' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0') || ' 5678'
    ELSE '4970-1000-2222-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0') END AS card,
  CASE WHEN c_custkey % 17 = 4 THEN NULL WHEN c_custkey % 17 = 5 THEN 'no address'
    ELSE lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.example.org' END AS email,
  CASE WHEN c_custkey % 17 = 6 THEN NULL
    WHEN c_custkey % 3 = 0 THEN '+33 6 12 34 ' || lpad(CAST(c_custkey % 100 AS STRING), 2, '0') || ' 78'
    WHEN c_custkey % 3 = 1 THEN '06' || lpad(CAST(c_custkey AS STRING), 8, '0')
    ELSE '01-23-45-67-' || lpad(CAST(c_custkey % 100 AS STRING), 2, '0') END AS tel,
  CASE WHEN c_custkey % 17 = 7 THEN NULL ELSE c_name END AS name,
  CASE WHEN c_custkey % 17 = 8 THEN NULL ELSE CAST(c_custkey * 37 - 1000 AS INT) END AS amount_int,
  CASE WHEN c_custkey % 17 = 9 THEN NULL ELSE c_custkey * 1000003 END AS amount_long,
  CASE WHEN c_custkey % 17 = 10 THEN NULL ELSE c_acctbal END AS amount_double,
  CASE WHEN c_custkey % 17 = 11 THEN NULL
    ELSE DATE '1950-01-01' + CAST(c_custkey * 13 % 20000 AS INT) END AS birth,
  CASE WHEN c_custkey % 17 = 12 THEN NULL ELSE c_custkey % 2 = 0 END AS optin
FROM {customer}
"""

# A configuration table: eight masked columns for each of many tables.
CONFIG = """
SELECT 'b' || CAST(t % 5 AS STRING) AS base,
  't' || CAST(t AS STRING) AS table_name,
  'col' || CAST(c_custkey % 8 AS STRING) AS column_name,
  CASE t % 4 WHEN 0 THEN 'yyyyMMdd' WHEN 1 THEN 'yyyyMM' WHEN 2 THEN 'yyyy-MM-dd' ELSE 'yyyy-MM' END
    AS partition_value_format,
  ' ' || CAST(t % 36 + 1 AS STRING) || ' ' AS conserv_duration,
  CAST(t % 36 + 13 AS STRING) AS purge_duration,
  CASE WHEN t % 2 = 0 THEN 'true' ELSE 'false' END AS purge_boolean,
  CASE c_custkey % 5 WHEN 0 THEN 'randomAlphabeticChars' WHEN 1 THEN 'randomDoubles' WHEN 2 THEN 'blank'
    WHEN 3 THEN 'email' ELSE 'id' END AS anonymisation_methode,
  CASE c_custkey % 5 WHEN 0 THEN 'length.preserve_spaces' WHEN 1 THEN 'double_bounds'
    WHEN 2 THEN 'respect_type.data_type' WHEN 3 THEN 'keep_domaine' ELSE NULL END AS anonymisation_methode_options,
  CASE c_custkey % 5 WHEN 0 THEN '8.true' WHEN 1 THEN '[0.5;1.5]' WHEN 2 THEN 'true' WHEN 3 THEN 'true.extra'
    ELSE NULL END AS anonymisation_methode_options_values,
  CASE WHEN t % 3 = 0 THEN 'depart' ELSE 'execution' END AS declencheur,
  '1997' || lpad(CAST(t % 12 + 1 AS STRING), 2, '0') AS dt
FROM (SELECT c_custkey, CAST(floor(c_custkey / 8) AS INT) AS t FROM {customer}) AS c
"""

# First order date of each customer: the event that starts the clock.
PERSON_EVENTS_SPARK = """
SELECT o_custkey AS custkey, date_format(min(o_orderdate), 'yyyyMMdd') AS event_date
FROM {orders} GROUP BY o_custkey
"""
PERSON_EVENTS_DUCK = """
SELECT o_custkey AS custkey, strftime(min(o_orderdate), '%Y%m%d') AS event_date
FROM orders GROUP BY o_custkey
"""
EXPIRED_DUCK = f"""
SELECT custkey FROM ({PERSON_EVENTS_DUCK}) AS e WHERE substr(event_date, 1, 6) < '{EVENT_LIMIT}'
"""


def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_sql(spark, sf_dir, PII, "customer")


PII_DUCK = PII.format(customer="customer")


def config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_sql(spark, sf_dir, CONFIG, "customer")


CONFIG_DUCK = CONFIG.format(customer="customer")


def person_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_sql(spark, sf_dir, PERSON_EVENTS_SPARK, "orders")


def dated_orders(spark: SparkSession, sf_dir: str, fmt: str = "yyyyMM") -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("dt", F.date_format("o_orderdate", fmt))


def plain_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a date instead of a zoneless timestamp, for text formats."""
    return table(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))


PLAIN_ORDERS_DUCK = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders
"""
PLAIN_ORDERS_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate date, o_orderpriority string"
)


def stored(df: DataFrame, label: str, fmt: str = "parquet", partition: str | None = "dt") -> str:
    """Write an input under the scratch folder and give its path."""
    path = scratch_path(df.sparkSession, label)
    if partition:
        df.hint("rebalance", partition).write.partitionBy(partition).format(fmt).save(path)
    else:
        df.write.format(fmt).save(path)
    return path


def run_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day on which an order was placed."""
    return table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("run_date")).distinct()


RUN_DATES_DUCK = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS run_date FROM orders"

INVENTORY_SPARK = """
SELECT 'D' || CAST(l_linenumber AS STRING) AS dataset, date_format(l_shipdate, 'yyyyMMdd') AS partition_value,
  CASE WHEN l_returnflag = 'R' THEN '_READY' ELSE '_SUCCESS' END AS flag
FROM {lineitem}
"""
INVENTORY_DUCK = """
SELECT 'D' || CAST(l_linenumber AS STRING) AS dataset, strftime(l_shipdate, '%Y%m%d') AS partition_value,
  CASE WHEN l_returnflag = 'R' THEN '_READY' ELSE '_SUCCESS' END AS flag
FROM lineitem
"""
REQUESTS = """
SELECT 'J' || CAST(o_orderkey AS STRING) AS job, 'D' || CAST((o_orderkey + i) % 7 + 1 AS STRING) AS dataset,
  CAST(o_orderdate AS DATE) AS nominal_date, CAST(-(o_orderkey % 4) AS INT) AS "offset",
  CASE WHEN o_orderkey % 5 = 0 THEN 'MONTH' ELSE 'DAY' END AS unit, '_SUCCESS' AS flag
FROM {orders}, (VALUES (0), (3)) AS inputs(i)
"""


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_sql(spark, sf_dir, INVENTORY_SPARK, "lineitem")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two inputs for every order taken as a job."""
    orders = table(spark, sf_dir, "orders").withColumn("i", F.explode(F.array(F.lit(0), F.lit(3))))
    return orders.selectExpr(
        "'J' || CAST(o_orderkey AS STRING) AS job",
        "'D' || CAST((o_orderkey + i) % 7 + 1 AS STRING) AS dataset",
        "CAST(o_orderdate AS DATE) AS nominal_date",
        "CAST(-(o_orderkey % 4) AS INT) AS offset",
        "CASE WHEN o_orderkey % 5 = 0 THEN 'MONTH' ELSE 'DAY' END AS unit",
        "'_SUCCESS' AS flag",
    )


REQUESTS_DUCK = REQUESTS.format(orders="orders")
WANTED_DUCK = f"""
SELECT *, strftime(CASE unit WHEN 'DAY' THEN nominal_date + "offset"
  ELSE CAST(nominal_date + to_months("offset") AS DATE) END, '%Y%m%d') AS partition_value
FROM ({REQUESTS_DUCK}) AS r
"""
