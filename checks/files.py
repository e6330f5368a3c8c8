"""Sources, sinks, conversions and catalog partitions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from lethe.scratch import scratch_database, scratch_path
from lethe.sinks import add_partition, convert, drop_partitions, save
from lethe.sinks.catalog import drop_partition
from lethe.sources import clean_config_csv, load, load_columns, load_config
from lethe.specs import InputSpec, OutputSpec

QUERIES, ORACLES = {}, {}


def query(name: str, oracle: str):
    def register(function):
        QUERIES[name], ORACLES[name] = function, oracle
        return function

    return register


ORDERS_BY_MONTH = "SELECT *, strftime(o_orderdate, '%Y%m') AS dt FROM orders"


# --- Sources -------------------------------------------------------------------------


@query("src_csv", fx.PLAIN_ORDERS_DUCK)
def src_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    fx.plain_orders(spark, sf_dir).write.option("header", True).option("sep", ";").csv(path)
    return load(spark, InputSpec("csv", path, delimiter=";", schema=fx.PLAIN_ORDERS_SCHEMA))


@query("src_csv_inferred", fx.PLAIN_ORDERS_DUCK)
def src_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    fx.plain_orders(spark, sf_dir).write.option("header", True).csv(path)
    # Small keys are inferred as int.
    keys = {c: F.col(c).cast("bigint") for c in ("o_orderkey", "o_custkey")}
    return load(spark, InputSpec("csv", path)).withColumns(keys)


@query(
    "src_json",
    """SELECT o_orderkey, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS placed FROM orders""",
)
def src_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json")
    orders = fx.table(spark, sf_dir, "orders")
    orders.select(
        "o_orderkey", "o_orderpriority", F.date_format("o_orderdate", "yyyy/MM/dd HH:mm:ss '+0000'").alias("placed")
    ).write.json(path)
    spec = InputSpec("json", path, schema="o_orderkey bigint, o_orderpriority string, placed timestamp")
    placed = F.date_format(F.convert_timezone(None, F.lit("UTC"), F.col("placed").cast("timestamp_ntz")), "yyyy-MM-dd HH:mm:ss")
    return load(spark, spec).withColumn("placed", placed)


def _self_describing(fmt: str):
    def function(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = fx.stored(fx.table(spark, sf_dir, "orders"), fmt, fmt, None)
        return load(spark, InputSpec(fmt, path))

    return function


for _fmt in ("orc", "parquet"):
    QUERIES[f"src_{_fmt}"], ORACLES[f"src_{_fmt}"] = _self_describing(_fmt), "SELECT * FROM orders"


@query("src_xml", fx.PLAIN_ORDERS_DUCK)
def src_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "xml")
    fx.plain_orders(spark, sf_dir).write.format("xml").option("rootTag", "ROWS").option("rowTag", "ROW").save(path)
    return load(spark, InputSpec("xml", path, schema=fx.PLAIN_ORDERS_SCHEMA))


@query(
    "src_text",
    """SELECT CAST(o_orderkey AS VARCHAR) AS col1, o_orderstatus AS col2, o_orderpriority AS col3,
         CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE strftime(o_orderdate, '%Y%m%d') END AS col4 FROM orders""",
)
def src_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "text")
    fx.table(spark, sf_dir, "orders").select(
        F.concat_ws(
            "|", F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority",
            F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.date_format("o_orderdate", "yyyyMMdd")),
        )
    ).write.text(path)
    return load(spark, InputSpec("text", path, delimiter="|"))


@query(
    "src_positional",
    """SELECT o_orderkey, o_orderpriority,
         CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) END AS o_orderdate FROM orders""",
)
def src_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed-width lines with a header line in every file and some short lines."""
    path = scratch_path(spark, "positional")
    orders = fx.table(spark, sf_dir, "orders")
    key, priority = F.rpad(F.col("o_orderkey").cast("string"), 12, " "), F.rpad("o_orderpriority", 16, " ")
    header = f"{'o_orderkey':<12}{'o_orderpriority':<16}o_orderdate"
    day = F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    plain = {"header": True, "quote": "", "sep": "\u0001", "ignoreTrailingWhiteSpace": False}
    orders.select(F.concat(key, priority, day).alias(header)).write.options(**plain).csv(path)
    schema = "o_orderkey bigint, o_orderpriority string, o_orderdate date"
    return load(spark, InputSpec("positional", path, widths=(12, 16, 11), schema=schema))


def month_table(spark: SparkSession, sf_dir: str, label: str, managed: bool = True) -> str:
    """Orders as a catalog table with monthly partitions."""
    name = f"{scratch_database(spark, label)}.orders_by_month"
    writer = fx.dated_orders(spark, sf_dir).hint("rebalance", "dt").write.partitionBy("dt").format("parquet")
    if not managed:
        writer = writer.option("path", scratch_path(spark, label))
    writer.saveAsTable(name)
    return name


@query("src_table", ORDERS_BY_MONTH)
def src_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, InputSpec("table", table=month_table(spark, sf_dir, "src")))


@query("scan_partitions", f"SELECT * FROM ({ORDERS_BY_MONTH}) AS o WHERE dt IN ('199602', '199711', '200007')")
def scan_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = InputSpec(
        "table", table=month_table(spark, sf_dir, "scan"), partition_values=("199602", "199711", "200007")
    )
    return load(spark, spec)


def scan_typed(dtype: str, value: str, wanted: tuple[str, ...]):
    """Orders of three months from a table whose partition column is typed."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        name = f"{scratch_database(spark, 'typed')}.orders_by_month"
        orders = fx.table(spark, sf_dir, "orders").withColumn("dt", F.expr(value).cast(dtype))
        orders.hint("rebalance", "dt").write.partitionBy("dt").format("parquet").saveAsTable(name)
        return load(spark, InputSpec("table", table=name, partition_values=wanted))

    return run


query("scan_partitions_date", """SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS dt FROM orders
  WHERE strftime(o_orderdate, '%Y%m') IN ('199602', '199711', '200007')""")(
    scan_typed("date", "trunc(o_orderdate, 'MM')", ("19960201", "1997-11-01", "20000701")))
query("scan_partitions_int", """SELECT *, CAST(strftime(o_orderdate, '%Y%m') AS INT) AS dt FROM orders
  WHERE strftime(o_orderdate, '%Y%m') IN ('199602', '199711', '200007')""")(
    scan_typed("int", "date_format(o_orderdate, 'yyyyMM')", ("199602", "199711", "200007")))


@query(
    "scan_columns_min",
    f"""SELECT o_orderkey, o_totalprice FROM ({ORDERS_BY_MONTH}) AS o
        WHERE dt IN ('199602', '199711', '200007') AND o_totalprice >= 1000.5""",
)
def scan_columns_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = InputSpec(
        "table", table=month_table(spark, sf_dir, "scan"), partition_values=("199602", "199711", "200007")
    )
    return load_columns(spark, spec, ["o_orderkey", "o_totalprice"], "1000.5", "o_totalprice")


@query(
    "config_load",
    f"""SELECT base, table_name, column_name, partition_value_format,
          CAST(trim(conserv_duration) AS INT) AS conserv_duration, CAST(purge_duration AS INT) AS purge_duration,
          purge_boolean = 'true' AS purge_boolean, anonymisation_methode
        FROM ({fx.CONFIG_DUCK}) AS c WHERE dt = '199703'""",
)
def config_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fx.stored(fx.config(spark, sf_dir), "config")
    config = load_config(spark, InputSpec("parquet", path), date(1997, 3, 10))
    return config.select(
        "base", "table_name", "column_name", "partition_value_format", "conserv_duration", "purge_duration",
        "purge_boolean", "anonymisation_methode",
    )


@query(
    "config_clean",
    f"""SELECT base, table_name, column_name, CAST(purge_duration AS INT) AS purge_duration
        FROM ({fx.CONFIG_DUCK}) AS c""",
)
def config_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An exported sheet with banner and empty lines between the rows."""
    path = scratch_path(spark, "sheet")
    line = F.concat_ws(",", "base", "table_name", "column_name", "purge_duration")
    noise = F.array(
        line, F.lit(""), F.lit("x,Données à compléter par le Métier,y"), F.lit("Commentaire,données à anonymiser")
    )
    fx.config(spark, sf_dir).select(F.explode(noise).alias("value")).write.text(path)
    schema = "base string, table_name string, column_name string, purge_duration int"
    return clean_config_csv(spark.read.text(path), schema)


# --- Sinks -----------------------------------------------------------------------------


def _roundtrip(fmt: str, schema: str | None = None, **options):
    def function(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, fmt)
        orders = fx.plain_orders(spark, sf_dir)
        save(orders, OutputSpec(fmt, path, partition_column="o_orderstatus", rebalance=True, **options))
        source = {"csvWithoutHeader": "csv"}.get(fmt, fmt)
        return load(
            spark,
            InputSpec(source, path, schema=schema, header=fmt == "csv", delimiter=options.get("delimiter", "")),
        )

    return function


for _key, _fmt, _schema, _options in (
    ("sink_csv_roundtrip", "csv", fx.PLAIN_ORDERS_SCHEMA, {"delimiter": "\t"}),
    ("sink_json_roundtrip", "json", fx.PLAIN_ORDERS_SCHEMA, {}),
    ("sink_orc_roundtrip", "orc", None, {}),
    ("sink_parquet_roundtrip", "parquet", None, {}),
):
    QUERIES[_key], ORACLES[_key] = _roundtrip(_fmt, _schema, **_options), fx.PLAIN_ORDERS_DUCK


@query("sink_csv_no_header", fx.PLAIN_ORDERS_DUCK)
def sink_csv_no_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    save(fx.plain_orders(spark, sf_dir), OutputSpec("csvWithoutHeader", path))
    return load(spark, InputSpec("csv", path, header=False, schema=fx.PLAIN_ORDERS_SCHEMA))


@query("sink_table_roundtrip", ORDERS_BY_MONTH)
def sink_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{scratch_database(spark, 'sink')}.orders_orc"
    spec = OutputSpec("table", scratch_path(spark, "table"), name, "dt", rebalance=True)
    save(fx.dated_orders(spark, sf_dir), spec)
    return load(spark, InputSpec("table", table=name))


@query("sink_rerun_idempotent", ORDERS_BY_MONTH)
def sink_rerun_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saving the same partitions twice leaves each row once."""
    spec = OutputSpec("parquet", scratch_path(spark, "rerun"), None, "dt", mode="overwrite_partitions", rebalance=True)
    orders = fx.dated_orders(spark, sf_dir)
    save(orders, spec)
    save(orders, spec)
    return load(spark, InputSpec("parquet", spec.path))


@query("convert_csv_to_orc", fx.PLAIN_ORDERS_DUCK)
def convert_csv_to_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = scratch_path(spark, "csv"), scratch_path(spark, "orc")
    fx.plain_orders(spark, sf_dir).write.option("header", True).csv(source)
    convert(spark, InputSpec("csv", source, schema=fx.PLAIN_ORDERS_SCHEMA), OutputSpec("orc", target))
    return load(spark, InputSpec("orc", target))


@query("partition_add", f"SELECT * FROM ({ORDERS_BY_MONTH}) AS o UNION ALL "
       "SELECT *, '999912' AS dt FROM orders WHERE o_orderstatus = 'F'")  # fmt: skip
def partition_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files outside the table become one of its partitions; a second call changes nothing."""
    name = month_table(spark, sf_dir, "add")
    location = fx.stored(fx.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'"), "add", "parquet", None)
    add_partition(spark, name, "999912", location)
    add_partition(spark, name, "999912", location)
    return load(spark, InputSpec("table", table=name))


@query("partition_drop", f"SELECT * FROM ({ORDERS_BY_MONTH}) AS o WHERE dt NOT IN ('199501', '199702', '199703')")
def partition_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = month_table(spark, sf_dir, "drop")
    drop_partition(spark, name, "dt", "199501")
    drop_partition(spark, name, "dt", "199501")
    drop_partitions(spark, name, "dt", ["199702", "199703", "190001"])
    return load(spark, InputSpec("table", table=name))
