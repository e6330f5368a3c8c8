"""Time the headline jobs; prints one JSON line.

Inputs that a job expects to exist (dated tables, event snapshots) are written
before its clock starts. Masks are timed into the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks import fixtures as fx
from checks import jobs as job_checks
from checks import masks
from checks.files import month_table
from lethe.operators import events, readiness
from lethe.operators.masking import apply_rules
from lethe.plans import jobs, plan_partitions
from lethe.scratch import scratch_path
from lethe.sinks import save
from lethe.sources import load, typed_config
from lethe.specs import InputSpec, OutputSpec, Rule

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def cases(spark: SparkSession) -> dict[str, Callable[[], None]]:
    """Name -> action; whatever is built here is not timed."""
    # Each given table is one file of one row group, which one task reads; the
    # repartition setting of a load spreads the rows before the masks.
    orders, lines, documents = (
        load(spark, InputSpec("parquet", f"{SF_DIR}/{name}.parquet", repartition=int(CPUS)))
        for name in ("orders", "lineitem", "documents")
    )
    documents = documents.select("doc_id", "text")
    pii, config = fx.pii(spark, SF_DIR), typed_config(fx.config(spark, SF_DIR))
    keys, row = job_checks.keys(spark, SF_DIR), fx.context("o_orderkey")
    line_row = fx.context("l_orderkey", "l_linenumber")

    data = InputSpec("parquet", fx.stored(job_checks.order_data(spark, SF_DIR), "orders"))
    event_plan = job_checks.event_plan(spark, SF_DIR)
    purge_plan = job_checks.execution_plan(InputSpec("table", table=month_table(spark, SF_DIR, "purge")), "")
    dated = fx.dated_orders(spark, SF_DIR)

    def mask(df: DataFrame, rule: Rule, context) -> Callable[[], None]:
        return lambda: drain(apply_rules(df, [rule], context))

    return {
        "job_mask_execution": lambda: jobs.retain_mask(
            spark, job_checks.execution_plan(data, scratch_path(spark, "masked")), job_checks.RUN),
        "job_mask_event": lambda: jobs.retain_mask_by_event(spark, event_plan, job_checks.EVENT_RUN),
        "job_purge": lambda: jobs.purge(spark, purge_plan, job_checks.RUN),
        "mask_table_10_rules": lambda: drain(apply_rules(pii, masks.TABLE_RULES, fx.context("c_custkey"))),
        "mask_id_orders": mask(orders, Rule("o_orderpriority", "id"), row),
        "mask_chaine_documents": mask(documents, Rule("text", "chaine"), fx.context()),
        "mask_numeric_lines": mask(lines, Rule("l_extendedprice", "numeric"), line_row),
        "mask_ints_lines": mask(lines, Rule("l_partkey", "randomLongs"), line_row),
        "mask_alpha_lines": mask(lines, Rule("l_returnflag", "randomAlphabeticChars", {"length": "12"}), line_row),
        "mask_sha256_documents": mask(documents, Rule("text", "hashWithSha256"), fx.context()),
        "mask_x_documents": mask(documents, Rule("text", "XReplace"), fx.context()),
        "mask_permute_lines": mask(lines, Rule("l_extendedprice", "keepDistribution"), line_row),
        "fpe_num_orders": mask(orders, Rule("o_orderkey", "consistentNumericFormatPreserving"), row),
        "mask_event_rows": lambda: drain(
            events.mask_where(orders, keys, "o_custkey", job_checks.EVENT_RULES, row)),
        "plan_mask_partitions": lambda: drain(
            plan_partitions(config, job_checks.RUN, "conserv_duration")),
        "ready_latest": lambda: drain(
            readiness.latest_partition(fx.requests(spark, SF_DIR), fx.inventory(spark, SF_DIR))),
        "sink_overwrite_partitions": lambda: save(dated, OutputSpec(
            "parquet", scratch_path(spark, "sink"), None, "dt", mode="overwrite_partitions", rebalance=True)),
    }


def main() -> None:
    spark = session()
    timings = {}
    todo = cases(spark)
    for name, action in todo.items():
        start = time.perf_counter()
        action()
        timings[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total seconds of the headline jobs",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
