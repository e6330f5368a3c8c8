"""What the plans look like: pruning, shuffles, Python, cross joins."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lethe.functions import prf
from lethe.operators.events import mask_where
from lethe.operators.masking import METHODS, MaskContext, apply_rules
from lethe.operators.readiness import latest_partition, scan_window
from lethe.scratch import checkpointed
from lethe.session import KEY_SETTING, RECOMMENDED, masking_key, recommended, setting
from lethe.sources import load, load_columns
from lethe.sources.readers import spread
from lethe.specs import InputSpec, Rule

CONTEXT = MaskContext(key="k", row_key=("id",))
ENCRYPTION = [m for m in METHODS if "FormatPreserving" in m]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    target = str(tmp_path_factory.mktemp("plans") / "t")
    rows = spark.range(100).select("id", F.col("id").cast("string").alias("v"), F.lit("w").alias("w"),
                                   (F.col("id") % 4 + 199901).cast("string").alias("dt"))
    rows.write.partitionBy("dt").parquet(target)
    return target


def test_partition_and_column_pruning(spark, data):
    text = plan(load_columns(spark, InputSpec("parquet", data, partition_values=("199901", "199903")), ["v"], 5, "id"))
    assert re.search(r"PartitionFilters: \[[^\]]*dt#\d+ IN \(199901,199903\)", text)
    assert "GreaterThanOrEqual(id,5)" in text and re.search(r"ReadSchema: struct<id:bigint,v:string>", text)
    window = plan(scan_window(load(spark, InputSpec("parquet", data)), "199901", "199902"))
    assert re.search(r"PartitionFilters: \[[^\]]*dt#\d+ >= 199901", window)


@pytest.mark.parametrize("method", [m for m in METHODS if m not in ENCRYPTION])
def test_row_masks_neither_shuffle_nor_use_python(spark, data, method):
    text = plan(apply_rules(load(spark, InputSpec("parquet", data)), [Rule("v", method)], CONTEXT))
    assert "Exchange" not in text and "Python" not in text and "Arrow" not in text
    assert text.count("Project") == 1


def test_encryption_of_texts_neither_shuffles_nor_uses_python(spark, data):
    for method in ENCRYPTION:
        text = plan(apply_rules(load(spark, InputSpec("parquet", data)), [Rule("v", method)], CONTEXT))
        assert "Exchange" not in text and "Python" not in text and "Arrow" not in text


def test_a_join_on_ciphers_encrypts_each_value_once(spark, data):
    rows = apply_rules(load(spark, InputSpec("parquet", data)), [Rule("v", "consistentStringFormatPreserving")], CONTEXT)
    other = rows.select(F.col("v").alias("other"))
    text = rows.join(other, F.col("v") == F.col("other"))._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in text.split("\n") if "Filter" in line]
    assert filters and not any("sha2" in line for line in filters)


def test_spread_rows_lie_in_many_tasks(spark, data):
    rows = spread(load(spark, InputSpec("parquet", data)).coalesce(1))
    assert rows.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
    assert rows.count() == 100


def test_many_rules_are_one_projection(spark, data):
    rules = [Rule("v", "id"), Rule("w", "XReplace"), Rule("w", "hashWithSha1")]
    text = plan(apply_rules(load(spark, InputSpec("parquet", data)), rules, CONTEXT))
    assert text.count("Project") == 1 and "Exchange" not in text


def test_permutation_shuffles_the_rows_that_take_part_once(spark, data):
    text = plan(apply_rules(load(spark, InputSpec("parquet", data)), [Rule("v", "keepDistribution")], CONTEXT))
    # The rows, the first value of each bucket, the bucket table, and the links back to the buckets.
    assert text.count("Exchange hashpartitioning(__bucket") == 3 and text.count("Exchange") == 4
    # The other rows come behind the last exchange, by a scan of their own.
    assert text.count("Scan parquet") == 3 and "Union" in text


def test_rows_of_a_permutation_are_read_and_shuffled_once(spark, data):
    """The values between buckets come from the exchange of the rows, which adaptive execution makes once."""
    moved = apply_rules(load(spark, InputSpec("parquet", data)), [Rule("v", "keepDistribution")], CONTEXT)
    moved.collect()
    final = moved._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("ReusedExchange") == 1 and final.count("REPARTITION_BY_COL") == 2, final
    # One scan for the rows that take part, one for the others, told apart by the filter that is pushed to the files.
    assert final.count("Scan parquet") == 2, final


def test_few_keys_leave_the_rows_where_they_are(spark, data):
    rows = load(spark, InputSpec("parquet", data))
    keys = F.broadcast(checkpointed(rows.select("id").where("id < 5").distinct()))
    text = plan(mask_where(rows, keys, "id", [Rule("v", "id")], CONTEXT))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_printed_plans_hide_derived_keys(spark, data):
    masked = apply_rules(load(spark, InputSpec("parquet", data)), [Rule("v", "id")], CONTEXT)
    derived = prf.column_key("k", "v")
    assert derived in masked._jdf.queryExecution().toString()
    with setting(spark, "spark.sql.redaction.string.regex", RECOMMENDED["spark.sql.redaction.string.regex"]):
        assert derived not in masked._jdf.queryExecution().toString()


def test_session_helpers(spark):
    builder = recommended(type(spark).builder.appName("x"))
    assert builder._options["spark.sql.adaptive.skewJoin.enabled"] == "true"
    with pytest.raises(ValueError, match="secret"):
        masking_key(spark)
    with setting(spark, KEY_SETTING, "hidden"):
        assert masking_key(spark) == "hidden"
    assert spark.conf.get(KEY_SETTING, None) is None


def test_no_cross_joins(spark, data):
    rows = load(spark, InputSpec("parquet", data))
    masked = plan(mask_where(rows, rows.select("id").limit(5), "id", [Rule("v", "id")], CONTEXT))
    have = rows.selectExpr("v as dataset", "'20240101' as partition_value", "'f' as flag")
    want = rows.selectExpr("v as job", "v as dataset", "date'2024-01-02' as nominal_date", "1 as offset", "'DAY' as unit")
    for text in (masked, plan(latest_partition(want, have))):
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_the_library_does_not_pull_data_apart(spark):
    library = Path(__file__).parents[1] / "lethe"
    source = "\n".join(p.read_text() for p in library.rglob("*.py") if "llm" not in p.relative_to(library).parts)
    for word in ("localCheckpoint", "crossJoin", "toPandas", ".rdd", "monotonically_increasing_id", "rand("):
        assert word not in source


def test_row_masks_work_on_a_stream(spark, data, path):
    rules = [Rule("v", "id"), Rule("w", "XReplace")]
    batch = load(spark, InputSpec("parquet", data))
    stream = apply_rules(spark.readStream.schema(batch.schema).parquet(data), rules, CONTEXT)
    query = (
        stream.writeStream.format("parquet").option("path", path("out")).option("checkpointLocation", path("state"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    expected = apply_rules(batch, rules, CONTEXT)
    got = spark.read.schema(batch.schema).parquet(path("out"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_a_hot_person_is_split_over_tasks(spark):
    """Half of all rows belong to one person; the shuffled join does not leave them to one task."""
    hot = F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id"))
    rows = spark.range(0, 400_000, 1, 8).select(hot.alias("person"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    keys = spark.range(0, 100_000).select(F.col("id").alias("person"))
    with (
        setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"),
        setting(spark, "spark.sql.adaptive.autoBroadcastJoinThreshold", "-1"),
        setting(spark, "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1MB"),
        setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB"),
        setting(spark, "spark.sql.shuffle.partitions", "16"),
    ):
        masked = mask_where(rows, keys, "person", [Rule("v", "XReplace")], CONTEXT)
        counts = masked.groupBy(F.col("v").startswith("X").alias("masked")).count()
        got = {r.masked: r["count"] for r in counts.collect()}
        text = plan(counts)
    assert got == {True: 200_000 + 50_000, False: 150_000}
    assert "SortMergeJoin(skew=true)" in text
