"""Proof of masking before a purge."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lethe.operators.masking import MaskContext, apply_rules
from lethe.operators.proof import digests, unchanged_shares, unproven
from lethe.specs import Rule

CONTEXT = MaskContext("k", ("id",))
ROWS = [(i, f"name {i}", "ab"[i % 2], None if i % 7 == 0 else i * 1.5, "same", "12"[i % 3 == 0]) for i in range(300)]


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(ROWS, "id int, v string, few string, x double, one string, dt string").cache()


RULES = {
    "repeatable": [Rule("v", "hashWithSha1"), Rule("x", "randomDoubles")],
    "drawn salt": [Rule("v", "hashWithSha1", {"salt": "random"})],
    "permuted": [Rule("v", "keepDistribution"), Rule("few", "keepDistribution")],
    "mixed": [Rule("v", "keepDistribution"), Rule("x", "blank", {"respect_type": "true"})],
    "one value": [Rule("one", "keepDistribution")],
    "composed": [Rule("v", "hashWithSha1", {"salt": "random"}), Rule("v", "XReplace")],
}


@pytest.mark.parametrize("name", RULES)
def test_masked_copies_are_proven(spark, data, name):
    masked = apply_rules(data, RULES[name], CONTEXT)
    assert unproven(data, masked.cache(), "dt", RULES[name], CONTEXT) == {}


@pytest.mark.parametrize("name", [n for n in RULES if n != "one value"])
def test_clear_copies_are_refused(spark, data, name):
    assert set(unproven(data, data, "dt", RULES[name], CONTEXT)) == {"1", "2"}
    # One partition in clear, the other masked.
    masked = apply_rules(data, RULES[name], CONTEXT).where("dt = '1'").unionByName(data.where("dt = '2'")).cache()
    assert set(unproven(data, masked, "dt", RULES[name], CONTEXT)) == {"2"}


def test_one_column_in_clear_is_refused(spark, data):
    rules = RULES["repeatable"]
    half = apply_rules(data, rules[:1], CONTEXT)
    assert unproven(data, half, "dt", rules, CONTEXT) == dict.fromkeys("12", "cells of x are unchanged")


def test_lost_and_changed_rows_are_refused(spark, data):
    rules = RULES["repeatable"]
    masked = apply_rules(data, rules, CONTEXT).cache()
    reason = unproven(data, masked.where("id <> 4"), "dt", rules, CONTEXT)
    assert list(reason) == ["1" if ROWS[4][5] == "1" else "2"] and "as many rows" in reason.popitem()[1]
    # As many rows, but one twice and another not at all.
    twice = masked.where("id <> 4").unionByName(masked.where("id = 7")).cache()
    assert "without a mask differ" in unproven(data, twice, "dt", rules, CONTEXT).popitem()[1]
    assert unproven(data, masked.where("dt = '1'"), "dt", rules, CONTEXT).keys() == {"2"}


def test_former_keys_and_changed_rules(spark, data):
    rules = [Rule("v", "chaine"), Rule("few", "randomAlphabeticChars")]
    masked = apply_rules(data, rules, MaskContext("old", ("id",))).cache()
    assert unproven(data, masked, "dt", rules, CONTEXT, ("older", "old")) == {}
    # Under no known key the cells decide; they are not clear.
    assert unproven(data, masked, "dt", rules, CONTEXT) == {}
    assert unproven(data, masked, "dt", [Rule("v", "null"), rules[1]], CONTEXT) == {}


def test_rows_that_cannot_be_told_apart(spark):
    data = spark.createDataFrame([("a", "x", "1"), ("b", "x", "1")], "v string, w string, dt string")
    assert "told from" in unproven(data, data, "dt", [Rule("v", "hashWithSha1", {"salt": "random"})], MaskContext("k"))["1"]


def test_digests_and_shares(spark, data):
    shuffled = data.repartition(7).orderBy(F.desc("id"))
    assert digests(data, "dt", d=["id", "v", "x"]) == digests(shuffled, "dt", d=["id", "v", "x"])
    other = data.withColumn("x", F.when(F.col("id") == 9, None).otherwise(F.col("x")))
    assert digests(data, "dt", d=["id", "x"]) != digests(other, "dt", d=["id", "x"])
    shares = unchanged_shares(data, data.withColumn("v", F.when(F.col("id") < 150, F.col("v"))), "dt", ["id"], ["v", "few"])
    assert shares["1"]["v"][0] == pytest.approx(0.5, abs=0.02) and shares["1"]["few"][0] == 1.0
    assert shares["1"]["few"][1] == pytest.approx(0.5, abs=0.01)
