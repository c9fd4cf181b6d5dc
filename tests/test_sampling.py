"""Samples by hash: the same rows, compared as text and with the hashed text begun before a join."""

import pytest
from pyspark.sql import functions as F

from outreach.operators import sampling
from outreach.workload import queries
from outreach.workload.fixtures import Domain


def pairs(spark):
    rows = [(k if k % 4 else None, u if u % 5 else None, c if c % 3 else None) for k in range(8) for u in range(20) for c in range(15)]
    return spark.createDataFrame(rows, "test_keys int, user_id long, campaign_id int")


@pytest.mark.parametrize("fraction", [0.0, 0.01, 0.25, 0.5, 0.999, 1.0])
def test_the_sample_is_that_of_the_unit_hash(spark, fraction):
    rows, keys = pairs(spark), ["user_id", "campaign_id"]
    want = sorted(map(str, rows.where(sampling.unit_hash(["test_keys", *keys]) < fraction).collect()))
    assert sorted(map(str, sampling.stratified_sample(rows, "test_keys", keys, fraction).collect())) == want
    told = sampling.with_head(rows, ["test_keys", "user_id"], "_head")
    begun = sampling.stratified_sample(told, "test_keys", ["campaign_id"], fraction, head="_head").drop("_head")
    assert sorted(map(str, begun.collect())) == want


def test_pairs_are_sampled_without_turning_digits_into_numbers(spark, sf_dir):
    """Every pair had its digest turned into a number, and three numbers into text."""
    d = Domain(spark, sf_dir)
    plan = queries.REGISTRY["stratified_sample"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    sampled = [line for line in plan.splitlines() if "md5" in line]
    assert sampled and "conv(" not in plan and not any("cast(user_id" in line for line in sampled)
    assert d.traveler.count() > 0
