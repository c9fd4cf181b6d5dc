"""Joins that give far more pairs than rows: the same pairs, from lists of bounded length."""

import os

import pytest
from pyspark.sql import functions as F

from outreach.operators import allocation, skew
from outreach.params import POS

KEY = ["campaign_segment_type_id", *POS]


def people(spark, n=40):
    rows = [(f"u{i}", i, i % 3 if i % 7 else None, 1, 0, "en_us") for i in range(n)]
    return spark.createDataFrame(rows + rows[:5], "email string, user_id int, campaign_segment_type_id int, tpid int, eapid int, locale string")


def campaigns(spark):
    rows = [(c, c % 4 or None, c % 3 if c % 5 else None, 1, 0, "en_us") for c in range(60)]
    return spark.createDataFrame(rows + rows[7:12], "campaign_id int, priority int, campaign_segment_type_id int, tpid int, eapid int, locale string")


@pytest.mark.parametrize("sizes", [{}, {"block": 4}, {"block": 4, "pack": 3, "task_pairs": 20}, {"block": 4, "max_bytes": 10}])
def test_the_pairs_are_those_of_the_plain_join(spark, sizes):
    left, right = people(spark), campaigns(spark)
    met = skew.paired_join(left, right, KEY, **sizes)
    assert met.columns == [*left.columns, "campaign_id", "priority"]
    want = left.join(right, KEY).select(*met.columns)
    assert met.schema == want.schema
    assert sorted(map(str, met.collect())) == sorted(map(str, want.collect()))


def test_nobody_and_nothing_meet_nothing(spark):
    left, right = people(spark), campaigns(spark)
    assert skew.paired_join(left, right.where("false"), KEY).count() == 0
    assert skew.paired_join(left.where("false"), right, KEY, block=4).count() == 0


def test_no_row_holds_a_whole_key(spark):
    right = campaigns(spark)
    lists = skew._blocks(right, KEY, 4)
    assert lists.agg(F.max(F.size("campaign_id"))).first()[0] == 4
    told = lists.select(*KEY, F.explode("campaign_id").alias("campaign_id"))
    assert sorted(map(str, told.collect())) == sorted(map(str, right.select(*KEY, "campaign_id").collect()))


def test_files_of_pairs_hold_a_list_once(spark, tmp_path):
    """They held some two bytes of campaign id for every pair."""
    site = [F.lit(1).alias("tpid"), F.lit(0).alias("eapid"), F.lit("en_us").alias("locale")]
    members = spark.range(350).select("id", (F.xxhash64("id") % 7).cast("int").alias("campaign_segment_type_id"), *site)
    known = spark.range(10_500).select(F.col("id").cast("int").alias("campaign_id"), (F.col("id") % 7).cast("int").alias("campaign_segment_type_id"), F.lit(1).alias("priority"), *site)
    members = members.withColumn("campaign_segment_type_id", F.pmod("campaign_segment_type_id", F.lit(7)))
    met = allocation.meet_campaigns(members, known)
    met.select("id", "campaign_id").coalesce(1).write.parquet(str(tmp_path / "pairs"))
    assert spark.read.parquet(str(tmp_path / "pairs")).count() == 350 * 1500
    n_bytes = sum(f.stat().st_size for f in os.scandir(tmp_path / "pairs") if f.name.endswith(".parquet"))
    assert n_bytes < 0.7 * 350 * 1500
