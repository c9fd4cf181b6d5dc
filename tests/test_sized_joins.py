"""Joins on few-valued or hot keys: copied within a measured size, split beyond, same rows."""

import pytest
from pyspark.sql import functions as F

from outreach.operators import allocation, eligibility, enrichment, experiments, skew
from outreach.operators.skew import measured, sized_join
from outreach.params import POS, SEED_ACCOUNT
from outreach.sources.staging import stage

AT = "tpid int, eapid int, locale string"


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def people(spark):
    """A third of the rows on one point of sale and campaign, some without an account, a third
    on the seed account."""
    account = F.when(F.col("id") % 3 == 0, SEED_ACCOUNT).when(F.col("id") % 7 != 0, F.col("id") % 50)
    return stage(
        spark.range(600).select(
            F.col("id").cast("int").alias("user_id"),
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 4).cast("int").alias("tpid"),
            F.lit(0).alias("eapid"), F.lit("en_us").alias("locale"),
            F.when(F.col("id") % 3 == 1, 5).otherwise(F.col("id") % 6).cast("int").alias("campaign_id"),
            F.concat(F.lit("e"), F.col("id") % 90).alias("email_address"),
            account.cast("int").alias("paid"), (F.col("id") % 5).cast("int").alias("test_keys"),
            F.when(F.col("id") % 2 == 0, "2#6").otherwise("6#7#6").alias("segment_set"),
            F.lit("ID").alias("recipient_id"),
            F.when(F.col("id") % 3 > 0, "1-4").otherwise("1-9").alias("module_code"),
        )
    )


def campaigns(spark):
    at = [(c, c % 4, 0, "en_us" if c != 4 else "fr_fr", c % 3, f"2001-08-0{c + 1}", f"T{c}") for c in range(6)]
    schema = f"campaign_id int, {AT}, campaign_segment_type_id int, launch_date string, launch_time_utc string"
    return spark.createDataFrame(at, schema)


def cases(spark, people):
    """Each operator with its input and the same join written out."""
    pos = spark.createDataFrame([(1, 0, "en_us"), (3, 0, "en_us"), (None, 0, "en_us")], AT)
    mapping = spark.createDataFrame([(1, 0, "B", "X1"), (2, 0, "C", "X2")], "tpid int, eapid int, brand string, posa string")
    counts = spark.createDataFrame([(5, 3), (1, 2)], "campaign_id int, module_count int")
    inner = spark.createDataFrame([(2, 1), (6, 8), (6, 9)], "segment_type_id int, module_type_id int")
    tags = spark.createDataFrame([(1, 0, "en_us", k, "1-9", f"{k}#1") for k in range(3)], AT + ", test_keys int, module_code string, test_tag string")
    member = "tpid int, paid int, member_id string, tier_name string, available_points int, status string"
    members = spark.createDataFrame(
        [(1, SEED_ACCOUNT, "m9", "t", 1, "Active"), (1, SEED_ACCOUNT, "m1", "t", 2, "Gone"), (2, 5, "m5", "u", 3, "Active"), (1, None, "m0", "t", 4, "Active")], member,
    )
    live, segments = campaigns(spark), people.withColumn("segment_type_id", F.col("user_id") % 3)
    used = live.select(*POS, F.col("campaign_segment_type_id").alias("segment_type_id")).distinct()
    one = members.where("member_id IN ('m1', 'm5')")
    ids = F.explode(F.array_distinct(F.transform(F.split("segment_set", "#"), lambda s: s.cast("int"))))
    return {
        "at_pos": (lambda **o: eligibility.at_pos(people, pos, **o), people.join(pos, POS, "left_semi")),
        "of_campaigns": (
            lambda **o: eligibility.of_campaigns(segments, live, **o), segments.join(used, [*POS, "segment_type_id"], "left_semi"),
        ),
        "segment_member": (
            lambda **o: allocation.segment_member(people, inner, **o),
            people.withColumn("segment_type_id", ids).join(inner, "segment_type_id"),
        ),
        "add_launch": (
            lambda **o: enrichment.add_launch(people, live, **o),
            people.join(live.select("campaign_id", "locale", "launch_date", "launch_time_utc"), ["campaign_id", "locale"]),
        ),
        "add_module_count": (lambda **o: enrichment.add_module_count(people, counts, **o), people.join(counts, "campaign_id")),
        "add_pos_mapping": (lambda **o: enrichment.add_pos_mapping(people, mapping, **o), people.join(mapping, ["tpid", "eapid"], "left")),
        "add_test_tag": (
            lambda **o: experiments.add_test_tag(people, tags, **o),
            people.join(tags, [*POS, "test_keys", "module_code"], "left")
            .withColumn("recipient_id", experiments.rewrite_tag(F.col("recipient_id"), F.col("test_tag"))).drop("test_tag"),
        ),
        "add_loyalty": (
            lambda max_bytes=0, **o: enrichment.add_loyalty(people, members, **o),
            people.join(one, ["tpid", "paid"], "left")
            .withColumn("member_status", F.when(F.col("status") == "Active", "1").otherwise("0")).drop("status"),
        ),
    }


NAMES = ["at_pos", "of_campaigns", "segment_member", "add_launch", "add_module_count", "add_pos_mapping", "add_test_tag", "add_loyalty"]


@pytest.mark.parametrize("name", NAMES)
def test_copied_and_split_joins_equal_the_plain_one(spark, people, name):
    build, plain = cases(spark, people)[name]
    want = rows_of(plain)
    assert want
    assert rows_of(build()) == want
    split = build(max_bytes=0, min_rows=20, salts=4)
    assert "_salt" in split._jdf.queryExecution().analyzed().toString()
    assert rows_of(split) == want


def test_small_tables_are_copied_and_large_ones_are_not(spark, people):
    counts = spark.createDataFrame([(5, 3), (1, 2)], "campaign_id int, module_count int")
    copied = plan(sized_join(people, counts, ["campaign_id"]))
    assert "BroadcastHashJoin" in copied and "hashpartitioning" not in copied
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in plan(sized_join(people, counts, ["campaign_id"], max_bytes=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_size_counts_whole_strings(spark):
    rows = spark.createDataFrame([("x" * 5000, None), (None, 1)], "`a.b` string, n int")
    table, n_bytes = measured(rows)
    assert 5000 < n_bytes < 5100 and table.count() == 2
    none, n_bytes = measured(rows.where("n > 5"))
    assert n_bytes == 0 and none.isEmpty()
    assert measured(rows.limit(0))[1] == 0


def test_upstream_fields_with_seed_and_missing_accounts(spark, people):
    """A third of the rows on the seed account, a tenth without one: split and plain agree, and
    a missing account finds nothing although the right sides hold one."""
    person = people.select("paid", "email_address", "campaign_id").distinct()
    tokens = person.withColumn("user_token", F.concat_ws("-", F.col("paid").cast("string"), "email_address"))
    prefixes = person.withColumn("recipient_prefix", F.lit("P"))
    loyalty = people.select("tpid", "paid", "campaign_id", F.concat(F.lit("m"), "user_id").alias("member_id"))
    plain = enrichment.add_upstream(people, tokens, loyalty, prefixes)
    split = enrichment.add_upstream(people, tokens, loyalty, prefixes, min_rows=15, salts=3)
    assert rows_of(plain) == rows_of(split)
    assert plain.count() == people.count()
    missing = plain.where(F.col("paid").isNull())
    assert missing.count() > 30
    assert missing.where("user_token IS NOT NULL OR member_id IS NOT NULL OR recipient_id IS NOT NULL").isEmpty()
    assert plain.where("paid IS NOT NULL AND (user_token IS NULL OR member_id IS NULL)").isEmpty()


def test_hot_rows_of_the_seed_account_reach_many_tasks(spark, people):
    members = spark.createDataFrame([(1, SEED_ACCOUNT, "m1", "Active")], "tpid int, paid int, member_id string, status string")
    hot = skew.hot_keys(people, ["tpid", "paid"], min_rows=10)
    assert {(r.tpid, r.paid) for r in hot.collect()} >= {(1, SEED_ACCOUNT), (1, None)}
    out = enrichment.add_loyalty(people, members, min_rows=10, salts=4)
    assert out.where(F.col("paid") == SEED_ACCOUNT).where("member_id IS NULL").isEmpty()
