"""Content that looks the same rendered once, texts attached to distinct lists of candidates, and
nothing copied or computed twice on the way."""

import random

from pyspark.sql import functions as F

from outreach.operators import arbitration, content, metadata, slots
from outreach.params import POS
from outreach.sources.staging import stage

SITE, OTHER = (1, 0, "en_us"), (2, 0, "fr_fr")
AT = "tpid int, eapid int, locale string"
KEYS = "campaign_id int, test_keys int, segment_set string"


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def allocated(spark):
    rng = random.Random(3)
    lists = [[(s, t, 10 * s + t, rng.randint(1, 9)) for s in range(1, 4) for t in (1, 2)] for _ in range(5)]
    found = [
        (c if c != 7 else None, k, "1#6" if c % 2 else None, *(OTHER if c == 5 and s == 3 else SITE), s, t, p, m)
        for c in range(12) for k in range(6) for s, t, p, m in lists[(c + k) % 5]
    ]
    schema = f"{KEYS}, {AT}, slot_position int, module_type_id int, module_priority_in_slot int, module_id int"
    return spark.createDataFrame([*found, found[0], (50, 1, "x", *SITE, 1, None, 1, 999), (51, 1, "x", *SITE, 1, None, 1, 3)], schema)


def modules(spark):
    """Two descriptions of module 2, none of 9 in the other locale, variables of all but 8."""
    at = [(*site, m, "hero", "KIND", m % 2) for site in (SITE, OTHER) for m in range(1, 10) if site == SITE or m != 9]
    traits = spark.createDataFrame([*at, (*SITE, 2, "body", "KIND", 0), at[0]], f"{AT}, module_id int, placement_type string, module_type string, default_flag int")
    variables = spark.createDataFrame(
        [(*site, m, 1, 1, "", f"text {m}") for site in (SITE, OTHER) for m in range(1, 10) if m != 8],
        f"{AT}, module_id int, var_position int, source_connection int, var_source string, var_structure string",
    )
    return traits, metadata.module_info(variables)


def test_keys_that_are_offered_the_same_share_a_list(spark):
    due, (traits, info) = allocated(spark), modules(spark)
    described = content.described_modules(due, traits, info)
    offers = stage(content.offered_lists(due, described))
    arrays = content.candidate_arrays(offers, described)
    assert arrays.count() < offers.count() / 4
    got = offers.join(arrays, "offer").select("campaign_id", "test_keys", "segment_set", F.array_sort("candidates").alias("c"))
    entry = F.struct(
        F.col("slot_position").alias("slot"), F.col("module_priority_in_slot").alias("priority"),
        "module_id", "module_type_id", "placement_type", "default_flag", "variables",
    )
    every = due.join(traits.distinct(), [*POS, "module_id"]).join(info, [*POS, "module_id"])
    want = every.groupBy("campaign_id", "test_keys", "segment_set").agg(F.array_sort(F.collect_list(entry)).alias("c"))
    assert rows(got) == rows(want)


def told(spark):
    """Two of three campaigns look the same."""
    return spark.createDataFrame(
        [(*SITE, city, c, k, s, 3 if c < 8 else None, "a" if c < 9 else "b")
         for city in ("Rome", None) for c in range(12) for k in range(4) for s in ("1", None)],
        f"{AT}, city string, {KEYS}, priority int, offer string",
    )


def test_what_looks_the_same_is_one_row(spark):
    alike = content.content_alike(told(spark), ["city"], 100_000)
    assert alike.count() == 2 * 4 * 3
    assert rows(content.for_alike(alike).select(told(spark).columns)) == rows(told(spark))
    # rows of few bytes and much work go to tasks by their number
    assert alike.rdd.getNumPartitions() == 6


def test_slots_are_picked_once(spark):
    """An explode puts a filter on its array below the projection, which computes the array again."""
    from outreach.workload import queries

    class Run:
        whole = None

        def for_all(self, df):
            return df

    cell = F.array(F.struct(F.lit(1).alias("position"), F.lit("v").alias("value"), F.lit("0").alias("option"), F.lit(False).alias("failed")))
    shown = F.array(F.struct(
        F.lit(1).alias("slot"), F.lit(2).alias("priority"), F.lit(5).alias("module_id"), F.lit(1).alias("module_type_id"),
        F.lit("body").alias("placement_type"), F.col("test_keys").alias("default_flag"), cell.alias("cells"),
        F.lit(None).cast(slots.ATTRIBUTE).alias("attributes"),
    ))
    looks = told(spark).withColumn("mktsegment", F.lit("S"))
    alike = stage(content.content_alike(looks, ["city", "mktsegment"], 10)).withColumn("rendered", shown)
    frame = spark.createDataFrame([([1, 2],)], "slots array<int>")
    run = Run()
    run.whole = type("W", (), {"picks": slots.pick_slots(alike, frame)})
    made, queries.decisions = queries.decisions, lambda d: run
    try:
        won = queries.slot_winner(None)
    finally:
        queries.decisions = made
    plan = won._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "aggregate(" in line]
    found = won.groupBy("slot", "module_id", "fill_reason").count().collect()
    assert sorted((r.slot, r.module_id, r.fill_reason, r["count"]) for r in found) == [(1, 5, None, 192), (2, 999, "None", 192)]


def test_people_are_not_copied_by_the_size_of_their_files(spark):
    people = stage(told(spark).drop("offer").withColumn("email_address", F.lit("a@x")))
    made = told(spark).withColumn("module_code", F.lit("1-2"))
    out = arbitration.fan_out(people, made, ["city"], rows=10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert out.columns.count("offer") == 0
