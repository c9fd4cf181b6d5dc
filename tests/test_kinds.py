"""Work that grows with campaigns times travelers only where rows are asked for: campaigns of one
kind decided once, and what cannot win left out before people meet campaigns."""

from outreach.operators import allocation, arbitration, content
from outreach.params import POS
from outreach.workload import queries
from outreach.workload.fixtures import Domain

SITE = (1, 0, "en_us")
CAMPAIGN = "campaign_id int, tpid int, eapid int, locale string, campaign_segment_type_id int, template_id int, priority int"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def campaigns(spark):
    return spark.createDataFrame([
        (1, *SITE, 1, 7, 2), (4, *SITE, 1, 7, 2), (4, *SITE, 1, 7, 2),     # one kind, a row twice
        (2, *SITE, 1, 7, 1), (3, *SITE, 1, 8, 2),                          # other priority, other template
        (5, *SITE, 1, 7, 2), (5, *SITE, 2, 7, 2),                          # an id with two rows
        (6, *SITE, 2, 7, 2), (6, *SITE, 1, 7, 2),
        (8, *SITE, 1, 7, None), (9, *SITE, 1, 7, None), (None, *SITE, 1, 7, 2),
    ], CAMPAIGN)


def test_campaigns_of_one_kind_have_one_leader(spark):
    some = campaigns(spark)
    kinds = allocation.campaign_kinds(some)
    assert rows(kinds) == sorted([(1, [1, 4]), (2, [2]), (3, [3]), (5, [5, 6]), (8, [8, 9]), (None, [])], key=str)
    led = allocation.leading(some, kinds)
    assert sorted({str(r.campaign_id) for r in led.collect()}) == ["1", "2", "3", "5", "8", "None"]
    # what was decided for leaders is repeated for all they lead, and nothing else changes
    decided = spark.createDataFrame([("x", 1, 0.5), ("y", 3, 0.1)], "a string, campaign_id int, b double")
    for limit in ({}, {"max_bytes": 0}):
        got = allocation.for_kinds(decided, kinds, **limit)
        assert got.columns == decided.columns and rows(got) == [("x", 1, 0.5), ("x", 4, 0.5), ("y", 3, 0.1)]


def people(spark, n=40):
    return spark.createDataFrame(
        [(f"u{i % 30}@x", i, *SITE, i % 7, "1#2", 1 + i % 2, "c" if i % 3 else None) for i in range(n)],
        "email_address string, user_id int, tpid int, eapid int, locale string, test_keys int, segment_set string, "
        "campaign_segment_type_id int, city string",
    )


def test_only_contenders_and_heads_are_met(spark):
    known = campaigns(spark).drop("template_id").distinct()
    met = allocation.meet_campaigns(people(spark), known)
    want = people(spark).join(known, ["campaign_segment_type_id", *POS])
    assert rows(met.select(sorted(met.columns))) == rows(want.select(sorted(met.columns)))
    pairs = met.withColumnRenamed("priority", "campaign_priority")
    few = arbitration.contenders(known)
    assert {r.campaign_id for r in few.collect()} == {8, 5}  # a missing priority comes first, as in an order
    less = allocation.meet_campaigns(people(spark), few).withColumnRenamed("priority", "campaign_priority")
    assert rows(arbitration.keep_best(less)) == rows(arbitration.keep_best(pairs))
    heads = arbitration.segment_heads(people(spark), 3, ["user_id"])
    assert heads.count() == 6
    some = allocation.meet_campaigns(heads, known)
    columns = ["campaign_id", "test_keys", "user_id"]
    assert rows(arbitration.campaign_head(some, 3, ["user_id"]).select(columns)) == rows(
        arbitration.campaign_head(met, 3, ["user_id"]).select(columns)
    )


def test_content_is_told_apart_without_people(spark):
    known = campaigns(spark).drop("template_id").distinct()
    want = content.distinct_content(allocation.meet_campaigns(people(spark), known), ["city"])
    assert rows(content.content_kinds(people(spark), known, ["city"])) == rows(want)


def test_pairs_are_not_shuffled(spark, sf_dir):
    plan = queries.profile_rows(Domain(spark, sf_dir))._jdf.queryExecution().optimizedPlan().toString()
    # the pairs leave their list above the last join and aggregate
    assert plan.lstrip().startswith(("Project", "Generate")) and plan.index("Generate") < plan.index("Join")
    assert "Aggregate" not in plan[:plan.index("Generate")]


def test_the_metadata_of_distinct_places_is_enough(spark, sf_dir):
    d = Domain(spark, sf_dir)
    d.campaign = d.campaign.unionByName(d.campaign.withColumn("campaign_id", d.campaign.campaign_id + 1000))
    columns = [*POS, "module_id", "slot_position"]
    few, every = queries._active(d, *queries.PLACED), queries._active(d)
    assert few.count() < every.count()
    assert rows(few.select(columns).distinct()) == rows(every.select(columns).distinct())
    assert "campaign_id" not in few.columns
