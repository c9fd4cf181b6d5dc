"""Matching travelers to campaigns and choosing a module version per slot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outreach.operators.skew import paired_join, sized_join, spread_join
from outreach.params import POS, SUPPRESSED

CONTENT_KEY = ["campaign_id", "test_keys", "segment_set"]
# What a campaign's content depends on, besides the traveler.
KIND = ["template_id", *POS, "campaign_segment_type_id", "priority"]
TRAVELER_KEY = ["email_address", "test_keys", *POS]


def outer_campaigns(active: DataFrame) -> DataFrame:
    """The campaigns left in the metadata, one row each."""
    return active.select("campaign_segment_type_id", "campaign_id", "priority", *POS).distinct()


def campaign_kinds(campaigns: DataFrame) -> DataFrame:
    """Campaigns that agree in all rows of what their content depends on: one row per kind
    with its smallest campaign, `leader`, and all of them, `led`. Whatever is decided for the
    leader holds for the others; in an order by (priority, campaign) it comes first. Where
    each campaign differs from all others, each leads itself. Missing ids stay by themselves."""
    rows = F.array_sort(F.collect_set(F.struct(*KIND)))
    told = campaigns.groupBy("campaign_id").agg(rows.alias("_kind"))
    return (
        told.groupBy("_kind", F.col("campaign_id").isNull().alias("_none"))
        .agg(F.min("campaign_id").alias("leader"), F.array_sort(F.collect_list("campaign_id")).alias("led"))
        .select("leader", "led")
    )


def leading(campaigns: DataFrame, kinds: DataFrame) -> DataFrame:
    """The campaigns that lead their kind."""
    leaders = kinds.select("leader")
    return campaigns.join(leaders, F.col("campaign_id").eqNullSafe(F.col("leader")), "left_semi")


def for_kinds(rows: DataFrame, kinds: DataFrame, **spread) -> DataFrame:
    """Rows of leading campaigns, repeated for every campaign of the kind. Kinds are copied while
    they are small, so the rows are repeated where they lie and not shuffled."""
    wide = sized_join(rows.withColumnRenamed("campaign_id", "leader"), kinds, ["leader"], **spread)
    return wide.withColumn("campaign_id", F.explode("led")).select(*rows.columns)


def meet_campaigns(people: DataFrame, campaigns: DataFrame, **spread) -> DataFrame:
    """People with each campaign of their outer segment. The campaigns of a segment come as
    lists, which a copied table holds: no pair is shuffled, the pairs leave a row's list."""
    return paired_join(people, campaigns, ["campaign_segment_type_id", *POS], **spread)


def traveler_campaign(traveler_segments: DataFrame, campaigns: DataFrame, **spread) -> DataFrame:
    """Every campaign whose outer segment a traveler is in."""
    left = traveler_segments.withColumnRenamed("segment_type_id", "campaign_segment_type_id")
    return meet_campaigns(left.distinct(), campaigns, hot_in=left, **spread)


def campaign_lists(campaigns: DataFrame) -> DataFrame:
    """The campaigns of each outer segment as one array of (priority, campaign_id), best
    first: one row per segment and point of sale. Suppressed campaigns are left out."""
    entry = F.struct("priority", "campaign_id")
    return (
        campaigns.where(F.col("priority") < SUPPRESSED)
        .groupBy("campaign_segment_type_id", *POS)
        .agg(F.array_sort(F.collect_set(entry)).alias("campaigns"))
    )


def members(traveler_segments: DataFrame, travelers: DataFrame, **spread) -> DataFrame:
    """Profiles with each outer segment they are in, before any campaign is looked at."""
    outer = traveler_segments.withColumnRenamed("segment_type_id", "campaign_segment_type_id").distinct()
    return spread_join(travelers.distinct(), outer, TRAVELER_KEY, hot_in=travelers, **spread)


def next_campaigns(waiting: DataFrame, lists: DataFrame, n: int) -> DataFrame:
    """The `n` best campaigns of each address that come after its `last`.

    `waiting` has a row per address and list (email_address, campaign_segment_type_id, point
    of sale) with `last`, the (priority, campaign_id) an address was offered last, or NULL.
    Lists are configuration, a row per segment: Spark broadcasts them while they are small
    and splits hot segments beyond. Only the next entries of a list leave the join. Of an
    address, its campaigns combine before the shuffle.
    """
    key = ["campaign_segment_type_id", *POS]
    after = F.filter("campaigns", lambda c: F.col("last").isNull() | (c > F.col("last")))
    entry = F.transform(
        F.slice(after, 1, n),
        lambda c: F.struct(c["priority"].alias("priority"), c["campaign_id"].alias("campaign_id"), *[F.col(k).alias(k) for k in key]),
    )
    heads = waiting.join(lists, key).select("email_address", F.explode(entry).alias("c"))
    if n == 1:
        return heads.groupBy("email_address").agg(F.min("c").alias("c")).select("email_address", "c.*")
    best = F.slice(F.array_sort(F.collect_set("c")), 1, n)
    return heads.groupBy("email_address").agg(F.explode(best).alias("c")).select("email_address", "c.*")


def join_profile(matched: DataFrame, travelers: DataFrame, **spread) -> DataFrame:
    """Attach the profile. Both sides are made distinct first, so the join needs no
    clean-up shuffle of the wide rows afterwards. Profiles are the side that is split: a
    traveler key matches no more rows than there are campaigns and segment sets."""
    return spread_join(
        travelers.distinct(), matched.distinct(), TRAVELER_KEY, hot_in=travelers, **spread
    )


def slot_keys(base: DataFrame) -> DataFrame:
    """Distinct inputs of the allocation: far fewer than travelers."""
    return base.select(*CONTENT_KEY, "campaign_segment_type_id").distinct()


def content_keys(members: DataFrame, campaigns: DataFrame) -> DataFrame:
    """`slot_keys` without joining people with campaigns: the few distinct test keys and
    segment sets of an outer segment meet its campaigns."""
    kinds = members.select("test_keys", "segment_set", "campaign_segment_type_id", *POS).distinct()
    met = kinds.join(campaigns, ["campaign_segment_type_id", *POS])
    return met.select(*CONTENT_KEY, "campaign_segment_type_id").distinct()


def segment_member(keys: DataFrame, inner: DataFrame, **spread) -> DataFrame:
    """Join the ids of a `2#6#7` segment set with a frame keyed by segment_type_id, and by
    campaign where it has one. A segment may be in most of the sets."""
    ids = F.transform(F.split("segment_set", "#"), lambda s: s.cast("int"))
    exploded = keys.withColumn("segment_type_id", F.explode(F.array_distinct(ids)))
    on = [c for c in ("campaign_id", "segment_type_id") if c in inner.columns]
    return sized_join(exploded, inner, on, **spread)


def slot_candidates(ranked: DataFrame) -> DataFrame:
    """Per campaign, inner segment, slot, type and priority: version rank -> module, the
    smallest module id if several share a version. The versions of a type bound the map."""
    key = [
        "campaign_id", *POS, "segment_type_id", "slot_position", "module_type_id",
        "module_priority_in_slot", "placement_type", "ttl_versions",
    ]
    versions = F.collect_list(F.struct("version_rank", "module_id"))
    return (
        ranked.groupBy(*key, "version_rank").agg(F.min("module_id").alias("module_id"))
        .groupBy(*key).agg(F.map_from_entries(versions).alias("versions"))
    )


def allocate_modules(keys: DataFrame, candidates: DataFrame, seed: int) -> DataFrame:
    """The version due today for each slot and module type.

    `(test_key + seed % n) % n + 1` picks among n versions, so neighbouring test keys see
    different versions and every key moves on daily; a version the slot lacks passes the
    type over. Types stay side by side in a slot, one module per (type, priority).
    """
    n = F.col("ttl_versions")
    due = (F.col("test_keys") + F.lit(seed) % n) % n + 1
    return (
        segment_member(keys, candidates)
        .withColumn("module_id", F.element_at("versions", due))
        .where(F.col("module_id").isNotNull())
        .groupBy(
            *CONTENT_KEY, "campaign_segment_type_id", *POS, "slot_position", "module_type_id",
            "module_priority_in_slot",
        )
        .agg(F.min("module_id").alias("module_id"))
    )
