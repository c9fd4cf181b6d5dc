"""From rendered content back to people, and one campaign per person."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outreach.operators.allocation import CONTENT_KEY, next_campaigns
from outreach.operators.skew import first_per_group, spread_join
from outreach.operators.slots import slot_module
from outreach.params import EMPTY_MODULE, POS, SUPPRESSED
from outreach.sources.staging import stage


def fan_out(people: DataFrame, content: DataFrame, columns: list[str], **spread) -> DataFrame:
    """Give everyone the content rendered for their key.

    Joins on the real columns with NULL equal to NULL, so people with a missing attribute
    stay and (a, NULL) and (NULL, a) do not meet. Files of people are far smaller than their
    rows, and picks than their texts, so neither side is copied by the size of its files.
    """
    key = [*POS, *columns, *CONTENT_KEY]
    return spread_join(people, content.drop("priority", "offer").hint("merge"), key, null_safe=True, **spread)


def best_campaign(rows: DataFrame) -> DataFrame:
    """Best (priority, campaign) of each address. The minimum combines before the shuffle,
    so an address with very many rows costs no more than any other."""
    best = F.min(F.struct("campaign_priority", "campaign_id")).alias("_best")
    return rows.groupBy("email_address").agg(best).select(
        "email_address", F.col("_best.campaign_id").alias("campaign_id")
    )


def keep_best(rows: DataFrame, **spread) -> DataFrame:
    """Rows of the best campaign of their address; people who share an address all stay."""
    return spread_join(
        rows, best_campaign(rows), ["email_address", "campaign_id"], "left_semi", null_safe=True, **spread
    )


def contenders(campaigns: DataFrame) -> DataFrame:
    """The campaigns that can be the best of an address whose rows keep their priority: those
    whose id comes first, by (priority, campaign), among the campaigns of some outer segment."""
    first = F.min(F.struct("priority", "campaign_id")).alias("_first")
    heads = campaigns.groupBy("campaign_segment_type_id", *POS).agg(first).select(F.col("_first.campaign_id").alias("_head"))
    return campaigns.join(heads, F.col("campaign_id").eqNullSafe(F.col("_head")), "left_semi")


def sendable(rows: DataFrame) -> DataFrame:
    """Drop suppressed campaigns and messages without a subject (slot 1) or hero (slot 2)."""
    return rows.where(
        (F.col("campaign_priority") != SUPPRESSED)
        & (F.coalesce(slot_module(F.col("picks"), 1), F.lit(EMPTY_MODULE)) != EMPTY_MODULE)
        & (F.coalesce(slot_module(F.col("picks"), 2), F.lit(EMPTY_MODULE)) != EMPTY_MODULE)
    )


def arbitrate(rows: DataFrame, fallthrough: bool = False, **spread) -> DataFrame:
    """Keep the best campaign of each address, then drop what cannot be sent.

    In that order a person whose best campaign cannot be sent gets nothing;
    `fallthrough` drops first, so the runner-up is sent. `rows` is read twice: stage it.
    """
    if fallthrough:
        return keep_best(sendable(rows), **spread)
    return sendable(keep_best(rows, **spread))


def _of_address(rows: DataFrame, told: DataFrame, how: str, *more: str) -> DataFrame:
    """Join by address, a missing one equal to a missing one, and other columns."""
    keys = ["email_address", *more]
    other = told.withColumnsRenamed({k: f"_t_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(other[f"_t_{k}"]) for k in keys])
    return rows.join(other, same, how).drop(*[f"_t_{k}" for k in keys])


def arbitrate_rounds(
    members: DataFrame, lists: DataFrame, render: Callable[[DataFrame], DataFrame], fallthrough: bool = False, widen: int = 4
) -> tuple[DataFrame | None, list[DataFrame]]:
    """What `arbitrate` keeps, found without rendering what cannot win: the rows, or None
    if there are none, and the rows that each round offered for rendering.

    `members` are profiles with their outer segments, `lists` the campaigns of a segment in
    order of priority, both staged; `render` gives rows (profile, campaign) their content, as
    `fan_out` does. A campaign ends with its own priority or with 9999, never with a better
    one, and a row's content does not depend on other rows. So an address is offered its
    best campaign first; if some row of it keeps its priority, no other campaign can win,
    and the address is settled. Only addresses whose campaign fell to 9999, or had no
    content, go on to the next round, where they are offered `widen` times as many campaigns
    at once, so that a long list is through after few rounds. Priorities lie below 9999;
    campaigns at 9999 are never offered, as they would not be sent.

    The joins of a round have one row per address, or per address and campaign, on one side;
    Spark splits an address that many people share.
    """
    key = ["campaign_segment_type_id", *POS]
    waiting = members.select("email_address", *key).distinct().withColumn(
        "last", F.lit(None).cast(lists.schema["campaigns"].dataType.elementType)
    )
    kept, offered, n = None, [], 1
    while True:
        chosen = stage(next_campaigns(waiting, lists, n))
        if chosen.isEmpty():
            return kept, offered
        people = stage(_of_address(members, chosen, "inner", *key))
        offered.append(people)
        rows = stage(render(people))
        alive = sendable(rows) if fallthrough else rows.where(F.col("campaign_priority") != SUPPRESSED)
        best = stage(best_campaign(alive))
        won = _of_address(rows, best, "left_semi", "campaign_id")
        kept = sendable(won) if kept is None else kept.unionByName(sendable(won))
        last = chosen.groupBy("email_address").agg(F.max(F.struct("priority", "campaign_id")).alias("last"))
        open_ones = _of_address(last, best, "left_anti")
        waiting = stage(_of_address(waiting.drop("last"), open_ones, "inner"))
        n *= widen


def dedupe_recipient(rows: DataFrame, tie_break: list[str]) -> DataFrame:
    """One row per address and account."""
    return first_per_group(rows, ["email_address", "paid"], tie_break)


def campaign_head(rows: DataFrame, n: int, tie_break: list[str]) -> DataFrame:
    """First n rows of each campaign by test key."""
    return first_per_group(rows, ["campaign_id"], ["test_keys", *tie_break], n)


def segment_heads(members: DataFrame, n: int, tie_break: list[str]) -> DataFrame:
    """First n members of each outer segment in the order of `campaign_head`: no other member can
    be among the first n rows of a campaign."""
    return first_per_group(members, ["campaign_segment_type_id", *POS], ["test_keys", *tie_break], n)
