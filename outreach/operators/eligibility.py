"""Which campaigns are live and which travelers may be contacted."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outreach.operators.skew import sized_join, spread_join
from outreach.params import POS, SUPPRESSED

SEGMENT_KEY = ["tpid", "eapid", "segment_type_id"]

# Test-key bands that the recent-contact rules apply to.
TEST_KEY_BANDS = ((17, 50), (83, 99))


def live_campaigns(
    campaigns: DataFrame,
    run_date: dt.date,
    locale: str | None = None,
    program_type: str | None = None,
    campaign_id: int | None = None,
) -> DataFrame:
    """Campaigns launching on the run date and not deleted; optionally of one locale,
    one program, or a single campaign (manual test sends)."""
    df = campaigns.where(
        (F.col("launch_date") == F.lit(run_date)) & (F.col("campaign_deleted_flag") == 0)
    )
    if locale is not None:
        df = df.where(F.lower("locale") == locale.lower())
    if program_type is not None:
        df = df.where(F.col("program_type") == program_type)
    if campaign_id is not None:
        df = df.where(F.col("campaign_id") == campaign_id)
    return df


def drop_manual_launches(campaigns: DataFrame, manual: DataFrame) -> DataFrame:
    """Campaigns not already launched by hand for the same locale and date."""
    return campaigns.join(manual, ["campaign_id", "locale", "launch_date"], "left_anti")


def dead_segments(campaigns: DataFrame, segments: DataFrame) -> DataFrame:
    """Outer segments that campaigns use and that are not active."""
    used = campaigns.select(
        "tpid", "eapid", F.col("campaign_segment_type_id").alias("segment_type_id")
    ).distinct()
    return used.join(active_segments(segments), SEGMENT_KEY, "left_anti")


def active_segments(segments: DataFrame) -> DataFrame:
    return segments.where(F.col("segment_deleted_flag") == 0).select(*SEGMENT_KEY).distinct()


def demote_dead(campaigns: DataFrame, segments: DataFrame) -> DataFrame:
    """Set the priority of campaigns on a dead outer segment to 9999."""
    dead = (
        dead_segments(campaigns, segments)
        .withColumnRenamed("segment_type_id", "campaign_segment_type_id")
        .withColumn("_dead", F.lit(True))
    )
    return (
        campaigns.join(dead, ["tpid", "eapid", "campaign_segment_type_id"], "left")
        .withColumn("priority", F.when(F.col("_dead"), SUPPRESSED).otherwise(F.col("priority")))
        .select(*campaigns.columns)
    )


def pos_of(campaigns: DataFrame) -> DataFrame:
    """The points of sale that the campaigns run in, incomplete ones left out."""
    present = F.col("locale").isNotNull() & F.col("tpid").isNotNull() & F.col("eapid").isNotNull()
    return campaigns.where(present).select(*POS).distinct()


def at_pos(df: DataFrame, pos: DataFrame, **spread) -> DataFrame:
    """Rows of the given points of sale."""
    return sized_join(df, pos, POS, "left_semi", **spread)


def of_campaigns(traveler_segments: DataFrame, campaigns: DataFrame, **spread) -> DataFrame:
    """Memberships of the outer segments that the campaigns use; others reach nobody."""
    used = campaigns.select(*POS, F.col("campaign_segment_type_id").alias("segment_type_id")).distinct()
    return sized_join(traveler_segments, used, [*POS, "segment_type_id"], "left_semi", **spread)


def gate(df: DataFrame, flags: DataFrame) -> DataFrame:
    """All rows if the one-cell flag table says 1, else none; a scalar subquery."""
    return df.where(flags.select("flag").scalar() == 1)


def _in_band(test_key: Column) -> Column:
    (a, b), (c, d) = TEST_KEY_BANDS
    return test_key.between(a, b) | test_key.between(c, d)


def _keyed() -> Column:
    return F.col("email_address").isNotNull() & F.col("tpid").isNotNull() & F.col("eapid").isNotNull()


def _contact_keys(df: DataFrame) -> DataFrame:
    return df.select(F.lower("email_address").alias("email_address"), "tpid", "eapid").distinct()


def recent_notified(history: DataFrame, as_of: Column, strict: bool = False) -> DataFrame:
    """Contacts notified in the last 24 hours, or banded test keys beyond the date bound.

    By default the bound of the second branch lies seven days ahead and the branch is not
    guarded against missing keys; `strict` looks seven days back and guards both.
    """
    day = as_of - F.expr("INTERVAL 24 HOURS")
    week = F.expr("INTERVAL 7 DAYS")
    created, banded = F.col("create_date"), _in_band(F.col("test_keys"))
    if strict:
        keep = _keyed() & ((created > day) | (banded & (created > as_of - week)))
    else:
        keep = (_keyed() & (created > day)) | (banded & (created > as_of + week))
    return _contact_keys(history.where(keep))


def recent_booked(bookings: DataFrame, as_of: Column, strict: bool = False) -> DataFrame:
    """Contacts in the test-key bands with a freshly loaded booking that was created or
    ended in the last 7 days, or starts within the 24-hour bound.

    By default the start bounds are in descending order and so never hold; `strict`
    orders them.
    """
    day, week = F.expr("INTERVAL 24 HOURS"), F.expr("INTERVAL 7 DAYS")
    start, end = F.col("booking_start"), F.col("booking_end")
    starts = start.between(as_of - day, as_of) if strict else start.between(as_of, as_of - day)
    in_window = (F.col("create_date") > as_of - week) | starts | end.between(as_of - week, as_of)
    loaded = F.col("etl_update_date") > as_of - F.expr("INTERVAL 1 DAY")
    return _contact_keys(
        bookings.where(_keyed() & in_window & _in_band(F.col("test_keys")) & loaded)
    )


def eligible_travelers(travelers: DataFrame, program: str, locale: str | None = None) -> DataFrame:
    """Opted-in travelers for marketing; a loyalty run only keeps its locale."""
    if locale is not None:
        travelers = travelers.where(F.lower("locale") == locale.lower())
    if program != "loyalty":
        travelers = travelers.where(F.col("mer_status") == 1)
    return travelers


def suppress_recent(travelers: DataFrame, *recent: DataFrame, **spread) -> DataFrame:
    """Travelers without a recent contact. Case of the address is ignored on both sides;
    a missing address matches nothing, so it is kept."""
    keys = ["_email", "tpid", "eapid"]
    contacts = recent[0]
    for more in recent[1:]:
        contacts = contacts.unionByName(more)
    contacts = contacts.select(F.lower("email_address").alias("_email"), "tpid", "eapid").distinct()
    left = travelers.withColumn("_email", F.lower("email_address"))
    return spread_join(left, contacts, keys, "left_anti", **spread).drop("_email")
