"""Tokens, seeds, loyalty fields and ids of the final rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from outreach.functions.text import key_id, loyalty_flag, recipient_id
from outreach.operators.skew import first_per_group, group_heads, sized_join, spread_join
from outreach.sources.staging import stage
from outreach.params import DEFAULT_TEXT, POS, SEED_ACCOUNT

# Path of a tracked click around the token.
TOKEN_PREFIX = "emailclick/"

# Names of the delivered columns.
OUTPUT_NAMES = {
    "tpid": "TPID",
    "eapid": "EAPID",
    "first_name": "FIRST_NAME",
    "last_name": "LAST_NAME",
    "lang_id": "LANG_ID",
    "mer_status": "IsMER",
    "paid": "PAID",
    "email_address": "EmailAddress",
    "module_code": "OmniExtNewFormat",
    "recipient_id": "RecipientID",
    "user_token": "UserToken",
    "module_count": "ModuleCount",
    "subject_line": "SubjectLine",
    "member_id": "LoyaltyMemberID",
    "tier_name": "LoyaltyMemberTierName",
    "monetary_value": "MonetaryValue",
    "available_points": "LoyaltyAvailablePoints",
    "member_status": "LoyaltyMemberStatus",
    "launch_time_utc": "LaunchDateTimeUTC",
}


def _token(c: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), c, F.lit("/"))


def add_user_token(
    rows: DataFrame, primary: DataFrame, fallback: DataFrame, prefix: str = TOKEN_PREFIX
) -> DataFrame:
    """Token of the account from the first table, else the second, else empty. Rows
    without an account are not sent and drop out; repeated tokens count once."""
    def per_account(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col("paid").isNotNull()).groupBy("paid").agg(F.min("token").alias(name))

    return (
        rows.where(F.col("paid").isNotNull())
        .join(per_account(primary, "_first"), "paid", "left")
        .join(per_account(fallback, "_second"), "paid", "left")
        .withColumn(
            "user_token",
            F.coalesce(_token(F.col("_first"), prefix), _token(F.col("_second"), prefix), F.lit("")),
        )
        .drop("_first", "_second")
    )


def add_launch(rows: DataFrame, campaigns: DataFrame, **spread) -> DataFrame:
    """Launch date and time of the campaign in the row's locale; rows of other campaigns drop out."""
    launched = campaigns.select("campaign_id", "locale", "launch_date", "launch_time_utc").distinct()
    return sized_join(rows, launched, ["campaign_id", "locale"], **spread)


def add_module_count(
    rows: DataFrame, counts: DataFrame, on: tuple[str, ...] = ("campaign_id",), **spread
) -> DataFrame:
    """The number of modules of the row's campaign. Counts are a row per campaign."""
    return sized_join(rows, counts, list(on), **spread)


def none_to_null(df: DataFrame) -> DataFrame:
    """The text `None` becomes NULL in every string column."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.select(
        *[F.nullif(F.col(c), F.lit(DEFAULT_TEXT)).alias(c) if c in text else F.col(c) for c in df.columns]
    )


def numbered_seeds(seeds: DataFrame, category: str | None = None) -> DataFrame:
    """Active seed addresses numbered inside their point of sale."""
    active = seeds.where(F.col("is_active") == 1)
    if category is not None:
        active = active.where(F.col("category") == category)
    w = Window.partitionBy(*POS).orderBy("seed_email")
    return active.select(*POS, "seed_email").distinct().withColumn("n", F.row_number().over(w))


def seed_rows(rows: DataFrame, seeds: DataFrame, tie_break: list[str]) -> DataFrame:
    """Copies of the first rows of each campaign, the nth addressed to the nth seed of its
    point of sale and marked with the seed account. `rows` is read twice: stage it first."""
    seeds = stage(seeds)
    counts = seeds.groupBy(*POS).agg(F.max("n").alias("n_max"))
    heads = group_heads(rows, ["campaign_id", *POS], ["test_keys", *tie_break], counts, POS)
    return (
        sized_join(heads, seeds, [*POS, "n"])
        .withColumn("email_address", F.col("seed_email"))
        .withColumn("paid", F.lit(SEED_ACCOUNT).cast(rows.schema["paid"].dataType))
        .select(*rows.columns)
    )


def add_seeds(rows: DataFrame, seeds: DataFrame, tie_break: list[str]) -> DataFrame:
    """The rows and the seed copies; these are staged, as later joins read the rows again."""
    return rows.unionByName(stage(seed_rows(rows, seeds, tie_break)))


def add_loyalty(rows: DataFrame, members: DataFrame, **spread) -> DataFrame:
    """Loyalty fields by account and site; the smallest member id if an account repeats. The
    seed account and rows without an account may hold a third of the rows: both are split."""
    one = first_per_group(members.where(F.col("paid").isNotNull()), ["tpid", "paid"], ["member_id"])
    return (
        spread_join(rows, one, ["tpid", "paid"], "left", **spread)
        .withColumn("member_status", loyalty_flag(F.col("status")))
        .drop("status")
    )


def add_pos_mapping(rows: DataFrame, mapping: DataFrame, live_test: bool = False, **spread) -> DataFrame:
    """Brand and site code of the point of sale, a key of few values; test sends carry the
    site code X."""
    if live_test:
        mapping = mapping.withColumn("posa", F.lit("X"))
    return sized_join(rows, mapping, ["tpid", "eapid"], "left", **spread)


def add_program(rows: DataFrame, master: DataFrame, **spread) -> DataFrame:
    """Program parts and SID of the row's campaign and locale, from the audience master."""
    parts = master.select("campaign_id", "locale", "subchannel", "program", "campaign_code", "lob_intent", "sid")
    return sized_join(rows, parts, ["campaign_id", "locale"], "left", **spread)


def add_recipient_id(rows: DataFrame, home_brand: str) -> DataFrame:
    """Needs row_id, sid, brand, posa, the four program parts, issue_id and module_code."""
    return rows.withColumn(
        "recipient_id",
        recipient_id(
            brand=F.col("brand"), site=F.col("posa"),
            parts=[F.col(c) for c in ("subchannel", "program", "campaign_code", "lob_intent")],
            issue=F.col("issue_id"), sid=F.col("sid"), key=key_id(F.col("sid"), F.col("row_id")),
            account=F.col("paid"), locale=F.col("locale"), opted_in=F.col("mer_status"),
            module_code=F.col("module_code"), home_brand=home_brand,
        ),
    )


def add_upstream(
    rows: DataFrame, tokens: DataFrame, loyalty: DataFrame, prefixes: DataFrame, **spread
) -> DataFrame:
    """Ready-made token, loyalty fields and recipient prefix of an upstream run; the
    module code completes the prefix. Right sides are made unique on their key. Hot accounts,
    and rows without one, are split; `rows` is read again to find them, so stage it first."""
    person = ["paid", "email_address", "campaign_id"]
    member = ["tpid", "paid", "campaign_id"]
    spread = {"hot_in": rows, **spread}
    out = rows
    for right, key, order in (
        (tokens, person, "user_token"), (loyalty, member, "member_id"), (prefixes, person, "recipient_prefix"),
    ):
        known = right.where(F.col("paid").isNotNull())
        out = spread_join(out, first_per_group(known, key, [order]), key, "left", **spread)
    return (
        out
        .withColumn("recipient_id", F.concat("recipient_prefix", "module_code"))
        .drop("recipient_prefix")
    )


def output_projection(rows: DataFrame, drop: list[str] = (), drop_containing: str | None = None) -> DataFrame:
    """Rename to the delivered names and drop working columns, by name or by a substring."""
    unwanted = set(drop)
    if drop_containing is not None:
        unwanted |= {c for c in rows.columns if drop_containing in c}
    return rows.drop(*unwanted).withColumnsRenamed(OUTPUT_NAMES)


def redirect_address(rows: DataFrame, address: str | None) -> DataFrame:
    """Send everything to one test or sink address; no address leaves the rows alone."""
    return rows if address is None else rows.withColumn("email_address", F.lit(address))
