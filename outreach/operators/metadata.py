"""Campaign metadata: slots, candidate modules, versions and variables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from outreach.functions.templates import parse
from outreach.functions.text import (
    is_present,
    spec_columns,
    spec_file,
    spec_side,
    traveler_columns,
)
from outreach.operators.eligibility import SEGMENT_KEY, active_segments
from outreach.params import ACTIVE, POS, TEST_ONLY

MODULE_KEY = ["locale", "module_type_id", "tpid", "eapid", "placement_type", "channel"]
VERSION_KEY = [*POS, "module_type_id", "placement_type"]
SLOT_KEY = ["campaign_id", "slot_position", "module_type_id", "placement_type"]

# Traveler columns every run needs.
BASE_COLUMNS = [
    "tpid", "eapid", "email_address", "expuserid", "first_name", "mer_status", "lang_id",
    "last_name", "locale", "paid", "test_keys",
]


def campaign_slots(campaigns: DataFrame, templates: DataFrame, seg_map: DataFrame) -> DataFrame:
    """Campaign, its live template rows and their live segment-module rows."""
    return campaigns.join(
        templates.where(F.col("template_deleted_flag") == 0), "template_id"
    ).join(seg_map.where(F.col("seg_mod_deleted_flag") == 0), "segment_module_map_id")


def campaign_metadata(
    campaigns: DataFrame,
    templates: DataFrame,
    seg_map: DataFrame,
    modules: DataFrame,
    segments: DataFrame,
) -> DataFrame:
    """Campaign, template, segment map, module and active inner segment.

    The configuration side is left to the optimizer: it is broadcast while its measured
    size is under the session's threshold and sort-merge joined beyond it.
    """
    sendable = modules.where(F.col("status").isin(ACTIVE, TEST_ONLY))
    return (
        campaign_slots(campaigns, templates, seg_map)
        .join(sendable, MODULE_KEY)
        .join(active_segments(segments), SEGMENT_KEY, "left_semi")
    )


def placed_slots(campaigns: DataFrame, templates: DataFrame, seg_map: DataFrame, segments: DataFrame) -> DataFrame:
    """Campaign slots whose inner segment is active: the places modules compete for."""
    return campaign_slots(campaigns, templates, seg_map).join(active_segments(segments), SEGMENT_KEY, "left_semi")


def placed_modules(modules: DataFrame, slots: DataFrame) -> DataFrame:
    """The modules that some slot can show, one row each: what the metadata says of modules
    without repeating it for every campaign."""
    sendable = modules.where(F.col("status").isin(ACTIVE, TEST_ONLY))
    return sendable.join(slots.select(*MODULE_KEY).distinct(), MODULE_KEY, "left_semi")


def modules_with_variables(variables: DataFrame) -> DataFrame:
    """The modules that `module_info` tells of, without parsing what they show."""
    return variables.where(F.col("var_position").isNotNull()).select(*POS, "module_id").distinct()


def module_families(placed: DataFrame, info: DataFrame) -> DataFrame:
    """One row per MODULE_KEY, status and version, with the smallest module id of those that
    have variables, NULL if none has. Whatever counts or ranks versions sees the same in it
    as in all modules, so campaigns are joined with versions and never with each module."""
    shown = info.select(*POS, "module_id").distinct().withColumn("_shown", F.lit(True))
    return (
        placed.join(shown, [*POS, "module_id"], "left")
        .groupBy(*MODULE_KEY, "status", "version")
        .agg(F.min(F.when(F.col("_shown"), F.col("module_id"))).alias("module_id"))
    )


def factored_metadata(slots: DataFrame, families: DataFrame) -> DataFrame:
    """The campaign metadata with a row per version in place of a row per module. It grows
    with campaigns times the slots and versions of a template, whatever the number of
    modules."""
    return slots.join(families, MODULE_KEY)


def active_only(meta: DataFrame) -> DataFrame:
    return meta.where(F.col("status") == ACTIVE)


def version_count(active: DataFrame) -> DataFrame:
    """Distinct versions of a module type and placement, over all campaigns of the point
    of sale. A slot may hold fewer, and the rotation then passes the type over."""
    return active.groupBy(*VERSION_KEY).agg(F.count_distinct("version").cast("int").alias("ttl_versions"))


def module_versions(modules: DataFrame) -> DataFrame:
    """One row per MODULE_KEY, status and version: `version_rank` sees the same in the metadata of
    these as in that of all modules, which has a row per campaign, slot and module."""
    return modules.select(*MODULE_KEY, "status", "version").distinct()


def version_rank(meta: DataFrame) -> DataFrame:
    """Versions of each slot renumbered 1..n; the window sees distinct versions only."""
    versions = meta.select(*SLOT_KEY, "version").distinct()
    w = Window.partitionBy(*SLOT_KEY).orderBy("version")
    return versions.withColumn("version_rank", F.dense_rank().over(w))


def ranked_metadata(meta: DataFrame, active: DataFrame) -> DataFrame:
    """Metadata with the rank of each version and the number of versions to rotate over.
    Slots whose type and placement have no active module drop out."""
    slots = active.select(*SLOT_KEY).distinct()
    return (
        meta.join(version_rank(meta), [*SLOT_KEY, "version"])
        .join(version_count(active), VERSION_KEY)
        .join(slots, SLOT_KEY, "left_semi")
    )


def backfill_source(variables: DataFrame) -> DataFrame:
    """Give every variable of a module and connection the join spec stated on one of them;
    the smallest spec if several are stated."""
    key = ["module_id", "source_connection"]
    stated = (
        variables.where(is_present(F.col("var_source")))
        .groupBy(*key)
        .agg(F.min("var_source").alias("var_source"))
    )
    return variables.drop("var_source").join(stated, key, "left")


def module_variables(meta: DataFrame, variables: DataFrame) -> DataFrame:
    return meta.join(variables, ["module_id", *POS], "left")


def module_info(variables: DataFrame) -> DataFrame:
    """One row per module with its variables as an array, in position order.

    An array holds the variables of one module, whose number its template positions bound.
    Join specs and templates are parsed here, once per module and not once per message.
    """
    spec, connection = F.col("var_source"), F.col("source_connection")
    entry = F.struct(
        F.col("var_position").alias("position"),
        connection.alias("connection"),
        spec.alias("spec"),
        parse(F.col("var_structure"), spec_file(spec), connection).alias("parts"),
    )
    return (
        variables.where(F.col("var_position").isNotNull())
        .groupBy(*POS, "module_id")
        .agg(F.array_sort(F.collect_set(entry)).alias("variables"))
    )


def missing_modules(meta: DataFrame, variables: DataFrame) -> DataFrame:
    """Modules used by campaigns that have no variable."""
    return meta.select("module_id").distinct().join(variables, "module_id", "left_anti")


def join_specs(variables: DataFrame) -> DataFrame:
    """Look-up file, its key columns and the columns its templates read, per variable."""
    spec, template = F.col("var_source"), F.coalesce(F.col("var_structure"), F.lit(""))
    parsed = variables.select(
        "module_id",
        "var_position",
        spec_file(spec).alias("file_name"),
        spec_side(spec, 1).alias("left_keys"),
        spec_side(spec, 2).alias("right_keys"),
        spec_columns(template).alias("columns"),
    )
    used = F.col("file_name").isNotNull() & (F.size("right_keys") > 0) & (F.size("columns") > 0)
    return parsed.where(used).distinct()


def needed_columns(variables: DataFrame) -> DataFrame:
    """Traveler columns that join specs and templates read, besides the base columns."""
    spec, template = F.col("var_source"), F.coalesce(F.col("var_structure"), F.lit(""))
    # modules share specs and templates, and each is parsed once
    specs, shown = variables.where(spec.isNotNull()).select("var_source").distinct(), variables.select("var_structure").distinct()
    keys = specs.select(F.explode(spec_side(spec, 1)).alias("column_name"))
    content = shown.select(F.explode(traveler_columns(template)).alias("column_name"))
    return keys.unionByName(content).distinct()


def traveler_columns_to_read(variables: DataFrame) -> list[str]:
    """The base and needed columns as a list, read once while the plan is built so that a
    wide profile table is scanned for these columns alone."""
    extra = sorted(r.column_name for r in needed_columns(variables).collect())
    return BASE_COLUMNS + [c for c in extra if c not in BASE_COLUMNS]


def file_columns(specs: DataFrame) -> dict[str, list[str]]:
    """The key and value columns that the specs (`join_specs`) read of each look-up file, read
    once while the plan is built: one row per file that a spec names."""
    used = F.array_distinct(F.flatten(F.collect_set(F.concat("right_keys", "columns"))))
    per_file = specs.groupBy("file_name").agg(F.array_sort(used).alias("used"))
    return {r.file_name: list(r.used) for r in per_file.collect()}


def stored_columns(stored: DataFrame, column: str) -> list[str]:
    """The column list an upstream run left in a one-row table."""
    return list(stored.select(column).first()[0])


def missing_files(specs: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Look-up files that specs name and the catalogue lacks."""
    return specs.select("file_name").distinct().join(catalogue, "file_name", "left_anti")


def module_count(active: DataFrame, by: tuple[str, ...] = ("campaign_id",)) -> DataFrame:
    return active.groupBy(*by, "audience_name").agg(
        F.count_distinct("slot_position").alias("module_count")
    )


def slot_width(meta_variables: DataFrame) -> DataFrame:
    """Highest variable position of each slot."""
    return meta_variables.groupBy("slot_position").agg(F.max("var_position").alias("var_positions"))


def slot_list(active: DataFrame) -> DataFrame:
    """One row: the slots in order and their number."""
    slots = F.array_sort(F.collect_set("slot_position"))
    return active.agg(slots.alias("slots"), F.size(slots).alias("n_slots"))
