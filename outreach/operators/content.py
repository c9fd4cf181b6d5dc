"""Look-up tables and rendered content."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outreach.functions import templates as T
from outreach.functions.text import spec_file, spec_side
from outreach.operators.allocation import CONTENT_KEY, meet_campaigns
from outreach.operators.skew import sized_join, spread_join
from outreach.params import POS, SUPPRESSED

RENDER_ROWS = 20_000  # rows that one task renders


def only_read(files: dict[str, DataFrame], used: dict[str, list[str]]) -> dict[str, DataFrame]:
    """The look-up tables that specs name, cut to the columns that they read. The other
    tables are left out of the plan and never scanned."""
    return {
        name: df.select(*[c for c in df.columns if c in {*POS, *used[name]}])
        for name, df in files.items() if name in used
    }


def attribute_map(columns: list[str]) -> Column:
    """The traveler columns that templates and specs may read, as map<string,string>."""
    entries = [x for c in columns for x in (F.lit(c), F.col(c).cast("string"))]
    return F.create_map(*entries)


def distinct_specs(variables: DataFrame) -> DataFrame:
    """The join specs that name a look-up file, per point of sale."""
    spec = F.col("var_source")
    return (
        variables.select(
            *POS, spec.alias("spec"), spec_file(spec).alias("file"),
            spec_side(spec, 1).alias("left_keys"), spec_side(spec, 2).alias("right_keys"),
        )
        .where(F.col("file").isNotNull())
        .distinct()
    )


def _key_values(values: Column, names: Column) -> Column:
    """Values of the named columns as an array, NULL if any is missing. An array keeps
    the keys (1, 23) and (12, 3) apart."""
    key = F.transform(names, lambda c: F.element_at(values, c))
    return F.when(~F.exists(key, lambda v: v.isNull()), key)


def content_rows(files: dict[str, DataFrame], specs: DataFrame) -> DataFrame:
    """All look-up tables in one shape: point of sale, spec, key values, and the value
    columns as a map. Where a key repeats, the smallest value of each column wins."""
    shaped = [specs.where(F.lit(False)).select(*POS, "file", F.lit(None).cast("map<string,string>").alias("values"))]
    for name, df in files.items():
        columns = [c for c in df.columns if c not in POS]
        shaped.append(df.select(*POS, F.lit(name).alias("file"), attribute_map(columns).alias("values")))
    rows = reduce(lambda a, b: a.unionByName(b), shaped)
    return (
        sized_join(rows, specs, [*POS, "file"])
        .select(*POS, "spec", _key_values(F.col("values"), F.col("right_keys")).alias("key"), F.explode("values"
                ).alias("column", "value"))
        .where(F.col("key").isNotNull() & F.col("value").isNotNull())
        .groupBy(*POS, "spec", "key", "column")
        .agg(F.min("value").alias("value"))
        .groupBy(*POS, "spec", "key")
        # one entry per column of the look-up table
        .agg(F.map_from_entries(F.collect_list(F.struct("column", "value"))).alias("looked_up"))
    )


def look_up(
    profiles: DataFrame, columns: list[str], specs: DataFrame, files: dict[str, DataFrame], **spread
) -> DataFrame:
    """Every distinct profile with each spec of its point of sale and the row found, if any."""
    content = content_rows(files, specs)
    wanted = (
        profiles.select(*POS, *columns).distinct()
        .withColumn("attributes", attribute_map(columns))
    )
    wanted = (
        sized_join(wanted, specs, POS, "left")
        .withColumn("key", _key_values(F.col("attributes"), F.col("left_keys")))
    )
    # profiles are distinct, and a look-up row is shared by those with the same key values
    return spread_join(wanted, content, [*POS, "spec", "key"], "left", **spread).select(
        *POS, *columns, "attributes", "spec", "file", "looked_up"
    )


def profile_look_ups(looked_up: DataFrame, columns: list[str]) -> DataFrame:
    """One row per profile: its attributes, and spec -> looked-up row; the specs bound the map.

    The attribute map is carried along, so that rendering reads it and does not build it
    once per template part.
    """
    found = F.filter(
        F.collect_list(F.struct("spec", "looked_up")), lambda e: e["looked_up"].isNotNull()
    )
    return looked_up.groupBy(*POS, *columns).agg(
        F.any_value("attributes").alias("attributes"), F.map_from_entries(found).alias("look_ups")
    )


def fill_variables(variables: Column, attributes: Column, look_ups: Column) -> Column:
    """The `variables` array with values: (position, filled parts)."""
    return F.transform(
        variables,
        lambda v: F.struct(
            v["position"].alias("position"),
            T.fill(v["parts"], attributes, F.element_at(look_ups, v["spec"])).alias("filled"),
        ),
    )


def variable_cells(
    filled: Column, test_key: Column, seed: Column, slot: Column, legacy_null_words: bool = False
) -> Column:
    """Array of (position, value, option, failed) for the filled variables of one module.

    The chain of transforms names each intermediate once, so it is evaluated once.
    """
    def is_subject(x: Column) -> Column:
        return (slot == 1) & (x["position"] == 1)

    split = F.transform(
        filled,
        lambda v: F.struct(
            v["position"].alias("position"), T.options(T.text_of(v["filled"])).alias("parts")
        ),
    )
    chosen = F.transform(
        split,
        lambda x: F.struct(
            x["position"].alias("position"),
            F.get(x["parts"], F.lit(0)).alias("default"),
            F.when(
                F.size(x["parts"]) > 1, T.option_index(F.size(x["parts"]), test_key, seed).cast("string")
            ).otherwise("default").alias("option"),
            T.choose(x["parts"], test_key, seed, is_subject(x)).alias("value"),
        ),
    )
    judged = F.transform(
        chosen,
        lambda x: F.struct(
            x["position"].alias("position"), x["default"].alias("default"),
            x["option"].alias("option"), x["value"].alias("value"),
            T.is_unresolved(x["value"], legacy_null_words).alias("failed"),
        ),
    )
    return F.transform(
        judged,
        lambda x: F.struct(
            x["position"].alias("position"),
            F.when(~x["failed"], x["value"])
            .when(is_subject(x), x["default"]).otherwise("None").alias("value"),
            F.when(x["failed"], "default").otherwise(x["option"]).alias("option"),
            x["failed"].alias("failed"),
        ),
    )


def variable_attributes(filled: Column) -> Column:
    """Array of (position, name, value) for the tokens of one module that have a value."""
    def of_variable(v: Column) -> Column:
        tokens = F.filter(v["filled"], lambda p: p["name"].isNotNull() & T.is_attribute(p["value"]))
        return F.transform(
            tokens,
            lambda p: F.struct(
                v["position"].alias("position"), p["name"].alias("name"), p["value"].alias("value")
            ),
        )

    return F.flatten(F.transform(filled, of_variable))


def described_modules(allocated: DataFrame, modules: DataFrame, info: DataFrame) -> DataFrame:
    """Traits and variables of the modules that are allocated. Modules without variables cannot be
    shown and drop out with the join."""
    key = [*POS, "module_id"]
    traits = modules.select(*key, "placement_type", "module_type", "default_flag").distinct()
    used = allocated.select(*key).distinct()
    return traits.join(used, key, "left_semi").join(info.join(used, key, "left_semi"), key)


def offered_lists(allocated: DataFrame, described: DataFrame) -> DataFrame:
    """One row per content key with its modules as a sorted list of ids and places; slots, types
    and priorities bound it. Keys with the same list share its digest, `offer`."""
    key = [*POS, "module_id"]
    entry = F.struct(
        F.col("slot_position").alias("slot"), F.col("module_priority_in_slot").alias("priority"),
        *key, "module_type_id",
    )
    shown = sized_join(allocated, described.select(*key).distinct(), key, "left_semi")
    lists = shown.groupBy(*CONTENT_KEY).agg(F.array_sort(F.collect_list(entry)).alias("listed"))
    return lists.withColumn("offer", F.sha2(F.to_json("listed"), 256))


def candidate_arrays(offers: DataFrame, described: DataFrame) -> DataFrame:
    """One row per list of `offered_lists` with its candidates. Texts are attached to distinct
    lists, which content keys share, and not to each content key."""
    lists = offers.select("offer", "listed").distinct().select("offer", F.inline("listed"))
    entry = F.struct(
        "slot", "priority", "module_id", "module_type_id", "placement_type", "default_flag", "variables",
    )
    return (
        sized_join(lists, described, [*POS, "module_id"])
        .groupBy("offer")
        .agg(F.collect_list(entry).alias("candidates"))
    )


def distinct_content(base: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct inputs of rendering: travelers who share them share the result."""
    return base.select(*POS, *columns, *CONTENT_KEY, "priority").distinct()


def content_kinds(members: DataFrame, campaigns: DataFrame, columns: list[str]) -> DataFrame:
    """`distinct_content` of members and campaigns without joining people with campaigns: the
    distinct profiles of an outer segment meet its campaigns."""
    kinds = members.select(*POS, *columns, "test_keys", "segment_set", "campaign_segment_type_id").distinct()
    return distinct_content(meet_campaigns(kinds, campaigns), columns)


def content_with_offers(content: DataFrame, offers: DataFrame, **spread) -> DataFrame:
    """Content with the list its key is offered. Files of keys are far smaller than their rows,
    and the size of the files must not have them copied whole: they are merged."""
    return spread_join(content, offers.select(*CONTENT_KEY, "offer").hint("merge"), CONTENT_KEY, **spread)


def content_alike(content: DataFrame, columns: list[str], rows: int) -> DataFrame:
    """Content that looks the same, one row each: same profile, test key, priority and list of
    candidates. `alike` holds the campaigns and segment sets that show it. The rows are few bytes
    and much work, so they are shared out by their number, `rows` at most, and not by their size."""
    key = [*POS, *columns, "test_keys", "priority", "offer"]
    return content.repartition(ceil((rows + 1) / RENDER_ROWS), *key).groupBy(*key).agg(F.collect_list(F.struct("campaign_id", "segment_set")).alias("alike"))


def for_alike(rows: DataFrame) -> DataFrame:
    """Rows of `content_alike`, repeated for each campaign and segment set that shows them."""
    return rows.select(*[c for c in rows.columns if c != "alike"], F.inline("alike"))


def content_with_candidates(content: DataFrame, candidates: DataFrame, **spread) -> DataFrame:
    """Content with what is told of its list, whose texts are measured and not the size of files."""
    return sized_join(content, candidates, ["offer"], **spread)


def render_candidates(
    content: DataFrame,
    look_ups: DataFrame,
    columns: list[str],
    seed: int,
    legacy_null_words: bool = False,
    **spread,
) -> DataFrame:
    """Add `rendered`: each candidate with its cells, attributes and effective priority.

    Content that fails in a hero or banner without default sends the module to 9999.
    Rendering stays inside the row: no explode, no regrouping.
    """
    with_values = spread_join(content, look_ups, [*POS, *columns], null_safe=True, **spread)
    traits = ("slot", "priority", "module_id", "module_type_id", "placement_type", "default_flag")
    filled = F.transform(
        "candidates",
        lambda c: F.struct(
            *[c[f].alias(f) for f in traits],
            fill_variables(c["variables"], F.col("attributes"), F.col("look_ups")).alias("filled"),
        ),
    )
    shown = F.transform(
        filled,
        lambda c: F.struct(
            *[c[f].alias(f) for f in traits],
            variable_cells(
                c["filled"], F.col("test_keys"), F.lit(seed), c["slot"], legacy_null_words
            ).alias("cells"),
            variable_attributes(c["filled"]).alias("attributes"),
        ),
    )

    def unusable(c: Column) -> Column:
        return (
            F.exists(c["cells"], lambda x: x["failed"])
            & c["placement_type"].isin("hero", "banner")
            & (c["default_flag"] == 0)
        )

    priced = F.transform(
        shown,
        lambda c: F.struct(
            c["slot"].alias("slot"),
            F.when(unusable(c), SUPPRESSED).otherwise(c["priority"]).alias("priority"),
            *[c[f].alias(f) for f in ("module_id", "module_type_id", "placement_type",
                                      "default_flag", "cells", "attributes")],
        ),
    )
    return with_values.withColumn("rendered", priced).drop("candidates", "look_ups", "attributes")
