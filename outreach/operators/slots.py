"""Slot winners without repeats, and what is derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outreach.params import ALL_USED, DEFAULT_TEXT, EMPTY_MODULE, NO_CANDIDATE, SUPPRESSED

CELL = "array<struct<position:int,value:string,option:string,failed:boolean>>"
ATTRIBUTE = "array<struct<position:int,name:string,value:string>>"
SHOWN = "array<struct<name:string,slot:int,position:int,value:string>>"
PICK = (
    "struct<slot:int,module_id:int,module_type_id:int,priority:int,fill_reason:string,"
    f"campaign_priority:int,cells:{CELL},attributes:{ATTRIBUTE}>"
)


def _null(sql_type: str) -> Column:
    return F.lit(None).cast(sql_type)


def _pick(c: Column, campaign_priority: Column) -> Column:
    """The pick a winning candidate makes; an unusable banner empties the slot, an
    unusable hero suppresses the campaign for this content."""
    spent = (c["priority"] == SUPPRESSED) & (c["default_flag"] == 0)
    banner = spent & (c["placement_type"] == "banner")
    hero = spent & (c["placement_type"] == "hero")
    blank = F.transform(
        c["cells"],
        lambda x: F.struct(
            x["position"].alias("position"), F.lit(DEFAULT_TEXT).alias("value"),
            x["option"].alias("option"), x["failed"].alias("failed"),
        ),
    )
    return F.struct(
        c["slot"].alias("slot"),
        F.when(banner, EMPTY_MODULE).otherwise(c["module_id"]).alias("module_id"),
        c["module_type_id"].alias("module_type_id"),
        c["priority"].alias("priority"),
        _null("string").alias("fill_reason"),
        F.when(hero, SUPPRESSED).otherwise(campaign_priority).alias("campaign_priority"),
        F.when(banner, blank).otherwise(c["cells"]).alias("cells"),
        F.when(banner, _null(ATTRIBUTE)).otherwise(c["attributes"]).alias("attributes"),
    ).cast(PICK)


def _empty_pick(slot: Column, reason: Column, campaign_priority: Column) -> Column:
    return F.struct(
        slot.cast("int").alias("slot"),
        F.lit(EMPTY_MODULE).alias("module_id"),
        _null("int").alias("module_type_id"),
        _null("int").alias("priority"),
        reason.alias("fill_reason"),
        campaign_priority.alias("campaign_priority"),
        _null(CELL).alias("cells"),
        _null(ATTRIBUTE).alias("attributes"),
    ).cast(PICK)


def slot_winners(rendered: Column, slots: Column, campaign_priority: Column) -> Column:
    """One pick per slot, in slot order, no module twice.

    A fold over the candidates sorted by (slot, priority, module): the first one whose
    slot is open and whose module is unused wins. Slots left open become module 999, with
    the reason. The fill-in is the fold's last step, so the fold is evaluated once.
    """
    def step(picks: Column, c: Column) -> Column:
        open_slot = ~F.exists(picks, lambda p: p["slot"] == c["slot"])
        unused = ~F.exists(picks, lambda p: p["module_id"] == c["module_id"])
        return F.when(
            open_slot & unused, F.concat(picks, F.array(_pick(c, campaign_priority)))
        ).otherwise(picks)

    def reason(s: Column) -> Column:
        return F.when(F.exists(rendered, lambda c: c["slot"] == s), ALL_USED).otherwise(NO_CANDIDATE)

    def fill(picks: Column) -> Column:
        return F.transform(
            slots,
            lambda s: F.coalesce(
                F.get(F.filter(picks, lambda p: p["slot"] == s), F.lit(0)),
                _empty_pick(s, reason(s), campaign_priority),
            ),
        )

    return F.aggregate(F.array_sort(rendered), F.array().cast(f"array<{PICK}>"), step, fill)


def pick_slots(content: DataFrame, slots: DataFrame) -> DataFrame:
    """Add `picks` (one per slot of the run) and `campaign_priority`, their maximum.

    `slots` is the one-row frame of `metadata.slot_list`.
    """
    filled = content.withColumn("_slots", slots.select("slots").scalar()).withColumn(
        "picks", slot_winners(F.col("rendered"), F.col("_slots"), F.col("priority"))
    )
    worst = F.array_max(F.transform("picks", lambda p: p["campaign_priority"]))
    return filled.withColumn("campaign_priority", worst).drop("rendered", "_slots")


def module_code(picks: Column) -> Column:
    """`slot-module_slot-module_...` over the slots in order."""
    return F.array_join(
        F.transform(picks, lambda p: F.concat_ws("-", p["slot"].cast("string"), p["module_id"].cast("string"))),
        "_",
    )


def slot_module(picks: Column, slot: int) -> Column:
    return F.get(F.filter(picks, lambda p: p["slot"] == slot), F.lit(0))["module_id"]


def subject_line(picks: Column) -> Column:
    """Text of position 1 of slot 1; `None` when the slot is empty."""
    first = F.get(F.filter(picks, lambda p: p["slot"] == 1), F.lit(0))
    cell = F.get(F.filter(first["cells"], lambda x: x["position"] == 1), F.lit(0))
    return F.coalesce(cell["value"], F.lit(DEFAULT_TEXT))


def option_text(pick: Column) -> Column:
    """`#S1_P1.0#S1_P2.default`: the option shown at each position of a slot."""
    slot = pick["slot"].cast("string")
    shown = F.transform(
        pick["cells"],
        lambda x: F.concat(F.lit("#S"), slot, F.lit("_P"), x["position"].cast("string"), F.lit("."), x["option"]),
    )
    return F.coalesce(pick["fill_reason"], F.array_join(shown, ""))


def dynamic_content(picks: Column) -> Column:
    """JSON of the attributes shown by the picked modules, names in order. Where a name
    repeats, the highest slot and position wins, so the map has no duplicate keys."""
    shown = F.flatten(
        F.transform(
            F.filter(picks, lambda p: (p["module_id"] != EMPTY_MODULE) & p["attributes"].isNotNull()),
            lambda p: F.transform(
                p["attributes"],
                lambda a: F.struct(
                    a["name"].alias("name"), p["slot"].alias("slot"),
                    a["position"].alias("position"), a["value"].alias("value"),
                ),
            ),
        )
    )
    def keep_last(kept: Column, a: Column) -> Column:
        again = F.coalesce(F.get(kept, F.size(kept) - 1)["name"] == a["name"], F.lit(False))
        return F.concat(F.when(again, F.slice(kept, 1, F.size(kept) - 1)).otherwise(kept), F.array(a))

    last = F.aggregate(F.array_sort(shown), F.array().cast(SHOWN), keep_last)
    entries = F.transform(last, lambda a: F.struct(a["name"].alias("key"), a["value"].alias("value")))
    return F.to_json(F.map_from_entries(entries))


def slot_columns(df: DataFrame, slots: list[int]) -> DataFrame:
    """Spread picks into the output columns of each of the slots, whatever their numbers."""
    out = df
    for s in slots:
        pick = F.get(F.filter("picks", lambda p: p["slot"] == s), F.lit(0))
        out = (
            out.withColumn(f"S{s}_module_id", pick["module_id"])
            .withColumn(f"S{s}_module_type_id", F.coalesce(pick["module_type_id"].cast("string"), pick["fill_reason"]))
            .withColumn(f"S{s}_module_priority", F.coalesce(pick["priority"].cast("string"), pick["fill_reason"]))
            .withColumn(f"S{s}_att_option", option_text(pick))
        )
    return out


def campaign_modules(rows: DataFrame) -> DataFrame:
    """Distinct modules each campaign uses, over all its slots, by site if the rows have one."""
    site = ["site"] if "site" in rows.columns else []
    return rows.select(
        *site, "campaign_id", F.explode(F.transform("picks", lambda p: p["module_id"])).alias("module_id")
    ).distinct()
