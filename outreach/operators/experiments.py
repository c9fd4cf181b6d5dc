"""Module-type and module-version experiments, and the tags that report them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from outreach.functions.text import rewrite_tag
from outreach.operators.allocation import CONTENT_KEY
from outreach.operators.metadata import campaign_slots
from outreach.operators.skew import sized_join
from outreach.params import EMPTY_MODULE, POS, TEST_ONLY

RETIRED_TEST = "999"

TYPE_TEST = "module type"
VERSION_TEST = "module version"


def of_type(assignments: DataFrame, test_type: str) -> DataFrame:
    return assignments.where(F.col("test_type") == test_type)


def sample_paths(catalogue: DataFrame, locale: str | None = None) -> list[str]:
    """Where the sampled rows of the tests that are not retired lie, of one locale or all. The
    catalogue lists a few rows a test, and the paths make up the plan of the read."""
    listed = catalogue.where(F.col("test_id").cast("string") != RETIRED_TEST)
    if locale is not None:
        listed = listed.where(F.lower("locale") == locale.lower())
    return sorted(r.path for r in listed.where(F.col("path").isNotNull()).select("path").distinct().collect())


def test_module_set(assignments: DataFrame) -> DataFrame:
    """Module types shown to each test key and segment, as a sorted set. A set holds the
    types of the tests of one segment."""
    return of_type(assignments, TYPE_TEST).groupBy(*POS, "test_keys", "segment_type_id").agg(
        F.array_sort(F.collect_set("module_type_id")).alias("module_types")
    )


def expand_test_templates(
    templates: DataFrame, campaigns: DataFrame, seg_map: DataFrame, assignments: DataFrame
) -> DataFrame:
    """Templates plus a copy of each control row for every treatment map id of the same
    test, so that treatment module types get a place in the slot."""
    tests = of_type(assignments, TYPE_TEST)
    arm = F.col("control_test_flag")
    control = tests.where(arm == 0).select("test_id", *POS, "module_type_id").distinct()
    treatment = (
        tests.where(arm != 0)
        .select("test_id", *POS, F.col("segment_module_map_id").alias("_map"))
        .distinct()
    )
    rows = campaign_slots(campaigns, templates, seg_map).select(*templates.columns, *POS, "module_type_id")
    copies = (
        rows.join(control, [*POS, "module_type_id"])
        .join(treatment, ["test_id", *POS])
        .withColumn("segment_module_map_id", F.col("_map"))
        .select(*templates.columns)
        .distinct()
    )
    return templates.unionByName(copies)


def type_test_filter(allocated: DataFrame, assignments: DataFrame) -> DataFrame:
    """Remove module types under test, except those assigned to the traveler's test key
    and segments. A slot that would be left empty keeps its original modules."""
    tests = of_type(assignments, TYPE_TEST)
    tested = tests.select(*POS, "module_type_id").distinct().withColumn("_tested", F.lit(True))
    assigned = tests.select(*POS, "test_keys", "segment_type_id", "module_type_id").distinct()
    segment = F.explode(F.transform(F.split("segment_set", "#"), lambda s: s.cast("int")))
    members = allocated.select(*CONTENT_KEY, *POS).distinct().withColumn("segment_type_id", segment)
    preserved = (
        sized_join(members, assigned, [*POS, "test_keys", "segment_type_id"])
        .groupBy(*CONTENT_KEY).agg(F.collect_set("module_type_id").alias("_kept"))
    )
    slot = Window.partitionBy(*CONTENT_KEY, "slot_position")
    stays = F.col("_tested").isNull() | F.coalesce(F.array_contains("_kept", F.col("module_type_id")), F.lit(False))
    return (
        sized_join(allocated, tested, [*POS, "module_type_id"], "left")
        .join(preserved, CONTENT_KEY, "left")  # rows then lie as the window needs them
        .withColumn("_stays", stays)
        .withColumn("_left", F.count_if("_stays").over(slot))
        .where(F.col("_stays") | (F.col("_left") == 0))
        .select(*allocated.columns)
    )


def campaigns_under_test(assignments: DataFrame, slots: DataFrame) -> DataFrame:
    """Campaigns with a slot for a control row of a type test."""
    control = of_type(assignments, TYPE_TEST).where(F.col("control_test_flag") == 0)
    maps = control.select("segment_module_map_id").distinct()
    return slots.join(maps, "segment_module_map_id", "left_semi").select("campaign_id").distinct()


def running_tests(assignments: DataFrame, slots: DataFrame) -> DataFrame:
    """The assignments, or none if no campaign of the run is under a type test. The condition
    is a subquery of the plan, so nothing is read to build it."""
    return assignments.where(campaigns_under_test(assignments, slots).exists())


def tests_on_campaign(assignments: DataFrame, meta: DataFrame) -> DataFrame:
    """Version-test assignments with the campaigns and slots their modules appear in, for
    tests that appear at all. Control rows have no module and keep NULL there."""
    shown = meta.where(F.col("status") == TEST_ONLY).select(
        "module_id", "campaign_id", "campaign_segment_type_id", "slot_position", "placement_type"
    )
    placed = of_type(assignments, VERSION_TEST).join(shown.distinct(), "module_id", "left")
    appearing = placed.groupBy("test_id").agg(F.count("campaign_id").alias("_places")).where(F.col("_places") > 0)
    return placed.join(appearing, "test_id", "left_semi")


def version_test_replace(allocated: DataFrame, placed_tests: DataFrame, meta: DataFrame) -> DataFrame:
    """Replace a module by the version of the traveler's arm.

    Applies to treatment arms of the same test key, campaign, outer segment, module type
    and slot, for segments the traveler is in, when both modules have the same placement.
    The highest such segment decides.
    """
    key = ["test_keys", "campaign_segment_type_id", "campaign_id", "module_type_id", "slot_position"]
    placement = meta.groupBy("module_id").agg(F.min("placement_type").alias("placement"))
    arms = (
        placed_tests.where(F.col("t_c_flag") != "control")
        .groupBy(*key, "segment_type_id").agg(F.min("module_id").alias("module_id"))
        .join(placement, "module_id")
        .groupBy(*key)
        .agg(F.collect_list(F.struct("segment_type_id", "module_id", "placement")).alias("_arms"))
    )
    own = placement.withColumnRenamed("placement", "_own")
    segments = F.transform(F.split("segment_set", "#"), lambda s: s.cast("int"))
    usable = F.filter(
        "_arms",
        lambda a: F.array_contains(F.col("_segments"), a["segment_type_id"])
        & (a["placement"] == F.col("_own")),
    )
    return (
        allocated.withColumn("_segments", segments)
        .join(own, "module_id", "left")
        .join(arms, key, "left")
        .withColumn("module_id", F.coalesce(F.array_max(usable)["module_id"], F.col("module_id")))
        .select(*allocated.columns)
    )


def add_test_tag(rows: DataFrame, tags: DataFrame, **spread) -> DataFrame:
    """The recipient id with the tag of the row's test key and module code, a code that most
    travelers may share."""
    return (
        sized_join(rows, tags, [*POS, "test_keys", "module_code"], "left", **spread)
        .withColumn("recipient_id", rewrite_tag(F.col("recipient_id"), F.col("test_tag")))
        .drop("test_tag")
    )


def test_tag(coded: DataFrame, placed_tests: DataFrame, active: DataFrame) -> DataFrame:
    """`test#arm` for each (point of sale, test key, module code).

    A test module in the code decides, with the arm of the test key; otherwise a slot and
    module type under test reports arm 0; otherwise `1#X`. The smallest test id wins.
    Work is done per distinct code, which travelers share, not per traveler.
    """
    key = [*POS, "test_keys", "module_code"]
    entry = F.explode(F.split("module_code", "_"))
    picks = (
        coded.select(*key).distinct().withColumn("_entry", entry)
        .select(
            *key,
            F.split_part("_entry", F.lit("-"), F.lit(1)).cast("int").alias("slot_position"),
            F.split_part("_entry", F.lit("-"), F.lit(2)).cast("int").alias("module_id"),
        )
    )
    filled = picks.where(F.col("module_id") != EMPTY_MODULE)
    by_module = (
        placed_tests.where(F.col("module_id").isNotNull())
        .select(*POS, "module_id", F.col("test_id").alias("_treated")).distinct()
    )
    types = active.groupBy("module_id").agg(F.min("module_type_id").alias("module_type_id"))
    by_slot = (
        placed_tests.where(F.col("slot_position").isNotNull())
        .groupBy(*POS, "slot_position", "module_type_id").agg(F.min("test_id").alias("_control"))
    )
    arms = placed_tests.groupBy(*POS, "test_id", "test_keys").agg(
        F.min("control_test_flag").alias("_arm")
    )
    found = (
        filled.join(by_module, [*POS, "module_id"], "left")
        .join(types, "module_id", "left")
        .join(by_slot, [*POS, "slot_position", "module_type_id"], "left")
        .groupBy(*key).agg(F.min("_treated").alias("test_id"), F.min("_control").alias("_control"))
        .join(arms, [*POS, "test_id", "test_keys"], "left")
    )
    tag = (
        F.when(F.col("test_id").isNotNull(), F.concat_ws("#", "test_id", F.col("_arm").cast("string")))
        .when(F.col("_control").isNotNull(), F.concat(F.col("_control").cast("string"), F.lit("#0")))
        .otherwise(F.lit("1#X"))
    )
    tagged = found.select(*key, tag.alias("test_tag"))
    return (
        coded.select(*key).distinct().join(tagged, key, "left")
        .withColumn("test_tag", F.coalesce("test_tag", F.lit("1#X")))
    )
