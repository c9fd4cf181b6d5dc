"""The registered queries: one per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outreach.functions import dates as D
from outreach.functions import templates as T
from outreach.functions import text as X
from outreach.operators import allocation, arbitration, checks, content, eligibility, enrichment
from outreach.operators import experiments, metadata, sampling, slots
from outreach.operators.skew import consecutive_ids, sized_join, spread_join
from outreach.params import POS, RunParams
from outreach.plans.daily import Decisions, Inputs
from outreach.sources import runs, sinks, tables
from outreach.sources.staging import stage, stage_path
from outreach.workload.fixtures import CONTENT_COLUMNS, RUN, DemotingDomain, Domain

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
KEY = allocation.CONTENT_KEY


def query(build: Callable[[Domain], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Domain(spark, sf_dir))

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    REGISTRY[build.__name__] = run
    return build


def stamp(c, fmt: str = "yyyy-MM-dd HH:mm:ss"):
    return F.date_format(c, fmt)


def decisions(d: Domain, run: RunParams = RUN) -> Decisions:
    return Decisions(
        Inputs(
            campaigns=d.campaign.drop("id"),
            manual=d.manual_launch,
            segments=d.segment,
            templates=d.template,
            seg_map=d.segment_module_map,
            modules=d.module,
            variables=d.module_variable,
            travelers=d.traveler,
            traveler_segments=d.traveler_segment,
            recent=[
                eligibility.recent_notified(d.notification, d.notified_as_of),
                eligibility.recent_booked(d.booking, d.booked_as_of),
            ],
            assignments=d.test_assignment,
            files={"content": d.content},
            columns=CONTENT_COLUMNS,
        ),
        run,
    )


def ready_campaigns(d: Domain) -> DataFrame:
    live = eligibility.live_campaigns(d.campaign, RUN.run_date)
    return eligibility.demote_dead(live, d.segment)


def outer_campaigns(d: Domain) -> DataFrame:
    return ready_campaigns(d).select("campaign_segment_type_id", "campaign_id", "priority", *POS)


def segment_profiles(d: Domain, travelers: DataFrame) -> DataFrame:
    """Travelers with each outer segment they are in."""
    outer = d.traveler_segment.withColumnRenamed("segment_type_id", "campaign_segment_type_id")
    return allocation.join_profile(outer, travelers)


def campaign_rows(profiles: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Profiles with the campaigns of their segments: the last step, which shuffles no pair."""
    return allocation.traveler_campaign(profiles, campaigns).withColumnRenamed("priority", "campaign_priority")


def profile_rows(
    d: Domain,
    choose: Callable[[DataFrame], DataFrame] = lambda campaigns: campaigns,
    tell: Callable[[DataFrame], DataFrame] = lambda people: people,
) -> DataFrame:
    """Opted-in travelers with every live campaign of their segments, or the campaigns chosen;
    `tell` adds what is worked out per person."""
    travelers = eligibility.eligible_travelers(d.traveler, "marketing")
    return campaign_rows(tell(segment_profiles(d, travelers)), choose(outer_campaigns(d).distinct()))


def recipients(d: Domain) -> DataFrame:
    """The best live campaign of each address, without choosing content."""
    rows = arbitration.keep_best(stage(profile_rows(d, arbitration.contenders)))
    return arbitration.dedupe_recipient(
        rows.where(F.col("campaign_priority") != 9999), ["campaign_id", "user_id", "segment_set"]
    )


# Scans and sources -----------------------------------------------------------------


@query
def scan_pushdown(d):
    return d.raw("orders").where(
        (F.col("o_totalprice") > 100000) & (F.col("o_orderpriority") == "1-URGENT")
    ).select("o_orderkey", "o_custkey", "o_totalprice")


@query
def scan_parquet_pruned(d):
    return d.raw("customer").where(F.col("c_acctbal") > 0).select("c_custkey", "c_mktsegment")


@query
def scan_csv(d):
    path = stage_path(d.spark)
    rows = d.campaign.select("campaign_id", "locale", "audience_name")
    rows.write.option("header", True).csv(path)
    return tables.read_csv(d.spark, path, rows.schema).distinct()


@query
def scan_multi_path(d):
    done, failed = stage_path(d.spark), stage_path(d.spark)
    d.run_log.where(F.col("is_complete") == 1).write.parquet(done)
    d.run_log.where(F.col("is_complete") == 0).write.parquet(failed)
    log = tables.read_many(d.spark, [done, failed], d.run_log.schema)
    return log.groupBy("source_name", "is_complete").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def load_config_set(d):
    found = tables.load_config_set(d.spark, ["supplier", "nation"], d.source, surrogate="s_acctbal")
    s, n = found["supplier"], found["nation"]
    return s.join(n, s.s_nationkey == n.n_nationkey)


@query
def latest_run(d):
    return runs.latest_run(d.run_log, "purchase")


@query
def latest_run_by_end(d):
    return runs.latest_run(d.run_log, "view", by="end_date")


@query
def latest_batch(d):
    return runs.latest_batch(d.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate"), "o_orderdate").select(
        "o_orderkey", "o_custkey"
    )


@query
def run_log_rows(d):
    done = F.col("is_complete") == 1
    rows = runs.run_log_rows(
        d.run_log,
        status=F.when(done, "Row ID created").otherwise("Failed"),
        error=F.when(done, " ").otherwise("Error"),
        row_counts=F.when(done, F.col("row_counts")).otherwise(0),
    )
    return rows.withColumns({c: stamp(F.col(c)) for c in ("start_date", "end_date")})


@query
def flag_gate(d):
    flag = d.test_assignment.agg(F.max((F.col("control_test_flag") > 0).cast("int")).alias("flag"))
    return eligibility.gate(d.campaign, flag).select("campaign_id", "priority")


# Campaign eligibility --------------------------------------------------------------


@query
def live_campaigns(d):
    return eligibility.live_campaigns(d.campaign, RUN.run_date).select("campaign_id", "tpid", "priority")


@query
def live_campaigns_program(d):
    return eligibility.live_campaigns(
        d.campaign, RUN.run_date, program_type="EML..PROG1.CODE0.INTENT"
    ).select("campaign_id", "program_type")


@query
def pos_filter(d):
    pos = eligibility.pos_of(eligibility.live_campaigns(d.campaign, RUN.run_date))
    return eligibility.at_pos(d.module, pos).select("module_id", "locale")


@query
def status_filter(d):
    return d.module.where(F.col("status").isin("test published", "active published")).select(
        "module_id", "status"
    )


@query
def semi_in_list(d):
    return eligibility.of_campaigns(d.traveler_segment, ready_campaigns(d)).select(
        "email_address", "test_keys", "segment_type_id"
    )


@query
def manual_campaign(d):
    """The campaigns of a manual test send: of the day's campaigns the one asked for, here the
    first that was not launched by hand."""
    automatic = eligibility.drop_manual_launches(
        eligibility.live_campaigns(d.campaign, RUN.run_date), d.manual_launch
    )
    asked = automatic.agg(F.min("campaign_id")).first()[0]
    manual = replace(RUN, job_type="test", test_type="MANUAL", campaign_id=asked)
    return decisions(d, manual).campaigns.select("campaign_id", "locale", "priority")


@query
def anti_manual_launch(d):
    return eligibility.drop_manual_launches(d.campaign, d.manual_launch).select("campaign_id", "locale")


@query
def dead_segments(d):
    return eligibility.dead_segments(eligibility.live_campaigns(d.campaign, RUN.run_date), d.segment)


@query
def demote_dead(d):
    return eligibility.demote_dead(d.campaign, d.segment).select("campaign_id", "priority")


@query
def program_parts(d):
    return sinks.with_program_parts(d.campaign).select(
        "campaign_id", "subchannel", "program", "campaign_code", "lob_intent"
    )


@query
def date_compact(d):
    return d.campaign.select(
        "campaign_id", D.compact_date(F.col("launch_date")).alias("campaign_date"),
        D.issue_id(F.col("launch_time_utc")).alias("issue_id"),
    )


@query
def locale_gate(d):
    return sinks.pick_schedule(d.schedule, d.job_schedule, d.enabled_locale).withColumn(
        "scheduled_launch_time", stamp(F.col("scheduled_launch_time"))
    )


@query
def missing_schedule(d):
    return checks.missing_schedule(d.campaign, d.schedule)


@query
def audience_master(d):
    return sinks.audience_master(d.campaign, "prod", F.lit("2001-08-01 06:00:00"))


@query
def audience_master_second_run(d):
    """A later run over the campaigns of both days, after one for the second day only."""
    moment = F.lit("2001-08-01 06:00:00")
    second_day = d.campaign.where(F.col("launch_date") != F.lit(RUN.run_date))
    stored = stage(sinks.audience_master(second_day, "prod", moment))
    return sinks.audience_master(d.campaign, "prod", moment, stored).select("campaign_id", "campaign_date", "locale", "sid")


# Traveler eligibility --------------------------------------------------------------


def _both(build, history, as_of):
    return build(history, as_of).withColumn("strict", F.lit(0)).unionByName(
        build(history, as_of, strict=True).withColumn("strict", F.lit(1))
    )


@query
def recent_notified(d):
    return _both(eligibility.recent_notified, d.notification, d.notified_as_of)


@query
def recent_booked(d):
    return _both(eligibility.recent_booked, d.booking, d.booked_as_of)


@query
def eligible_travelers(d):
    return eligibility.eligible_travelers(d.traveler, "marketing").select("user_id", "email_address")


@query
def suppress_recent(d):
    return eligibility.suppress_recent(
        d.traveler,
        eligibility.recent_notified(d.notification, d.notified_as_of),
        eligibility.recent_booked(d.booking, d.booked_as_of),
    ).select("user_id", "email_address", "tpid", "eapid")


@query
def union_all(d):
    contacts = d.notification.select("email_address", "tpid", "eapid").unionByName(
        d.booking.select("email_address", "tpid", "eapid")
    )
    return contacts.groupBy("email_address", "tpid", "eapid").agg(F.count(F.lit(1)).alias("n_contacts"))


# Projections, filters and set operations -------------------------------------------


@query
def output_projection(d):
    rows = d.traveler.select(
        *POS, "email_address", "first_name", "mer_status", "paid", "city", F.lit("x").alias("authrealm_id")
    )
    return enrichment.output_projection(rows, ["city"], "authrealm")


@query
def normalize_strings(d):
    city, seg = F.col("city"), F.col("mktsegment")
    return d.traveler.select(
        "user_id",
        F.lower("first_name").alias("name_lower"),
        F.upper("locale").alias("locale_upper"),
        F.split_part("email_address", F.lit("@"), F.lit(1)).alias("mailbox"),
        F.concat(city, F.lit("#"), seg).alias("pair_strict"),
        F.concat_ws("#", city, seg).alias("pair_skipping"),
        F.replace(city, F.lit("_"), F.lit(" ")).alias("city_text"),
        F.contains(city, F.lit("1")).alias("has_one"),
        F.startswith(seg, F.lit("B")).alias("starts_b"),
        X.blank_to_null(F.trim(F.concat(F.lit(" "), seg, F.lit(" ")))).alias("trimmed"),
    )


@query
def none_to_null(d):
    rows = d.traveler.select(
        "user_id", "test_keys", F.coalesce("city", F.lit("None")).alias("city"), "mktsegment"
    )
    return enrichment.none_to_null(rows)


@query
def filter_present(d):
    return d.traveler.where(X.is_present(F.col("city")) & F.col("paid").isNotNull()).select("user_id", "city")


@query
def filter_like(d):
    return d.raw("part").where(
        F.col("p_name").like("%ring%") & ~F.col("p_brand").like("Brand#1%")
    ).select("p_partkey", "p_name", "p_brand")


@query
def distinct_rows(d):
    return d.traveler.select(*POS, "city", "mktsegment").distinct()


@query
def set_except(d):
    seen = d.traveler.where(F.col("city").isNotNull()).select(*POS, "city")
    return seen.subtract(d.content.where(F.col("best").isNotNull()).select(*POS, "city"))


@query
def set_intersect(d):
    wanted = ready_campaigns(d).select(*POS, F.col("campaign_segment_type_id").alias("segment_type_id"))
    return d.traveler_segment.select(*POS, "segment_type_id").intersect(wanted)


# Dates -----------------------------------------------------------------------------


@query
def rotation_seed(d):
    day = F.to_date("o_orderdate")
    return d.raw("orders").select(day.alias("day")).distinct().select(
        stamp(F.col("day"), "yyyy-MM-dd").alias("day"), D.rotation_seed(F.col("day")).alias("seed")
    )


@query
def tz_shift(d):
    ts = F.col("start_date")
    return d.run_log.select(
        "log_id", stamp(D.in_zone(ts)).alias("pacific"), stamp(D.in_zone(ts, D.INDIA)).alias("india")
    )


@query
def launch_date(d):
    return d.run_log.select("log_id", stamp(D.launch_date(F.col("start_date")), "yyyy-MM-dd").alias("launch_date"))


# Matching --------------------------------------------------------------------------


@query
def traveler_campaign(d):
    return allocation.traveler_campaign(d.traveler_segment, outer_campaigns(d)).select(
        "email_address", "test_keys", "campaign_id", "campaign_segment_type_id", "segment_set", "priority"
    )


@query
def traveler_profile_join(d):
    return profile_rows(d).select("user_id", "campaign_id", "campaign_segment_type_id", "city", "campaign_priority")


@query
def campaign_rank(d):
    return arbitration.keep_best(stage(profile_rows(d, arbitration.contenders))).select(
        "email_address", "user_id", "campaign_id", "campaign_priority"
    )


@query
def dedupe_recipient(d):
    return arbitration.dedupe_recipient(
        profile_rows(d, arbitration.contenders), ["campaign_priority", "campaign_id", "user_id"]
    ).select("email_address", "paid", "campaign_id", "user_id")


@query
def campaign_head(d):
    profiles = segment_profiles(d, eligibility.eligible_travelers(d.traveler, "marketing"))
    heads = arbitration.segment_heads(profiles, 3, ["user_id"])
    rows = campaign_rows(stage(heads), outer_campaigns(d).distinct())
    return arbitration.campaign_head(rows, 3, ["user_id"]).select(
        "campaign_id", "test_keys", "user_id"
    )


@query
def output_name(d):
    modes = [("prod", None), ("test", "MANUAL"), ("test", "AUTOTEST"), ("test", "BACKUP"), ("test", "PILOT")]
    name, day = F.col("audience_name"), F.col("launch_date")
    names = F.array(*[X.output_name(name, day, job, kind) for job, kind in modes])
    return d.campaign.select("campaign_id", F.explode(names).alias("output_name"))


@query
def row_guards(d):
    return checks.row_guards({
        "campaigns": ready_campaigns(d),
        "variables": d.module_variable,
        "base": profile_rows(d),
        "nobody": eligibility.eligible_travelers(d.traveler, "marketing", locale="xx_xx"),
    })


# Metadata --------------------------------------------------------------------------


def _metadata(d, *placed: str, modules: DataFrame | None = None):
    """The metadata of the live campaigns; with `placed`, of their distinct values of these
    columns, for what does not tell campaigns apart; of other `modules`, if given."""
    campaigns = ready_campaigns(d)
    if placed:
        campaigns = campaigns.select(*placed).distinct()
    return metadata.campaign_metadata(
        campaigns, d.template, d.segment_module_map, d.module if modules is None else modules, d.segment
    )


PLACED = ("template_id", *POS)  # what a template row and a module need to know of a campaign


def _active(d, *placed: str, modules: DataFrame | None = None):
    return metadata.active_only(_metadata(d, *placed, modules=modules))


@query
def campaign_metadata(d):
    return _metadata(d).select(
        "campaign_id", "segment_module_map_id", "slot_position", "module_id", "segment_type_id",
        "module_priority_in_slot", "status",
    )


@query
def version_count(d):
    return metadata.version_count(_active(d, *PLACED))


@query
def version_rank(d):
    return metadata.version_rank(_active(d, modules=metadata.module_versions(d.module)))


@query
def module_count(d):
    return metadata.module_count(_active(d))


@query
def module_count_join(d):
    counts = metadata.module_count(_active(d))
    return enrichment.add_module_count(recipients(d), counts).select("user_id", "campaign_id", "module_count")


@query
def slot_width(d):
    shown = _active(d, *PLACED).select(*POS, "module_id", "slot_position").distinct()
    return metadata.slot_width(metadata.module_variables(shown, d.module_variable))


@query
def slot_list(d):
    return metadata.slot_list(_active(d, *PLACED)).select(
        F.array_join(F.transform("slots", lambda s: s.cast("string")), ",").alias("slots"), "n_slots"
    )


@query
def module_variables(d):
    modules = _active(d, *PLACED).select(*POS, "module_id", "module_type").distinct()
    return metadata.module_variables(modules, d.module_variable).select(
        "module_id", "module_type", "var_position", "var_structure"
    )


@query
def missing_modules(d):
    return metadata.missing_modules(_metadata(d, *PLACED), d.module_variable)


@query
def backfill_source(d):
    return metadata.backfill_source(d.module_variable).select("module_id", "var_position", "var_source")


@query
def join_spec(d):
    return metadata.join_specs(metadata.backfill_source(d.module_variable)).withColumns(
        {c: F.array_join(c, "##") for c in ("left_keys", "right_keys", "columns")}
    )


@query
def needed_columns(d):
    return metadata.needed_columns(metadata.backfill_source(d.module_variable))


@query
def missing_files(d):
    specs = metadata.join_specs(metadata.backfill_source(d.module_variable))
    known = d.raw("region").select(F.lower("r_name").alias("file_name"))
    return metadata.missing_files(specs, known)


@query
def module_info(d):
    info = metadata.module_info(metadata.backfill_source(d.module_variable))
    return info.select("module_id", F.explode("variables").alias("v")).select(
        "module_id", "v.position", "v.connection", "v.spec",
        F.size(F.filter("v.parts", lambda p: p["column"].isNotNull())).alias("n_tokens"),
    )


# Allocation and experiments --------------------------------------------------------


@query
def segment_member(d):
    keys = d.traveler_sets.select(*POS, "test_keys", "segment_set").distinct()
    inner = d.segment_module_map.select("segment_type_id", "module_type_id").distinct()
    return allocation.segment_member(keys, inner).select(
        "tpid", "eapid", "test_keys", "segment_set", "segment_type_id", "module_type_id"
    )


@query
def allocate_modules(d):
    run = decisions(d)
    return run.for_all(run.allocated.select(
        *KEY, "slot_position", "module_type_id", "module_priority_in_slot", "module_id"
    ))


@query
def tests_on_campaign(d):
    return decisions(d).placed_tests.select(
        "test_id", "tpid", "eapid", "test_keys", "module_id", "campaign_id", "slot_position",
        "control_test_flag",
    )


@query
def test_module_set(d):
    return experiments.test_module_set(d.test_assignment).withColumn(
        "module_types", F.array_join(F.transform("module_types", lambda m: m.cast("string")), "#")
    )


@query
def experiment_catalogue(d):
    """Sampled rows of the tests that a catalogue lists: one folder a test and locale, a retired
    test and one whose folder is gone among them."""
    root = stage_path(d.spark)
    d.test_assignment.withColumns({"_test": F.col("test_id"), "_site": F.col("locale")}).write.partitionBy("_test", "_site").parquet(root)
    place = F.concat_ws("/", F.lit(root), F.concat(F.lit("_test="), "test_id"), F.concat(F.lit("_site="), "locale"))
    listed = d.test_assignment.select("test_id", "locale", place.alias("path")).distinct()
    gone = listed.where(F.col("test_id") == 1).select("test_id", "locale", F.concat("path", F.lit("-gone")).alias("path"))
    retired = listed.where(F.col("test_id") == 2).select(F.lit(999).alias("test_id"), "locale", "path")
    catalogue = listed.where(F.col("test_id") != 2).unionByName(gone).unionByName(retired)
    rows = tables.read_listed(d.spark, experiments.sample_paths(catalogue), d.test_assignment.schema)
    return rows.select("test_id", "test_type", *POS, "test_keys", "module_type_id", "control_test_flag")


@query
def campaigns_under_test(d):
    return experiments.campaigns_under_test(d.test_assignment, decisions(d).slots)


@query
def expand_test_templates(d):
    return experiments.expand_test_templates(
        d.template, decisions(d).campaigns, d.segment_module_map, d.test_assignment
    )


@query
def type_test_filter(d):
    run = decisions(d)
    return run.for_all(run.type_tested.select(
        *KEY, "slot_position", "module_type_id", "module_priority_in_slot", "module_id"
    ))


@query
def version_test_replace(d):
    run = decisions(d)
    return run.for_all(run.tested.select(
        *KEY, "slot_position", "module_type_id", "module_priority_in_slot", "module_id"
    ))


@query
def content_alloc_join(d):
    run = decisions(d)
    told = run.whole.told
    counts = run.candidate_lists.select("offer", F.size("candidates").alias("n_candidates"))
    offered = content.content_with_candidates(told, counts, **run.whole.spread)
    return run.for_all(offered.select(*CONTENT_COLUMNS, *KEY, "n_candidates"))


# Rendering -------------------------------------------------------------------------


def _looked_up(d):
    specs = content.distinct_specs(d.variables)
    return content.look_up(d.traveler, CONTENT_COLUMNS, specs, {"content": d.content})


def _offered_texts(d):
    """Rendered variables of every module offered to a profile, once per profile."""
    run = decisions(d)
    told = stage(run.whole.told.select(*POS, *CONTENT_COLUMNS, "offer").distinct())
    lists = run.candidate_lists.select("offer", F.col("candidates.module_id").alias("module_ids"))
    offered = content.content_with_candidates(told, lists, hot_in=told, rows=told.count())
    offered = offered.select(*POS, *CONTENT_COLUMNS, F.explode("module_ids").alias("module_id"))
    offered = stage(offered.distinct())
    modules = offered.join(run.info, [*POS, "module_id"])
    filled = content.fill_variables(F.col("variables"), F.col("attributes"), F.col("look_ups"))
    return (
        spread_join(modules, run.look_ups, [*POS, *CONTENT_COLUMNS], null_safe=True, hot_in=offered)
        .select(*CONTENT_COLUMNS, "module_id", F.explode(filled).alias("v"))
        .select(
            *CONTENT_COLUMNS, "module_id", F.col("v.position").alias("var_position"),
            T.text_of(F.col("v.filled")).alias("text"),
        )
    )


@query
def content_lookup(d):
    return _looked_up(d).select(
        *POS, *CONTENT_COLUMNS, "file", F.element_at("looked_up", F.lit("best")).alias("best")
    )


@query
def render_template(d):
    return _offered_texts(d)


@query
def rotate_option(d):
    run = decisions(d)
    led = run.kinds.select(F.col("leader").alias("campaign_id"), F.size("led").cast("long").alias("n_led"))
    # an outer explode has no filter on the array, which would render everything again
    shown = run.whole.rendered.select("alike", F.explode_outer("rendered").alias("c")).select(
        "alike", F.col("c.module_id").alias("module_id"), F.explode("c.cells").alias("x")
    )
    cells = sized_join(content.for_alike(shown), led, ["campaign_id"])
    return cells.groupBy("module_id", F.col("x.position").alias("var_position"), F.col("x.option").alias("option")).agg(
        F.sum("n_led").alias("n_shown"), F.min("x.value").alias("first_value")
    )


@query
def content_fallback(d):
    text = F.col("text")
    return _offered_texts(d).select(
        *CONTENT_COLUMNS, "module_id", "var_position",
        T.is_unresolved(text).alias("unresolved"),
        T.is_unresolved(text, legacy_null_words=True).alias("unresolved_legacy"),
        F.when(T.is_unresolved(text), F.get(T.options(text), F.lit(0))).otherwise(text).alias("shown"),
    )


def _of_picks(run, *told):
    """What is told of the picks, for every profile, campaign, test key and segment set."""
    rows = run.whole.picks.select(*CONTENT_COLUMNS, "test_keys", "alike", *told)
    names = [c for c in rows.columns if c not in (*CONTENT_COLUMNS, "test_keys", "alike")]
    return run.for_all(content.for_alike(rows).select(*CONTENT_COLUMNS, *KEY, *names))


@query
def dynamic_content(d):
    return _of_picks(decisions(d), slots.dynamic_content(F.col("picks")).alias("dynamic_content"))


# Slots and arbitration -------------------------------------------------------------


@query
def slot_winner(d):
    run = decisions(d)
    # an outer explode has no filter on the array, which would pick all slots again
    won = F.transform("picks", lambda p: F.struct(*[p[c].alias(c) for c in ("slot", "module_id", "priority", "fill_reason")]))
    rows = run.whole.picks.select(*CONTENT_COLUMNS, "test_keys", "alike", F.explode_outer(won).alias("p"))
    rows = content.for_alike(rows.where(F.col("p").isNotNull()))
    return run.for_all(rows.select(*CONTENT_COLUMNS, *KEY, "p.slot", "p.module_id", "p.priority", "p.fill_reason"))


@query
def hero_banner_rule(d):
    spent = F.filter("picks", lambda p: p["priority"] == 9999)
    emptied = F.filter(spent, lambda p: p["module_id"] == 999)
    return _of_picks(
        decisions(d), "campaign_priority", F.size(spent).alias("n_spent"), F.size(emptied).alias("n_emptied")
    )


@query
def module_code(d):
    return _of_picks(decisions(d), slots.module_code(F.col("picks")).alias("module_code"))


@query
def slot_columns(d):
    run = decisions(d)
    picked = run.whole.picks.withColumn("subject_line", slots.subject_line(F.col("picks")))
    names = [f"S{s}_{c}" for s in range(1, 5) for c in ("module_id", "module_type_id", "module_priority", "att_option")]
    wide = slots.slot_columns(picked, [1, 2, 3, 4]).select(*CONTENT_COLUMNS, "test_keys", "alike", "subject_line", *names)
    return run.for_all(content.for_alike(wide).select(*CONTENT_COLUMNS, *KEY, "subject_line", *names))


@query
def content_fanout(d):
    run = decisions(d)
    coded = run.whole.picks.withColumn("module_code", slots.module_code(F.col("picks"))).drop("picks")
    rows = arbitration.fan_out(run.whole.base, content.for_alike(coded), CONTENT_COLUMNS)
    return run.for_all(rows.select("email_address", "user_id", "campaign_id", "campaign_priority", "module_code"))


def _coded_winners(d):
    run = decisions(d)
    return run, run.winners.withColumn("module_code", slots.module_code(F.col("picks")))


@query
def arbitrate(d):
    _, rows = _coded_winners(d)
    return rows.select("email_address", "user_id", "campaign_id", "campaign_priority", "module_code")


@query
def arbitrate_rounds(d):
    """Both orders of arbitration where most addresses see several campaigns demoted."""
    run = decisions(DemotingDomain(d.spark, d.source.root))
    out = [run.arbitrated(mode).withColumn("fallthrough", F.lit(int(mode))) for mode in (False, True)]
    return out[0].unionByName(out[1]).select(
        "fallthrough", "email_address", "user_id", "campaign_id", "campaign_priority",
        slots.module_code(F.col("picks")).alias("module_code"),
    )


@query
def arbitrate_fallthrough(d):
    rows = decisions(d).arbitrated(fallthrough=True)
    return rows.select("email_address", "user_id", "campaign_id", "campaign_priority")


@query
def campaign_modules(d):
    _, rows = _coded_winners(d)
    return slots.campaign_modules(rows)


@query
def campaign_summary(d):
    run, rows = _coded_winners(d)
    return sinks.campaign_summary(run.campaigns, rows).drop("launch_date", "locale")


@query
def launch_manifest(d):
    run, rows = _coded_winners(d)
    sids = sinks.audience_master(run.campaigns, "prod", F.lit("2001-08-01 06:00:00")).select("campaign_id", "sid")
    summary = sinks.campaign_summary(run.campaigns, rows).join(sids, "campaign_id").withColumn(
        "file_name", X.output_name(F.col("audience_name"), F.col("launch_date"), "prod", None)
    )
    return sinks.manifest(summary, d.schedule, "out").withColumn(
        "scheduled_launch_time", stamp(F.col("scheduled_launch_time"))
    )


@query
def test_tag(d):
    run, rows = _coded_winners(d)
    return experiments.test_tag(rows, run.leader_tests, run.placed_active)


@query
def rewrite_tag(d):
    run, rows = _coded_winners(d)
    tags = experiments.test_tag(rows, run.leader_tests, run.placed_active)
    named = rows.withColumn(
        "recipient_id", F.concat(F.lit("ID.PAID"), F.col("paid").cast("string"), F.lit(".TEST1.VERSX.MIDS"), F.col("module_code"))
    )
    return experiments.add_test_tag(named, tags, hot_in=rows).select("user_id", "campaign_id", "recipient_id")


@query
def sample_per_code(d):
    _, rows = _coded_winners(d)
    return sampling.sample_per_code(rows, ["user_id", "campaign_id", "segment_set"]).select(
        "module_code", "user_id", "campaign_id"
    )


# Enrichment and ids ----------------------------------------------------------------


@query
def launch_time(d):
    """Launch date and time of each recipient's campaign, by campaign and locale."""
    return enrichment.add_launch(recipients(d), d.campaign).select(
        "user_id", "campaign_id", F.col("launch_date").cast("string").alias("launch_date"), "launch_time_utc"
    )


def _coded_recipients(d):
    code = F.concat(F.lit("1-"), F.col("campaign_id").cast("string"), F.lit("_2-"), F.col("test_keys").cast("string"))
    return recipients(d).withColumn("module_code", code)


@query
def token_coalesce(d):
    return enrichment.add_user_token(recipients(d), d.token_a, d.token_b).select("user_id", "campaign_id", "user_token")


@query
def loyalty_enrich(d):
    return enrichment.add_loyalty(stage(recipients(d)), d.loyalty).select(
        "user_id", "campaign_id", "member_id", "tier_name", "available_points", "member_status"
    )


@query
def loyalty_flag(d):
    return d.loyalty.select("paid", X.loyalty_flag(F.col("status")).alias("member_status"))


@query
def pos_mapping_join(d):
    rows = stage(recipients(d))
    prod = enrichment.add_pos_mapping(rows, d.pos_mapping).withColumn("mode", F.lit("prod"))
    test = enrichment.add_pos_mapping(rows, d.pos_mapping, live_test=True).withColumn("mode", F.lit("test"))
    return prod.unionByName(test).select("user_id", "campaign_id", "mode", "brand", "posa")


@query
def recipient_enrich(d):
    rows = stage(_coded_recipients(d))
    person = ["paid", "email_address", "campaign_id"]
    upstream = rows.where(F.col("paid").isNotNull())
    tokens = upstream.where(F.col("mktsegment") != "BUILDING").select(
        *person, F.md5(F.col("paid").cast("string")).alias("user_token")
    )
    prefixes = upstream.where(F.col("mktsegment") != "MACHINERY").select(
        *person, F.concat(F.lit("ID"), F.col("paid").cast("string"), F.lit(".MIDS")).alias("recipient_prefix")
    )
    members = d.loyalty.join(upstream.select("tpid", "paid", "campaign_id").distinct(), ["tpid", "paid"])
    return enrichment.add_upstream(rows, tokens, members, prefixes).select(
        "user_id", "campaign_id", "user_token", "member_id", "recipient_id"
    )


@query
def pad_id(d):
    wide = F.col("o_orderkey") * 100000 + F.col("o_custkey")
    return d.raw("orders").select(
        "o_orderkey", X.pad_id(F.col("o_orderkey")).alias("padded"), X.pad_id(wide).alias("padded_wide"),
        X.key_id(F.col("o_custkey"), F.col("o_orderkey")).alias("key_id"),
    )


@query
def row_ids(d):
    rows = stage(recipients(d).select("email_address", "user_id", "campaign_id"))
    return consecutive_ids(rows, ["user_id", "campaign_id"], "row_id")


@query
def recipient_id(d):
    run_campaigns = ready_campaigns(d)
    master = sinks.audience_master(run_campaigns, "prod", F.lit("2001-08-01 06:00:00"))
    rows = stage(_coded_recipients(d))
    rows = consecutive_ids(rows, ["user_id", "campaign_id"], "row_id")
    rows = enrichment.add_program(enrichment.add_pos_mapping(rows, d.pos_mapping), master)
    rows = enrichment.add_launch(rows, run_campaigns).withColumn("issue_id", D.issue_id(F.col("launch_time_utc")))
    return enrichment.add_recipient_id(rows, RUN.home_brand).select("user_id", "campaign_id", "recipient_id")


@query
def seed_rows(d):
    rows = stage(recipients(d).select(*POS, "email_address", "user_id", "paid", "test_keys", "campaign_id"))
    seeds = enrichment.numbered_seeds(d.seed, "Merch")
    return enrichment.add_seeds(rows, seeds, ["user_id"])


@query
def redirect_address(d):
    rows = recipients(d).select("user_id", "campaign_id", "email_address")
    kept = enrichment.redirect_address(rows, None).withColumn("mode", F.lit("prod"))
    sent = enrichment.redirect_address(rows, "check@example.com").withColumn("mode", F.lit("test"))
    return kept.unionByName(sent)


@query
def stratified_sample(d):
    rows = profile_rows(d, tell=lambda people: sampling.with_head(people, ["test_keys", "user_id"], "_head"))
    return sampling.stratified_sample(rows, "test_keys", ["campaign_id"], head="_head").select(
        "user_id", "campaign_id", "test_keys"
    )


# Flagship --------------------------------------------------------------------------


@query
def travelers_per_campaign(d):
    """Drop the recently contacted, keep each address's best campaign, count travelers."""
    travelers = eligibility.suppress_recent(
        eligibility.eligible_travelers(d.traveler, "marketing"),
        eligibility.recent_notified(d.notification, d.notified_as_of),
        eligibility.recent_booked(d.booking, d.booked_as_of),
    )
    rows = campaign_rows(segment_profiles(d, travelers), arbitration.contenders(outer_campaigns(d).distinct()))
    best = arbitration.keep_best(stage(rows)).where(F.col("campaign_priority") != 9999)
    return best.groupBy("campaign_id").agg(F.count_distinct("user_id").alias("n_travelers"))
