"""The daily run, stage by stage, from configuration and profiles to delivered rows."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, fields, replace
from functools import cached_property

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outreach.functions.dates import compact_date, issue_id
from outreach.functions.text import display_locale, output_name
from outreach.operators import allocation as A
from outreach.operators import arbitration as R
from outreach.operators import checks as Q
from outreach.operators import content as C
from outreach.operators import eligibility as E
from outreach.operators import enrichment as N
from outreach.operators import experiments as X
from outreach.operators import metadata as M
from outreach.operators import sampling as P
from outreach.operators import slots as S
from outreach.operators.skew import consecutive_ids
from outreach.params import POS, RunParams
from outreach.sources import sinks as W
from outreach.sources.runs import RunLog, append_log
from outreach.sources.staging import stage


@dataclass(frozen=True)
class Inputs:
    """Tables of one run. `recent` holds the contact keys to suppress; `columns` are the
    profile columns that distinct content is told apart by. A run reads these, the base
    columns, those that templates and join specs name, and `carried` ones, which are delivered
    with the rows; no other column of a wide profile is scanned."""

    campaigns: DataFrame
    manual: DataFrame
    segments: DataFrame
    templates: DataFrame
    seg_map: DataFrame
    modules: DataFrame
    variables: DataFrame
    travelers: DataFrame
    traveler_segments: DataFrame
    recent: list[DataFrame]
    assignments: DataFrame
    files: dict[str, DataFrame]
    columns: list[str]
    tie_break: list[str] = field(default_factory=lambda: ["user_id"])
    carried: list[str] = field(default_factory=list)


def same_case(tables):
    """Inputs or a delivery with every locale in lower case, so that `en_US` meets `en_us`,
    in look-up files and contact keys as well."""
    def lower(value):
        if isinstance(value, DataFrame):
            return value.withColumn("locale", F.lower("locale")) if "locale" in value.columns else value
        if isinstance(value, dict):
            return {name: lower(v) for name, v in value.items()}
        return [lower(v) for v in value] if isinstance(value, list) else value

    return replace(tables, **{f.name: lower(getattr(tables, f.name)) for f in fields(tables)})


def together(spark: SparkSession, *steps: Callable[[], DataFrame]) -> list[DataFrame]:
    """Frames that do not need each other, staged at the same time: most of their jobs have few
    tasks. What several of them read has to be there before, or each would make its own."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [made.result() for made in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]]


class Content:
    """What a base of travelers and campaigns is shown, step by step and on demand."""

    def __init__(self, of: Decisions, base: DataFrame):
        self.of, self.base, self.columns = of, base, of.inputs.columns

    @cached_property
    def spread(self) -> dict:
        """Where hot keys are looked for; the base is staged, so its size costs no pass."""
        return {"hot_in": self.base, "rows": self.base.count()}

    @cached_property
    def distinct(self) -> DataFrame:
        return C.distinct_content(self.base, self.columns)

    @cached_property
    def told(self) -> DataFrame:
        """Distinct content with the list of modules it is offered."""
        return C.content_with_offers(self.distinct, self.of.offers, **self.spread)

    @cached_property
    def alike(self) -> DataFrame:
        """Content that looks the same, with the campaigns and segment sets that show it."""
        return stage(C.content_alike(self.told, self.columns, self.spread["rows"]))

    @cached_property
    def near(self) -> dict:
        return {"hot_in": self.alike, "rows": self.alike.count()}

    @cached_property
    def offered(self) -> DataFrame:
        """Content that looks the same with its candidate modules."""
        return C.content_with_candidates(self.alike, self.of.candidate_lists, **self.near)

    @cached_property
    def rendered(self) -> DataFrame:
        """Rendered once for all that looks the same; so are the `picks`."""
        return C.render_candidates(self.offered, self.of.look_ups, self.columns, self.of.run.seed, **self.near)

    @cached_property
    def picks(self) -> DataFrame:
        return S.pick_slots(self.rendered, M.slot_list(self.of.decided))

    @cached_property
    def picked(self) -> DataFrame:
        """The picks of each campaign, test key and segment set."""
        return C.for_alike(self.picks)

    @cached_property
    def rows(self) -> DataFrame:
        return R.fan_out(self.base, self.picked, self.columns, **self.spread)


class WholeContent(Content):
    """Content of every traveler for every campaign of their segments. It is worked out for the
    campaigns that lead their kind, from the distinct profiles of a segment and not from people;
    `Decisions.for_all` repeats rows for the campaigns led, as the last step."""

    def __init__(self, of: Decisions):
        self.of, self.columns = of, of.inputs.columns

    @cached_property
    def base(self) -> DataFrame:
        return stage(self.of.leader_base)

    @cached_property
    def spread(self) -> dict:
        return {"hot_in": self.distinct, "rows": self.distinct.count()}

    @cached_property
    def distinct(self) -> DataFrame:
        of = self.of
        of.variables  # people and campaigns both read them
        people, campaigns = together(of.spark, lambda: of.sampled, lambda: of.decided)
        return stage(C.content_kinds(people, A.outer_campaigns(campaigns), self.columns))

    @cached_property
    def rendered(self) -> DataFrame:
        self.distinct, self.of.described  # lists and look-ups both read them
        offered, look_ups = together(self.of.spark, lambda: self.offered, lambda: self.of.look_ups)
        return C.render_candidates(offered, look_ups, self.columns, self.of.run.seed, **self.near)

    def shown(self, picked: DataFrame) -> DataFrame:
        """Everyone's rows for every campaign, with what is kept of the picks."""
        spread = {"hot_in": self.base, "rows": self.base.count()}
        return self.of.for_all(R.fan_out(self.base, picked, self.columns, **spread))

    @cached_property
    def rows(self) -> DataFrame:
        return self.shown(self.picked)


class Decisions:
    """Who gets which content, frame by frame and on demand.

    Frames with several readers are staged: campaigns, their slots, the modules placed in
    them and the metadata of versions, module variables, travelers and their segments,
    and of each round the people offered, their allocation, candidates and look-ups, and
    the rows that arbitration reads twice. A run never joins travelers with all campaigns;
    `base` and `whole` do, for those who want every traveler's content for every campaign.

    Campaigns that share template, point of sale, segment and priority show the same content:
    everything up to arbitration is decided for the one of each kind that comes first
    (`leaders`), as no other can win before it, and repeated for the others where they are asked
    for. `slots`, `metadata`, `active` and `placed_tests` tell of all campaigns; `leader_slots`,
    `decided`, `leader_tests` and what follows from them, of the leaders.
    """

    def __init__(self, inputs: Inputs, run: RunParams, log: RunLog | None = None):
        self.inputs = same_case(inputs)
        self.run = run
        self.log = log or RunLog()
        self.spark = inputs.campaigns.sparkSession

    @cached_property
    def campaigns(self) -> DataFrame:
        live = E.live_campaigns(
            self.inputs.campaigns, self.run.run_date, self.run.locale,
            self.run.loyalty_program if self.run.program == "loyalty" else None,
            self.run.campaign_id if self.run.test_type == "MANUAL" else None,
        )
        left = E.drop_manual_launches(live, self.inputs.manual)
        return self.log.stage(E.demote_dead(left, self.inputs.segments), "campaigns", Q.NothingToSend)

    @cached_property
    def kinds(self) -> DataFrame:
        return stage(A.campaign_kinds(self.campaigns))

    @cached_property
    def leaders(self) -> DataFrame:
        return stage(A.leading(self.campaigns, self.kinds))

    def for_all(self, rows: DataFrame) -> DataFrame:
        """Rows of the leaders, repeated for all campaigns of their kind."""
        return A.for_kinds(rows, self.kinds)

    @cached_property
    def templates(self) -> DataFrame:
        i = self.inputs
        return X.expand_test_templates(i.templates, self.leaders, i.seg_map, i.assignments).distinct()

    @cached_property
    def variables(self) -> DataFrame:
        return stage(M.backfill_source(self.inputs.variables))

    @cached_property
    def slots(self) -> DataFrame:
        i = self.inputs
        placed = M.placed_slots(self.campaigns, self.templates, i.seg_map, i.segments)
        return self.log.stage(placed, "campaign slots", Q.CheckFailed)

    @cached_property
    def leader_slots(self) -> DataFrame:
        i = self.inputs
        return stage(M.placed_slots(self.leaders, self.templates, i.seg_map, i.segments))

    @cached_property
    def placed(self) -> DataFrame:
        """Modules that some slot can show."""
        return self.log.stage(M.placed_modules(self.inputs.modules, self.leader_slots), "modules in slots")

    @cached_property
    def families(self) -> DataFrame:
        return stage(M.module_families(self.placed, self.with_variables))

    @cached_property
    def metadata(self) -> DataFrame:
        """Campaign metadata, a row per version and not per module."""
        return self.log.stage(M.factored_metadata(self.slots, self.families), "campaign metadata", Q.CheckFailed)

    @cached_property
    def decided(self) -> DataFrame:
        """The active metadata of the leaders."""
        found = M.factored_metadata(self.leader_slots, self.families)
        return self.log.stage(M.active_only(found), "metadata of leading campaigns", Q.CheckFailed)

    @cached_property
    def active(self) -> DataFrame:
        return M.active_only(self.metadata)

    @cached_property
    def placed_active(self) -> DataFrame:
        return M.active_only(self.placed)

    @cached_property
    def with_variables(self) -> DataFrame:
        """The modules that have variables; others cannot be shown."""
        return self.log.stage(M.modules_with_variables(self.variables), "module variables", Q.CheckFailed)

    @cached_property
    def info(self) -> DataFrame:
        """Parsed variables of the modules that are allocated; no other template is parsed."""
        due = self.due.select(*POS, "module_id").distinct()
        return M.module_info(self.variables.join(due, [*POS, "module_id"], "left_semi"))

    @cached_property
    def profile_columns(self) -> list[str]:
        """The profile columns a run reads, in the order of the table."""
        i = self.inputs
        wanted = {*M.traveler_columns_to_read(self.variables), *i.columns, *i.tie_break, *i.carried}
        return [c for c in i.travelers.columns if c in wanted]

    @cached_property
    def travelers(self) -> DataFrame:
        profiles = self.inputs.travelers.select(*self.profile_columns)
        chosen = E.eligible_travelers(profiles, self.run.program, self.run.locale)
        if self.run.program == "loyalty":
            return chosen
        return E.suppress_recent(chosen, *self.inputs.recent)

    @cached_property
    def sampled(self) -> DataFrame:
        """The members, of which a live test takes a sample; it is drawn by person, so it can be
        drawn before people meet campaigns."""
        if self.run.is_live_test:
            return stage(P.stratified_sample(self.members, "test_keys", ["email_address", *self.inputs.tie_break]))
        return self.members

    @cached_property
    def leader_base(self) -> DataFrame:
        return A.meet_campaigns(self.sampled, A.outer_campaigns(self.decided))

    @cached_property
    def base(self) -> DataFrame:
        """Travelers with all campaigns of their segments."""
        return self.for_all(self.leader_base)

    @cached_property
    def members(self) -> DataFrame:
        """Travelers with their outer segments; campaigns are met round by round."""
        travelers = stage(self.travelers)  # counted, searched for hot keys and joined
        found = A.members(self.inputs.traveler_segments, travelers, rows=travelers.count())
        return self.log.stage(found, "travelers with segments", Q.CheckFailed)

    @cached_property
    def lists(self) -> DataFrame:
        return self.log.stage(A.campaign_lists(A.outer_campaigns(self.decided)), "campaigns of segments", Q.NothingToSend)

    @cached_property
    def candidates(self) -> DataFrame:
        ranked = M.ranked_metadata(self.decided, self.decided)
        ranked = ranked.where(F.col("module_id").isNotNull())
        return self.log.stage(A.slot_candidates(ranked), "module versions", Q.CheckFailed)

    @cached_property
    def allocated(self) -> DataFrame:
        keys = A.content_keys(self.members, A.outer_campaigns(self.decided))
        due = A.allocate_modules(keys, self.candidates, self.run.seed)
        return self.log.stage(due, "module allocation", Q.CheckFailed)

    @cached_property
    def type_tested(self) -> DataFrame:
        return X.type_test_filter(self.allocated, X.running_tests(self.inputs.assignments, self.leader_slots))

    @cached_property
    def tested(self) -> DataFrame:
        return X.version_test_replace(self.type_tested, self.leader_tests, self.placed)

    @cached_property
    def due(self) -> DataFrame:
        return stage(self.tested)

    @cached_property
    def described(self) -> DataFrame:
        return stage(C.described_modules(self.due, self.inputs.modules, self.info))

    @cached_property
    def offers(self) -> DataFrame:
        """The list of modules per campaign, test key and segment set: rows that do not grow
        with the number of travelers."""
        return self.log.stage(C.offered_lists(self.due, self.described), "offered modules", Q.CheckFailed)

    @cached_property
    def candidate_lists(self) -> DataFrame:
        """Candidate modules of each list, with their texts."""
        return stage(C.candidate_arrays(self.offers, self.described))

    @cached_property
    def look_ups(self) -> DataFrame:
        """What each distinct profile finds; once for all rounds."""
        files = C.only_read(self.inputs.files, M.file_columns(M.join_specs(self.offered_variables)))
        found = C.look_up(self.members, self.inputs.columns, self.specs, files)
        return self.log.stage(C.profile_look_ups(found, self.inputs.columns), "look-ups")

    @cached_property
    def tested_modules(self) -> DataFrame:
        return self.placed.join(self.inputs.assignments.select("module_id").distinct(), "module_id", "left_semi")

    @cached_property
    def placed_tests(self) -> DataFrame:
        meta = M.factored_metadata(self.slots, self.tested_modules)
        return self.log.stage(X.tests_on_campaign(self.inputs.assignments, meta), "version tests")

    @cached_property
    def leader_tests(self) -> DataFrame:
        meta = M.factored_metadata(self.leader_slots, self.tested_modules)
        return self.log.stage(X.tests_on_campaign(self.inputs.assignments, meta), "version tests of leading campaigns")

    @cached_property
    def offered_variables(self) -> DataFrame:
        """Variables of the modules that are offered to anyone."""
        return stage(self.variables.join(self.described.select("module_id").distinct(), "module_id", "left_semi"))

    @cached_property
    def specs(self) -> DataFrame:
        """Join specs that an offered module renders with; others look nothing up."""
        return self.log.stage(C.distinct_specs(self.offered_variables), "join specs")

    def content(self, base: DataFrame) -> Content:
        return Content(self, base)

    @cached_property
    def whole(self) -> WholeContent:
        """Content of every traveler for every campaign of their segments."""
        return WholeContent(self)

    def arbitrated(self, fallthrough: bool = False) -> DataFrame:
        """Rows of each address's campaign. A live test draws its sample from all rows, so
        it renders them all; other runs go by rounds."""
        if self.run.is_live_test:
            return R.arbitrate(stage(self.whole.rows), fallthrough)
        kept, self.offered_rounds = R.arbitrate_rounds(
            self.members, self.lists, lambda people: self.content(people).rows, fallthrough
        )
        return R.arbitrate(self.whole.rows, fallthrough) if kept is None else kept

    @cached_property
    def winners(self) -> DataFrame:
        return self.log.stage(self.arbitrated(), "winning rows")

    def check(self) -> None:
        """Stop before the expensive part if configuration is missing."""
        Q.require_rows(self.campaigns, "no campaign launches on the run date", Q.NothingToSend)
        Q.require_none(
            Q.conflicting_priorities(self.campaigns), "campaign_id", "campaigns with several priorities"
        )
        Q.require_rows(self.active, "no campaign metadata")
        Q.require_none(
            M.missing_modules(self.placed_active, self.variables), "module_id", "modules without variables"
        )
        known = self.inputs.modules.sparkSession.createDataFrame(
            [(name,) for name in self.inputs.files], "file_name string"
        )
        Q.require_none(
            M.missing_files(M.join_specs(self.variables), known), "file_name", "look-up files not available"
        )


@dataclass(frozen=True)
class Delivery:
    """Tables used after arbitration. `schedule` holds the launch details; with `jobs` and
    `details_locales`, only locales of the latter take their schedule from it and all others
    take it from `jobs`. `master` holds the audience master that earlier runs left, whose SIDs
    stay as they are."""

    tokens: DataFrame
    fallback_tokens: DataFrame
    seeds: DataFrame
    loyalty: DataFrame
    pos_mapping: DataFrame
    schedule: DataFrame
    jobs: DataFrame | None = None
    details_locales: DataFrame | None = None
    master: DataFrame | None = None

    @property
    def launch_times(self) -> DataFrame:
        if self.jobs is None or self.details_locales is None:
            return self.schedule
        return W.pick_schedule(self.schedule, self.jobs, self.details_locales)


def audiences(decisions: Decisions, d: Delivery) -> DataFrame:
    """The run's rows of the audience master."""
    run = decisions.run
    return W.audience_master(decisions.campaigns, run.environment, F.lit(run.run_date), d.master)


def deliver(decisions: Decisions, d: Delivery) -> DataFrame:
    """Final rows: ids, tokens, seeds, loyalty fields, recipient id, tags."""
    run, tie, d = decisions.run, decisions.inputs.tie_break, same_case(d)
    coded = (
        N.add_launch(decisions.winners, decisions.campaigns)
        .withColumn("module_code", S.module_code(F.col("picks")))
        .withColumn("subject_line", S.subject_line(F.col("picks")))
        .withColumn("dynamic_content", S.dynamic_content(F.col("picks")))
    )
    numbered = stage(consecutive_ids(stage(coded), ["email_address", "campaign_id", *tie, "locale", "segment_set"], "row_id"))
    tokens = N.add_user_token(numbered, d.tokens, d.fallback_tokens)
    sent = ("campaign_id", "locale")  # a campaign may bear another name in each locale
    counted = N.add_module_count(tokens, M.module_count(decisions.active, sent), sent, hot_in=numbered)
    one = stage(N.none_to_null(R.dedupe_recipient(counted, ["campaign_id", *tie])))
    seeded = N.add_seeds(one, N.numbered_seeds(d.seeds, run.seed_category), ["email_address", *tie])
    near = {"hot_in": seeded}  # staged, so looking for hot keys computes nothing again
    placed = N.add_pos_mapping(N.add_loyalty(seeded, d.loyalty, **near), d.pos_mapping, run.is_live_test, **near)
    ready = N.add_program(placed, audiences(decisions, d), **near).withColumn(
        "issue_id", issue_id(F.col("launch_time_utc"))
    )
    rows = N.add_recipient_id(ready, run.home_brand)
    tags = X.test_tag(numbered, decisions.leader_tests, decisions.placed_active)
    rows = X.add_test_tag(rows, tags, **near)
    if run.is_addressed_test:
        rows = P.sample_per_code(rows, ["row_id", "email_address"])
        rows = N.redirect_address(rows, run.test_address)
    elif run.environment == "test":
        rows = N.redirect_address(rows, run.sink_address)
    return rows


# Working columns that are not delivered.
WORKING = [
    "audience_name", "campaign_priority", "subchannel", "program", "campaign_code", "lob_intent",
    "brand", "posa", "issue_id", "row_id", "priority", "segment_set", "campaign_segment_type_id",
]


def run_root(run: RunParams, root: str) -> str:
    """The run's own folder: runs of another date, locale, program or mode stay as they are."""
    return f"{root}/" + W.run_folder(
        run.environment, run.job_type, run.test_type, run.run_date.isoformat(), run.locale, run.program
    )


def write(decisions: Decisions, delivered: DataFrame, d: Delivery, root: str) -> DataFrame:
    """Write campaigns, module lists and manifest below the run's folder, metadata and the
    audience master, which later runs pass on, below `root`; returns the manifest.

    Campaigns and locales that no schedule names are written and not listed; the run's log
    counts them. Suppressed campaigns share one empty folder."""
    run, own, log = decisions.run, run_root(decisions.run, root), decisions.log
    rows = log.stage(delivered.withColumn("site", W.folder_name(F.col("locale"))), "delivered rows")
    name = output_name(F.col("audience_name"), F.col("launch_date"), run.job_type, run.test_type)
    named = rows.withColumn("audience", name).withColumn("locale", display_locale(F.col("locale")))
    slots = M.slot_list(decisions.decided).first()["slots"]
    campaigns = N.output_projection(S.slot_columns(named, slots), ["picks", *WORKING], "authrealm")
    log.written(campaigns, "campaigns written", lambda df: W.write_campaigns(df, f"{own}/campaigns"), f"{own}/campaigns")
    modules = S.campaign_modules(rows)
    log.written(modules, "module lists written", lambda df: W.write_modules(df, f"{own}/modules"), f"{own}/modules")
    W.write_suppressed(campaigns, f"{own}/suppressed")
    d = same_case(d)
    master = log.stage(audiences(decisions, d), "audience master")
    sids = master.select("campaign_id", "campaign_date", "sid").distinct()
    summary = log.stage(
        W.campaign_summary(decisions.campaigns, rows)
        .withColumn("file_name", name)
        .withColumn("campaign_date", compact_date(F.col("launch_date")))
        .join(sids, ["campaign_id", "campaign_date"]),
        "campaigns and locales",
    )
    W.append_master(master, d.master, f"{root}/audience_master")
    times = stage(d.launch_times)
    log.stage(W.unscheduled(summary, times), "campaigns without schedule")
    found = W.manifest(summary, times, own, by_site=True, suppressed=f"{own}/suppressed")
    listed = log.stage(found, "manifest", Q.CheckFailed).orderBy("scheduled_launch_time", "staging_filename")
    W.write_manifest(listed, f"{own}/manifest")
    shown = M.factored_metadata(decisions.slots, decisions.placed_active)
    W.snapshot_metadata(M.module_variables(shown, decisions.variables), F.lit(run.run_date), f"{root}/metadata")
    return listed


def run_daily(inputs: Inputs, run: RunParams, d: Delivery, root: str, log: RunLog | None = None) -> DataFrame | None:
    """A whole run: checks, decisions, delivery, output, and in any case its rows in
    `{root}/run_log`. Returns the manifest, or nothing where there is nothing to send."""
    log = log or RunLog(guarded=True)
    decisions = Decisions(inputs, run, log)
    try:
        decisions.check()
        listed = write(decisions, deliver(decisions, d), d, root)
        log.note("run complete", path=run_root(run, root))
        return listed
    except Q.NothingToSend as reason:
        log.note(f"nothing to send: {reason}")
        return None
    except Exception as fault:
        log.note("run failed", error=f"{type(fault).__name__}: {str(fault)[:500]}")
        raise
    finally:
        append_log(log.rows(inputs.campaigns.sparkSession).coalesce(1), f"{root}/run_log")
