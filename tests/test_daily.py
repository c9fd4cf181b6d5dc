"""The whole run on the driver's tables: invariants, repeatability, outputs, plan shape."""

import datetime as dt
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from outreach.functions.text import display_locale
from outreach.operators.arbitration import arbitrate
from outreach.operators.slots import module_code
from outreach.params import SEED_ACCOUNT, RunParams
from outreach.operators.checks import CheckFailed, NothingToSend
from outreach.plans.daily import Decisions, Delivery, Inputs, deliver, run_daily, run_root, same_case, write
from outreach.sources import sinks
from outreach.sources.runs import RUN_LOG, RunLog
from outreach.sources.sinks import append_master, audience_master, folder_name, snapshot_metadata
from outreach.sources.staging import stage
from outreach.workload.fixtures import RUN, DemotingDomain, Domain
from outreach.workload.queries import decisions

SF = os.environ.get("TEST_RUN_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def run(spark):
    if not os.path.isdir(SF):
        pytest.skip(f"no tables in {SF}")
    d = Domain(spark, SF)
    made = Decisions(decisions(d).inputs, RUN, RunLog(guarded=True))
    tables = Delivery(
        tokens=d.token_a, fallback_tokens=d.token_b, seeds=d.seed, loyalty=d.loyalty,
        pos_mapping=d.pos_mapping, schedule=d.schedule,
    )
    return made, tables, deliver(made, tables)


def test_delivered_rows_and_files(spark, run, tmp_path):
    made, tables, rows = run
    assert not {"base", "whole", "matched"} & set(vars(made))  # people met campaigns round by round only
    listed = write(made, rows, tables, str(tmp_path)).collect()
    own = run_root(made.run, str(tmp_path))
    out = spark.read.parquet(f"{own}/campaigns")
    people = out.where(F.col("PAID") != SEED_ACCOUNT)
    assert people.count() > 0
    # one campaign per address, and per address and account one row
    per_address = people.groupBy("EmailAddress").agg(F.count_distinct("sid").alias("n"))
    assert per_address.where(F.col("n") > 1).isEmpty()
    assert people.count() == people.select("EmailAddress", "PAID").distinct().count()
    # nobody recently contacted, no empty subject or hero
    assert people.where((F.col("S1_module_id") == 999) | (F.col("S2_module_id") == 999)).isEmpty()
    contacted = made.inputs.recent[0].unionByName(made.inputs.recent[1]).select("email_address")
    assert people.join(contacted, F.lower("EmailAddress") == F.col("email_address"), "left_semi").isEmpty()
    # seeds: never more than the active seed addresses of the site
    seeds = out.where(F.col("PAID") == SEED_ACCOUNT)
    assert 0 < seeds.groupBy("sid").count().agg(F.max("count")).first()[0] <= tables.seeds.count()
    merch = tables.seeds.where("category = 'Merch' AND is_active = 1").select(F.col("seed_email").alias("EmailAddress"))
    assert seeds.join(merch, "EmailAddress", "left_anti").isEmpty()
    # every module list row is used, manifest is sorted and names modules of sent campaigns only
    modules = spark.read.parquet(f"{own}/modules")
    assert modules.select("campaign_id").distinct().count() == out.select("sid").distinct().count()
    times = [(r.scheduled_launch_time, r.staging_filename) for r in listed]
    assert times == sorted(times)
    assert not spark.read.parquet(f"{tmp_path}/metadata").isEmpty()
    # every listed folder opens; the campaigns hold all rows, and the suppressed ones none
    held = [spark.read.parquet(r.path).count() for r in listed if not r.staging_filename.endswith("_modules")]
    scheduled = out.join(spark.createDataFrame([(r.sid,) for r in listed], "sid long").distinct(), "sid", "left_semi")
    assert 0 in held and sum(held) == scheduled.count()
    assert all(spark.read.parquet(r.path).count() for r in listed if r.staging_filename.endswith("_modules"))
    # the log counts each step's rows, once
    noted = {r.status: r.row_counts for r in made.log.rows(spark).collect()}
    assert len(noted) == len(made.log.steps)
    for step, df in (("campaigns", made.campaigns), ("travelers with segments", made.members),
                     ("winning rows", made.winners), ("offered modules", made.offers), ("campaigns written", out)):
        assert noted[step] == df.count() > 0
    assert noted["manifest"] == len(listed) and noted["campaigns without schedule"] > 0
    assert noted["module lists written"] == modules.count()


def test_a_run_that_cannot_go_on_stops_and_says_so(spark, run, tmp_path):
    """Each guard, by the step it names; the log keeps what was done until then."""
    made, tables, _ = run
    i = made.inputs
    nothing = {
        "campaigns": (NothingToSend, {"campaigns": i.campaigns.limit(0)}),
        "campaign slots": (CheckFailed, {"templates": i.templates.limit(0)}),
        "module variables": (CheckFailed, {"variables": i.variables.limit(0)}),
        "campaign metadata": (CheckFailed, {"modules": i.modules.limit(0)}),
    }
    for step, (fault, change) in nothing.items():
        log, root = RunLog(guarded=True, clock=lambda: dt.datetime(2001, 8, 1, 12, tzinfo=dt.timezone.utc)), str(tmp_path / step.replace(" ", "_"))
        if fault is NothingToSend:
            assert run_daily(replace(i, **change), RUN, tables, root, log) is None
        else:
            with pytest.raises(CheckFailed, match=step):
                run_daily(replace(i, **change), RUN, tables, root, log)
        rows = spark.read.parquet(f"{root}/run_log").collect()
        assert sum(r.is_complete == 0 for r in rows) == (fault is CheckFailed)
        assert any(step in (r.error_message or r.status) for r in rows)
        # noon UTC is five in the morning there
        assert {r.start_date for r in rows} == {dt.datetime(2001, 8, 1, 5)}
        assert set(rows[0].asDict()) == {f.name for f in RUN_LOG.fields}
    some = made.campaigns.limit(3)
    for fault in (CheckFailed, NothingToSend):
        with pytest.raises(fault, match="a step: no rows"):
            RunLog(guarded=True).stage(some.limit(0), "a step", fault)
    free = RunLog()
    assert free.stage(some.limit(0), "a step", CheckFailed).isEmpty() and free.steps[0][7] == 0
    assert RunLog(guarded=True).stage(some, "a step", CheckFailed).count() == 3


def test_manifest_tells_locales_apart(spark):
    """A campaign in two locales has a folder and a launch time in each; another schedule
    table serves the locales that the details do not cover."""
    day = dt.date(2001, 8, 1)
    campaigns = spark.createDataFrame(
        [(7, "en_us", "A", day), (7, "fr_fr", "B", day), (8, "en_us", "C", day), (9, "en_us", "D", day)],
        "campaign_id int, locale string, audience_name string, launch_date date",
    )
    rows = spark.createDataFrame([(7, "en_us"), (7, "en_us"), (7, "fr_fr"), (9, "en_us")], "campaign_id int, locale string")
    summary = sinks.campaign_summary(campaigns, rows)
    assert {(r.campaign_id, r.locale): r.n_rows for r in summary.collect()} == {
        (7, "en_us"): 2, (7, "fr_fr"): 1, (8, "en_us"): 0, (9, "en_us"): 1}
    details = spark.createDataFrame([(7, "en_us", 1), (7, "fr_fr", 2), (8, "en_us", 3)], "campaign_id int, locale string, scheduled_launch_time int")
    jobs = spark.createDataFrame([(7, "FR_FR", 5), (7, "en_us", 6)], "campaign_id int, locale string, scheduled_launch_time int")
    enabled = spark.createDataFrame([("EN_us",)], "locale string")
    tables = same_case(Delivery(*[rows] * 5, schedule=details, jobs=jobs, details_locales=enabled))
    named = summary.withColumns({"file_name": F.col("audience_name"), "sid": F.col("campaign_id") * 10})
    listed = sinks.manifest(named, tables.launch_times, "o", by_site=True, suppressed="o/suppressed").collect()
    base = "o/campaigns/site={}/launch_date=2001-08-01/audience={}/sid=70"
    assert [(r.staging_filename, r.path, r.scheduled_launch_time) for r in listed] == [
        ("A", base.format("en_us", "A"), 1), ("A_modules", "o/modules/site=en_us/campaign_id=7", 1), ("C", "o/suppressed", 3),
        ("B", base.format("fr_fr", "B"), 5), ("B_modules", "o/modules/site=fr_fr/campaign_id=7", 5)]
    assert [r.campaign_id for r in sinks.unscheduled(named, tables.launch_times).collect()] == [9]


def test_runs_do_not_share_folders():
    day = dt.date(2001, 8, 1)
    runs = [RunParams(run_date=day), RunParams(run_date=day, locale="en_us"), RunParams(run_date=day, job_type="test")]
    runs.append(RunParams(run_date=dt.date(2001, 8, 2)))
    assert len({run_root(r, "/out") for r in runs}) == len(runs)


def test_a_snapshot_leaves_other_dates_and_locales(spark, tmp_path):
    path = str(tmp_path / "metadata")
    for locale, day in (("en_us", "2001-08-01"), ("en_gb", "2001-08-01"), ("en_us", "2001-08-02"), ("en_us", "2001-08-02")):
        snapshot_metadata(spark.createDataFrame([(1, locale)], "module_id int, locale string"), F.lit(day), path)
    assert spark.read.parquet(path).count() == 3


def test_folder_names_and_locale_spelling(spark):
    rows = spark.createDataFrame([("A#1/b c", "en_us"), ("", "EN_us"), (None, "fr"), ("Ä.x-1_", None)], "n string, l string")
    out = rows.select(folder_name(F.col("n")), display_locale(F.col("l"))).collect()
    assert [r[0] for r in out] == ["A_1_b_c", "unnamed", "unnamed", "Ä.x-1_"]
    assert [r[1] for r in out] == ["en_US", "en_US", "fr", None]


def test_locales_meet_in_any_case(spark):
    rows = spark.createDataFrame([("en_US", 1), (None, 2)], "locale string, n int")
    tables = Delivery(*[rows] * 5, schedule=rows.drop("locale"))
    lowered = same_case(tables)
    assert [r.locale for r in lowered.seeds.orderBy("n").collect()] == ["en_us", None]
    assert lowered.schedule.columns == ["n"] and lowered.jobs is None
    inputs = Inputs(*[rows] * 9, recent=[rows], assignments=rows, files={"content": rows}, columns=["n"])
    for df in (same_case(inputs).recent[0], same_case(inputs).files["content"]):
        assert [r.locale for r in df.orderBy("n").collect()] == ["en_us", None]


def test_sids_stay_over_runs(spark, tmp_path):
    """Old campaigns keep their SID, new ones get unused ones, and a rerun adds nothing."""
    schema = ("campaign_type_id int, campaign_id int, audience_name string, template_id int, campaign_segment_type_id int, "
              "launch_date date, locale string, program_type string")
    path = str(tmp_path / "master")

    def run(*campaigns):
        rows = spark.createDataFrame([(1, i, f"A{i}", 1, 1, dt.date(2001, 8, day), loc, "EML..P.C.L") for i, day, loc in campaigns], schema)
        stored = spark.read.parquet(path) if os.path.exists(path) else None
        made = audience_master(rows, "prod", F.lit("t"), stored)
        append_master(stage(made), stored, path)
        return {(r.campaign_id, r.campaign_date, r.locale): r.sid for r in made.collect()}

    first = run((5, 2, "en_us"), (7, 2, "en_us"), (7, 2, "en_gb"))
    assert sorted(set(first.values())) == [1, 2]
    both = ((1, 1, "en_us"), (5, 2, "en_us"), (6, 3, "fr_fr"), (7, 2, "en_gb"))
    second = run(*both)
    assert {k: v for k, v in second.items() if k in first} == {k: first[k] for k in second if k in first}
    assert sorted(set(second.values())) == [1, 2, 3, 4]
    before = spark.read.parquet(path).count()
    assert run(*both) == second and spark.read.parquet(path).count() == before == 5
    assert spark.read.parquet(path).groupBy("sid").agg(F.count_distinct("campaign_id", "campaign_date").alias("n")).where("n > 1").isEmpty()


def test_rounds_keep_what_rendering_everything_keeps(spark):
    """With many demotions: the same rows in both orders, from fewer rendered ones."""
    made = decisions(DemotingDomain(spark, SF))
    whole = stage(made.whole.rows)
    fallen = whole.where("campaign_priority = 9999").groupBy("email_address").agg(F.count_distinct("campaign_id").alias("n"))
    assert fallen.where("n > 1").count() > 50
    columns = ["email_address", "user_id", "campaign_id", "campaign_priority", module_code(F.col("picks"))]
    for fallthrough in (False, True):
        want = sorted(map(tuple, arbitrate(whole, fallthrough).select(*columns).collect()), key=str)
        got = sorted(map(tuple, made.arbitrated(fallthrough).select(*columns).collect()), key=str)
        assert got == want and got
        rendered = [people.count() for people in made.offered_rounds]
        assert len(rendered) > 1 and rendered[0] < made.base.count() / 2
        assert sum(rendered) < made.base.count()


def test_rerun_gives_the_same_codes(spark, run):
    made, _, _ = run
    def codes(m):
        coded = m.winners.select("user_id", "campaign_id", module_code(F.col("picks")).alias("code"))
        return sorted(map(tuple, coded.collect()))

    again = decisions(Domain(spark, SF))
    assert codes(made) == codes(again)


def test_main_path_has_no_python_and_no_cross_join(run):
    made, _, rows = run
    whole = made.whole
    for df in (whole.picked, made.type_tested, made.tested, made.winners, rows):
        plan = df._jdf.queryExecution().executedPlan().toString()
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan
