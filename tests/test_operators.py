"""Operators on hand-made edge rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from outreach.operators import arbitration, content, eligibility, enrichment, experiments, metadata
from outreach.params import SEED_ACCOUNT

NOW = dt.datetime(2024, 1, 31, 12, 0)
HISTORY = (
    "email_address string, tpid int, eapid int, test_keys int, create_date timestamp_ntz, "
    "booking_start timestamp_ntz, booking_end timestamp_ntz, etl_update_date timestamp_ntz"
)


def ago(**kw):
    return NOW - dt.timedelta(**kw)


def history(spark, *rows):
    """Rows of (email, tpid, test key, created, start, end, loaded)."""
    return spark.createDataFrame([(e, t, 0, k, c, s, n, l) for e, t, k, c, s, n, l in rows], HISTORY)


def emails(df):
    return sorted(str(r.email_address) for r in df.collect())


def test_notification_bounds(spark):
    rows = history(
        spark,
        ("New@x", 1, 0, ago(hours=23), None, None, None),
        ("bound@x", 1, 0, ago(hours=24), None, None, None),           # strictly later than the bound
        ("old@x", 1, 17, ago(days=3), None, None, None),
        ("ahead@x", 1, 50, NOW + dt.timedelta(days=8), None, None, None),
        ("band@x", 1, 82, ago(days=3), None, None, None),
        (None, 1, 99, NOW + dt.timedelta(days=8), None, None, None),  # second branch is not guarded
    )
    as_of = F.lit(NOW).cast("timestamp_ntz")
    assert emails(eligibility.recent_notified(rows, as_of)) == ["None", "ahead@x", "new@x"]
    assert emails(eligibility.recent_notified(rows, as_of, strict=True)) == ["ahead@x", "new@x", "old@x"]


@pytest.mark.parametrize("key, kept", [(16, 0), (17, 1), (50, 1), (51, 0), (82, 0), (83, 1), (99, 1), (100, 0)])
def test_booking_bands(spark, key, kept):
    rows = history(spark, ("a@x", 1, key, ago(days=1), None, None, ago(hours=1)))
    assert eligibility.recent_booked(rows, F.lit(NOW).cast("timestamp_ntz")).count() == kept


def test_booking_windows(spark):
    fresh = ago(hours=1)
    rows = history(
        spark,
        ("bound@x", 1, 17, ago(days=7), None, None, fresh),
        ("stale@x", 1, 17, ago(days=1), None, None, ago(days=2)),
        ("starts@x", 1, 17, ago(days=20), ago(hours=3), None, fresh),
        ("ended@x", 1, 17, ago(days=20), None, ago(days=7), fresh),
        (None, 1, 17, ago(days=1), None, None, fresh),
    )
    as_of = F.lit(NOW).cast("timestamp_ntz")
    assert emails(eligibility.recent_booked(rows, as_of)) == ["ended@x"]
    assert emails(eligibility.recent_booked(rows, as_of, strict=True)) == ["ended@x", "starts@x"]


@pytest.mark.parametrize("min_rows", [1, 1000])
def test_suppression_ignores_case_and_keeps_missing_keys(spark, min_rows):
    people = spark.createDataFrame(
        [("A@x", 1, 0), ("b@x", 1, 0), (None, 1, 0), ("A@x", None, 0), ("A@x", 2, 0)],
        "email_address string, tpid int, eapid int",
    )
    recent = spark.createDataFrame([("a@X", 1, 0), (None, 1, 0), ("A@x", None, 0)], people.schema)
    left = eligibility.suppress_recent(people, recent, recent, min_rows=min_rows)
    assert sorted(map(str, left.collect())) == sorted(
        map(str, [r for r in people.collect() if tuple(r) != ("A@x", 1, 0)])
    )


ROWS = "email_address string, user_id int, campaign_id int, campaign_priority int, picks array<struct<slot:int,module_id:int>>"
FULL, NO_SUBJECT, NO_HERO = [(1, 5), (2, 6)], [(1, 999), (2, 6)], [(1, 5), (2, 999)]


@pytest.mark.parametrize("min_rows", [1, 1000])
def test_arbitration(spark, min_rows):
    rows = spark.createDataFrame(
        [
            ("tie@x", 1, 8, 1, FULL), ("tie@x", 1, 7, 1, FULL),                   # smaller campaign
            ("empty@x", 2, 7, 1, NO_SUBJECT), ("empty@x", 2, 8, 2, FULL),         # runner-up is not sent
            ("hero@x", 3, 7, 1, NO_HERO),
            ("dead@x", 4, 7, 9999, FULL),
            ("two@x", 5, 7, 1, FULL), ("two@x", 6, 7, 1, FULL), ("two@x", 6, 9, 2, FULL),  # shared address
            (None, 9, 7, 1, FULL),
        ],
        ROWS,
    )
    def sent(**kw):
        got = arbitration.arbitrate(rows, min_rows=min_rows, salts=3, **kw).collect()
        return {(r.email_address, r.user_id, r.campaign_id) for r in got}

    base = {("tie@x", 1, 7), ("two@x", 5, 7), ("two@x", 6, 7), (None, 9, 7)}
    assert sent() == base
    assert sent(fallthrough=True) == base | {("empty@x", 2, 8)}


@pytest.mark.parametrize("min_rows", [1, 1000])
def test_fan_out_keeps_missing_attributes_apart(spark, min_rows):
    key = "tpid int, eapid int, locale string, a string, b string, campaign_id int, test_keys int, segment_set string"
    keys = [(0, 0, "l", "x", None, 1, 1, "1"), (0, 0, "l", None, "x", 1, 1, "1"), (0, 0, "l", None, None, 1, 1, "1")]
    people = spark.createDataFrame([(*k, i) for i, k in enumerate(keys * 3)], key + ", user_id int")
    rendered = spark.createDataFrame(
        [(*k, 1, {"n": str(i)}) for i, k in enumerate(keys)], key + ", priority int, picks map<string,string>"
    )
    got = arbitration.fan_out(people, rendered, ["a", "b"], min_rows=min_rows, salts=3)
    assert sorted((r.user_id, r.picks["n"]) for r in got.collect()) == [(i, str(i % 3)) for i in range(9)]


def test_look_up_keys(spark):
    specs = spark.createDataFrame(
        [(0, 0, "l", "s", "f", ["p", "q"], ["x", "y"])],
        "tpid int, eapid int, locale string, spec string, file string, left_keys array<string>, right_keys array<string>",
    )
    table = spark.createDataFrame(
        [(0, 0, "l", "1", "23", "b"), (0, 0, "l", "1", "23", "a"), (0, 0, "l", "12", "3", "c"), (0, 0, "l", None, "3", "d")],
        "tpid int, eapid int, locale string, x string, y string, best string",
    )
    people = spark.createDataFrame(
        [(0, 0, "l", "1", "23"), (0, 0, "l", "12", "3"), (0, 0, "l", None, "3"), (0, 0, "l", "9", "9"), (5, 0, "l", "1", "23")],
        "tpid int, eapid int, locale string, p string, q string",
    )
    found = content.look_up(people, ["p", "q"], specs, {"f": table})
    got = {(r.tpid, r.p, r.q): (r.looked_up or {}).get("best") for r in found.collect()}
    assert got == {(0, "1", "23"): "a", (0, "12", "3"): "c", (0, None, "3"): None, (0, "9", "9"): None, (5, "1", "23"): None}


def test_backfill_takes_one_source(spark):
    rows = spark.createDataFrame(
        [(1, 1, 1, "b"), (1, 1, 2, "a"), (1, 1, 3, ""), (1, 2, 4, None)],
        "module_id int, source_connection int, var_position int, var_source string",
    )
    got = {r.var_position: r.var_source for r in metadata.backfill_source(rows).collect()}
    assert got == {1: "a", 2: "a", 3: "a", 4: None}


POS_COLS = "tpid int, eapid int, locale string"
ALLOC = f"campaign_id int, test_keys int, segment_set string, campaign_segment_type_id int, {POS_COLS}, " \
        "slot_position int, module_type_id int, module_priority_in_slot int, module_id int"
TESTS = f"test_id int, test_type string, {POS_COLS}, test_keys int, segment_type_id int, module_type_id int, " \
        "segment_module_map_id int, module_id int, control_test_flag int, t_c_flag string"


def alloc(key, segments, slot, kind, module):
    return (1, key, segments, 1, 0, 0, "l", slot, kind, 10 + kind, module)


def test_type_test_removes_and_restores(spark):
    tests = spark.createDataFrame(
        [(11, "module type", 0, 0, "l", 7, 6, 3, 36, None, 0, "control"),
         (11, "module type", 0, 0, "l", 8, 6, 4, 46, None, 1, "treatment")], TESTS)
    rows = spark.createDataFrame(
        [alloc(7, "1#6", 2, 3, 30), alloc(7, "1#6", 2, 4, 40), alloc(7, "1#6", 2, 5, 50),
         alloc(8, "1", 2, 3, 30), alloc(8, "1", 2, 5, 50),      # not in the tested segment: both types go
         alloc(8, "1", 3, 3, 31), alloc(8, "1", 3, 4, 41)], ALLOC)  # nothing would be left: restored
    got = {(r.test_keys, r.slot_position, r.module_type_id) for r in experiments.type_test_filter(rows, tests).collect()}
    assert got == {(7, 2, 3), (7, 2, 5), (8, 2, 5), (8, 3, 3), (8, 3, 4)}


def test_version_test_needs_the_same_placement_and_the_highest_segment_wins(spark):
    meta = spark.createDataFrame(
        [(30, "hero", "active published"), (90, "hero", "test published"), (91, "body", "test published"), (92, "hero", "test published")],
        "module_id int, placement_type string, status string",
    ).withColumns({"campaign_id": F.lit(1), "slot_position": F.lit(2), "campaign_segment_type_id": F.lit(1)})
    def arm(test, key, segment, module, flag=1):
        return (test, "module version", 0, 0, "l", key, segment, 3, 0, module, flag, "treatment" if flag else "control")

    tests = spark.createDataFrame(
        [arm(1, 7, 1, 90), arm(2, 7, 6, 92), arm(3, 7, 9, 91),   # 9 has another placement
         arm(1, 8, 1, None, 0), arm(1, 9, 4, 90)], TESTS)
    placed = experiments.tests_on_campaign(tests, meta)
    rows = spark.createDataFrame(
        [alloc(7, "1#6#9", 2, 3, 30), alloc(7, "1", 2, 3, 30), alloc(8, "1", 2, 3, 30), alloc(9, "1", 2, 3, 30)], ALLOC)
    got = {(r.test_keys, r.segment_set): r.module_id for r in experiments.version_test_replace(rows, placed, meta).collect()}
    assert got == {(7, "1#6#9"): 92, (7, "1"): 90, (8, "1"): 30, (9, "1"): 30}


def test_seeds_tokens_and_nulls(spark):
    rows = spark.createDataFrame(
        [(0, 0, "l", f"p{i}@x", i, i, 1, "None") for i in range(3)] + [(0, 0, "l", "q@x", None, 9, 2, "t")],
        f"{POS_COLS}, email_address string, paid long, test_keys int, campaign_id int, subject string",
    )
    seeds = spark.createDataFrame(
        [(0, 0, "l", f"s{i}@x", 1, "Merch") for i in (2, 1, 1)] + [(0, 0, "l", "off@x", 0, "Merch"), (9, 0, "l", "far@x", 1, "Merch")],
        f"{POS_COLS}, seed_email string, is_active int, category string",
    )
    out = enrichment.add_seeds(rows, enrichment.numbered_seeds(seeds, "Merch"), ["email_address"])
    made = sorted((r.campaign_id, r.email_address, r.test_keys) for r in out.where(F.col("paid") == SEED_ACCOUNT).collect())
    assert made == [(1, "s1@x", 0), (1, "s2@x", 1), (2, "s1@x", 9)]  # two seeds for three rows, then for one
    assert out.count() == 7
    a = spark.createDataFrame([(0, "t1"), (0, "t0")], "paid long, token string")
    b = spark.createDataFrame([(0, "u"), (1, "v")], "paid long, token string")
    tokens = {r.paid: r.user_token for r in enrichment.add_user_token(rows, a, b, "go/").collect()}
    assert tokens == {0: "go/t0/", 1: "go/v/", 2: ""}
    assert {r.subject for r in enrichment.none_to_null(rows).collect()} == {None, "t"}
