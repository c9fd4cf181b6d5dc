"""Expressions on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from outreach.functions import dates, templates, text
from outreach.params import RunParams


def one(spark, schema, row, *columns):
    return tuple(spark.createDataFrame([row], schema).select(*columns).first())


@pytest.mark.parametrize(
    "program, parts",
    [
        ("a.b", ("a", "b", None, None)),
        ("a.b.c", ("a", "b", "c", None)),
        ("a..b...c.d", ("a", "b", "c", "d")),
        ("a.b.c.d.e", ("a", "b", "c", "d")),
        (None, (None,) * 4),
    ],
)
def test_program_parts(spark, program, parts):
    c = F.col("p")
    assert one(spark, "p string", (program,), *[text.program_part(c, i) for i in range(4)]) == parts


def test_pad_keeps_long_ids(spark):
    for value, want in [(7, "000000007"), (123456789, "123456789"), (1234567890, "1234567890")]:
        assert one(spark, "n long", (value,), text.pad_id(F.col("n"))) == (want,)


def test_join_spec(spark):
    spec = "traveler.a;traveler.b|hotels.x;hotels.y"
    c = F.col("s")
    got = one(spark, "s string", (spec,), text.spec_file(c), text.spec_side(c, 1), text.spec_side(c, 2))
    assert got == ("hotels", ["a", "b"], ["x", "y"])
    assert one(spark, "s string", ("traveler.a",), text.spec_file(c), text.spec_side(c, 1)) == (None, ["a"])


@pytest.mark.parametrize(
    "template, want",
    [
        ("%%traveler.a%% and %%traveler.ab%%", "1 and 2"),          # one token a prefix of another
        ("open %%traveler.a", "open traveler.a"),                    # unpaired marker is a literal
        ("%%traveler.a%%|%%f.c.d%%", "1|9"),                         # second dot: the middle name counts
        ("%%f.missing%% %%other.c%%", "value_not_found value_not_found"),
        ("%%traveler.empty%%", "value_not_found"),
        ("", ""),
        (None, ""),
        ("plain", "plain"),
    ],
)
def test_rendering(spark, template, want):
    attributes = F.expr("map('a', '1', 'ab', '2', 'empty', '')")
    parts = templates.parse(F.col("t"), F.lit("f"), F.lit(3))
    filled = templates.fill(parts, attributes, F.expr("map('c', '9')"))
    assert one(spark, "t string", (template,), templates.text_of(filled)) == (want,)


def test_token_names(spark):
    parts = templates.parse(F.col("t"), F.lit("f"), F.lit(3))
    names = F.transform(parts, lambda p: p["name"])
    got = one(spark, "t string", ("%%traveler.City%%x%%f.Best%%",), names)[0]
    assert got == [None, "city_1", None, "best_3", None]


@pytest.mark.parametrize(
    "value, strict, legacy",
    [
        ("x value_not_found", True, True), ("None", True, True), ("nan", True, True),
        ("Finance", False, True), ("is null here", True, True), ("nones", False, False), ("", False, False),
    ],
)
def test_unresolved(spark, value, strict, legacy):
    c = F.col("v")
    got = one(spark, "v string", (value,), templates.is_unresolved(c), templates.is_unresolved(c, True))
    assert got == (strict, legacy)


def test_option_rotation(spark):
    seed = RunParams(run_date=dt.date(2001, 8, 1)).seed
    for key in range(5):
        for options in ("a", "a|b", "a|b|c", "a|b|c|d"):
            parts = options.split("|")
            n = len(parts) - 1
            want = "None" if n == 0 else parts[1] if n == 1 else parts[1 + (key + seed % n) % n]
            chosen = templates.choose(templates.options(F.col("o")), F.lit(key), F.lit(seed), F.lit(False))
            assert one(spark, "o string", (options,), chosen) == (want,)


def test_seed_equals_python_calendar(spark):
    days = [dt.date(2024, 12, 30), dt.date(2021, 1, 3), dt.date(2020, 12, 31), dt.date(2001, 8, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date").select("d", dates.rotation_seed(F.col("d")).alias("s"))
    assert {r.d: r.s for r in df.collect()} == {d: d.isocalendar()[1] + d.weekday() for d in days}


@pytest.mark.parametrize(
    "utc, day",
    [
        (dt.datetime(2024, 1, 2, 4, 59), dt.date(2024, 1, 1)),   # 20:59 Pacific
        (dt.datetime(2024, 1, 2, 5, 0), dt.date(2024, 1, 2)),    # 21:00 Pacific, next day in India
        (dt.datetime(2024, 7, 2, 3, 30), dt.date(2024, 7, 1)),   # 20:30 in summer time
        (dt.datetime(2024, 1, 2, 8, 0), dt.date(2024, 1, 2)),    # midnight Pacific
    ],
)
def test_launch_date(spark, utc, day):
    assert one(spark, "t timestamp_ntz", (utc,), dates.launch_date(F.col("t"))) == (day,)


def test_recipient_id_and_tag(spark):
    schema = "brand string, site string, p string, sid long, paid string, mer string, code string"
    def build(row):
        c = {f: F.col(f) for f in ("brand", "site", "p", "sid", "paid", "mer", "code")}
        rid = text.recipient_id(
            c["brand"], c["site"], [c["p"]] * 4, F.lit("20010801"), c["sid"], F.lit("K"), c["paid"],
            F.lit("en_us"), c["mer"], c["code"], "HOME",
        )
        return one(spark, schema, row, rid, text.rewrite_tag(rid, F.lit("2#0")))

    rid, tagged = build(("HOME", " X ", "a", 5, " 77 ", "1", "1-3_2-4"))
    assert rid == "X.a.a.a.a&EMLDTL=DATE20010801.SID5.KEYK.PAID77.LANGEN_US.MCIDM.TEST1.VERSX.MIDS1-3_2-4"
    assert ".TEST2.VERS0.MIDS" in tagged
    assert build(("OTHER", "X", "a", 5, "77", "0", "c"))[0].startswith("OTHER-X.a")
    assert ".MCIDC." in build(("HOME", "X", "a", 5, "77", None, "c"))[0]
    assert build(("HOME", None, "a", 5, "77", "1", "c")) == (None, None)
    assert build(("HOME", "X", "a", None, "77", "1", "c")) == (None, None)
