"""Steps that many queries share: templates parsed for modules that are allocated and once for all
that state them, and frames that do not need each other staged at the same time."""

import threading

import pytest
from pyspark.sql import functions as F

from outreach.operators import metadata
from outreach.plans.daily import Decisions, together
from outreach.sources.runs import RunLog

AT = "tpid int, eapid int, locale string, module_id int"
SITE = (1, 0, "en_us")


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def variables(spark):
    return spark.createDataFrame(
        [(*SITE, 1, 1, 1, "traveler.city|content.city", "%%content.best%% in %%traveler.city%%"),
         (*SITE, 1, 2, 1, "traveler.city|content.city", None), (*SITE, 2, 1, 1, None, "%%traveler.paid%%"),
         (*SITE, 3, 1, 1, "traveler.zip;traveler.city|content.zip", "%%traveler.paid%%"), (*SITE, 3, 1, 1, None, "%%traveler.open"),
         (*SITE, 4, None, 1, None, "x"), (1, 0, None, 5, 1, 1, "", "x"), (*SITE, None, 1, 1, "", "x"), (*SITE, None, 2, 1, "", "x")],
        f"{AT}, var_position int, source_connection int, var_source string, var_structure string",
    )


def test_templates_of_allocated_modules_are_parsed(spark):
    made = Decisions.__new__(Decisions)
    due = spark.createDataFrame([(*SITE, 1), (*SITE, 1), (*SITE, 3), (*SITE, 9), (1, 0, None, 5)], AT)
    made.log = RunLog()
    made.__dict__.update(due=due, variables=variables(spark))
    every = metadata.module_info(variables(spark))
    assert every.count() == 5
    assert rows(made.info) == rows(every.where(F.col("module_id").isin(1, 3)))


def test_modules_with_variables_are_those_told_of(spark):
    told = metadata.module_info(variables(spark)).drop("variables")
    assert rows(metadata.modules_with_variables(variables(spark))) == rows(told.select("tpid", "eapid", "locale", "module_id"))


def test_shared_templates_are_parsed_once(spark):
    found = metadata.needed_columns(variables(spark))
    assert rows(found) == rows(spark.createDataFrame([("city",), ("paid",), ("zip",)], "column_name string"))
    lines = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    parsed = [i for i, line in enumerate(lines) if "Generate explode" in line]
    assert len(parsed) == 2 and all(any("Aggregate" in line for line in lines[i + 1:i + 4]) for i in parsed)


def test_frames_are_made_at_the_same_time(spark):
    both = threading.Barrier(2, timeout=60)
    spark.sparkContext.setLocalProperty("test.told", "here")

    def step(n):
        both.wait()
        return spark.range(n), spark.sparkContext.getLocalProperty("test.told")

    (a, told), (b, other) = together(spark, lambda: step(2), lambda: step(3))
    assert (a.count(), b.count(), told, other) == (2, 3, "here", "here")
    with pytest.raises(ZeroDivisionError):
        together(spark, lambda: spark.range(1), lambda: 1 / 0)
