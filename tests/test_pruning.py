"""A run reads the columns and look-up tables it uses, and nothing else."""

import os
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from outreach.operators.content import content_rows, only_read
from outreach.operators.metadata import file_columns, join_specs
from outreach.operators.slots import module_code
from outreach.params import POS
from outreach.plans.daily import Decisions
from outreach.workload.fixtures import Domain
from outreach.workload.queries import decisions


def read_columns(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan)]


SF = os.environ.get("TEST_RUN_DIR", "/root/testdata/sf0.01")


def test_wide_profile_and_unused_tables(spark, tmp_path):
    if not os.path.isdir(SF):
        pytest.skip(f"no tables in {SF}")
    plain = decisions(Domain(spark, SF))
    i = plain.inputs
    wide = i.travelers.withColumns({f"trait_{n}": F.lit(n) for n in range(200)})
    wide.write.parquet(str(tmp_path / "travelers"))
    i.files["content"].withColumns({f"note_{n}": F.lit("x") for n in range(50)}).write.parquet(str(tmp_path / "content"))
    never = i.files["content"].withColumn("best", F.raise_error(F.lit("scanned a table that nothing reads")).cast("string"))
    # a module that no campaign offers names a further file
    idle = i.variables.limit(1).withColumns({
        "module_id": F.lit(-5).cast(i.variables.schema["module_id"].dataType),
        "var_source": F.lit("traveler.city|idle.city"), "var_structure": F.lit("%%idle.best%% %%traveler.trait_7%%"),
    })
    made = Decisions(replace(
        i, travelers=spark.read.parquet(str(tmp_path / "travelers")), variables=i.variables.unionByName(idle),
        files={"content": spark.read.parquet(str(tmp_path / "content")), "idle": never}, carried=["trait_9"],
    ), plain.run)
    def codes(run):
        return sorted(map(tuple, run.winners.select("user_id", "campaign_id", module_code(F.col("picks"))).collect()))

    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # whole schemas in the plan's text
    scans = [c for c in read_columns(made.travelers) if "user_id" in c]
    # trait_7 is in a template, trait_9 is carried; the other 198 are never read
    assert any("first_name" in c for c in scans)
    for c in scans:
        assert {n for n in c if n.startswith("trait_")} == ({"trait_7", "trait_9"} if "first_name" in c else set())
    used = file_columns(join_specs(made.offered_variables))
    assert set(used) == {"content"}
    found = content_rows(only_read(made.inputs.files, used), made.specs)
    assert [c for c in read_columns(found) if "best" in c] == [{*POS, "city", "best"}]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert codes(made) == codes(plain) != []


def test_no_look_up_at_all(spark):
    specs = spark.createDataFrame([], "tpid int, eapid int, locale string, spec string, file string, left_keys array<string>, right_keys array<string>")
    assert content_rows({}, specs).isEmpty()
    variables = spark.createDataFrame(
        [(1, 1, "traveler.a;traveler.b|f.k;f.l", "%%f.v%% %%traveler.c%%"), (2, 1, "traveler.a|f.k", "%%f.w%%"), (3, 1, None, "x"),
         (4, 1, "traveler.a|g.k", "no token"), (5, 1, "traveler.a|h.k", None)],
        "module_id int, var_position int, var_source string, var_structure string",
    )
    assert file_columns(join_specs(variables)) == {"f": ["k", "l", "v", "w"]}
