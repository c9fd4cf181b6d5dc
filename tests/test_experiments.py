"""The catalogue of tests and the gate of type tests."""

import pytest

from outreach.operators.experiments import campaigns_under_test, running_tests, sample_paths
from outreach.sources.tables import found_paths, read_listed

ASSIGNED = "test_id int, test_type string, segment_module_map_id int, control_test_flag int"


def test_catalogue_reads_what_is_there(spark, tmp_path):
    rows = spark.createDataFrame([(1, "module type", 16, 0)], ASSIGNED)
    paths = [str(tmp_path / n) for n in ("a", "b", "gone")]
    for p in paths[:2]:
        rows.write.parquet(p)
    catalogue = spark.createDataFrame(
        [(1, "en_US", paths[0]), (1, "en_US", paths[0]), (999, "en_US", paths[1]), (2, "fr_FR", paths[1]),
         (3, "en_US", paths[2]), (4, "en_US", None)],
        "test_id int, locale string, path string",
    )
    assert sample_paths(catalogue, "en_us") == [paths[0], paths[2]]
    assert sample_paths(catalogue) == paths
    assert read_listed(spark, sample_paths(catalogue, "EN_US"), rows.schema).count() == 1
    assert read_listed(spark, sample_paths(catalogue), rows.schema).count() == 2
    nothing = read_listed(spark, sample_paths(catalogue, "de_DE"), rows.schema)
    assert nothing.isEmpty() and nothing.schema == rows.schema
    assert found_paths(spark, paths) == paths[:2]
    with pytest.raises(Exception, match="nosuchscheme"):
        found_paths(spark, ["nosuchscheme://x/y"])


def test_type_tests_rest_without_a_control_slot(spark):
    tests = spark.createDataFrame(
        [(1, "module type", 16, 0), (1, "module type", 26, 1), (2, "module version", 36, 0)], ASSIGNED
    )
    def slots(*maps):
        return spark.createDataFrame([(7, m) for m in maps], "campaign_id int, segment_module_map_id int")

    assert [r.campaign_id for r in campaigns_under_test(tests, slots(16, 16, 26)).collect()] == [7]
    assert running_tests(tests, slots(16)).count() == 3
    # a treatment's slot or another kind of test opens nothing, nor does a run without slots
    for maps in ((26,), (36,)):
        assert running_tests(tests, slots(*maps)).isEmpty()
    assert running_tests(tests, slots(16).limit(0)).isEmpty()
