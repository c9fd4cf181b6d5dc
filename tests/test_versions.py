"""Versions are ranked from distinct versions, not from a row per campaign, slot and module (F5)."""

from pyspark.sql import functions as F

from outreach.operators import metadata
from outreach.workload import queries
from outreach.workload.fixtures import Domain


def modules(spark):
    rows = [("en_us", t, 1, 0, p, "web", s, v, 100 * (t or 3) + n) for t in (1, 2, None) for p in ("hero", None) for s in ("active published", "draft", None) for v in (3, 1, None) for n in range(4)]
    return spark.createDataFrame(rows, "locale string, module_type_id int, tpid int, eapid int, placement_type string, channel string, status string, version int, module_id int")


def test_versions_rank_as_all_modules_do(spark):
    campaigns = spark.createDataFrame(
        [(c, t, "en_us", 1, 0) for c, t in ((1, 1), (1, 2), (2, 1), (None, 1))], "campaign_id int, template_id int, locale string, tpid int, eapid int"
    )
    templates = spark.createDataFrame([(t, 10 * k, s, "hero", "web", 0) for t in (1, 2) for k in (1, 2) for s in (1, t)], "template_id int, segment_module_map_id int, slot_position int, placement_type string, channel string, template_deleted_flag int")
    seg_map = spark.createDataFrame([(10, 1, 5, 0), (20, 2, 5, 0)], "segment_module_map_id int, module_type_id int, segment_type_id int, seg_mod_deleted_flag int")
    segments = spark.createDataFrame([(1, 0, 5, 0)], "tpid int, eapid int, segment_type_id int, segment_deleted_flag int")

    def rank(shown):
        found = metadata.campaign_metadata(campaigns, templates, seg_map, shown, segments)
        return sorted(map(str, metadata.version_rank(metadata.active_only(found)).collect())), found.count()

    every, n_every = rank(modules(spark))
    versions, n_versions = rank(metadata.module_versions(modules(spark)))
    assert versions == every and every
    assert n_versions < n_every  # four modules share a version


def test_the_query_does_not_meet_single_modules(spark, sf_dir, monkeypatch):
    seen = []
    made = metadata.campaign_metadata
    monkeypatch.setattr(metadata, "campaign_metadata", lambda *frames: seen.append(frames) or made(*frames))
    queries.version_rank(Domain(spark, sf_dir))
    per_version = seen[0][3].groupBy(*metadata.MODULE_KEY, "status", "version").agg(F.count(F.lit(1)).alias("n"))
    assert per_version.agg(F.max("n")).first()[0] == 1
