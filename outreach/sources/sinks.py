"""Output tables: one folder per campaign, module lists, manifest, metadata snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outreach.functions.dates import compact_date
from outreach.functions.text import program_part

MAX_FILE_ROWS = 5_000_000


def folder_name(name: Column) -> Column:
    """A name as part of a path: letters, digits, dot, dash and underscore stay. Names that
    become equal are told apart by the SID in their path."""
    safe = F.regexp_replace(F.coalesce(name, F.lit("")), r"(?U)[^\w.-]", "_")
    return F.when(safe == "", F.lit("unnamed")).otherwise(safe)


def site_root(root: str, locale: Column) -> Column:
    """Folder of one locale below a root."""
    return F.concat(F.lit(f"{root}/site="), folder_name(locale))


def audience_folder(root: str | Column, launch_date: Column, audience: Column, sid: Column) -> Column:
    """Where `write_campaigns` puts a campaign below its root."""
    return F.concat(
        _text(root), F.lit("/launch_date="), launch_date.cast("string"), F.lit("/audience="), folder_name(audience),
        F.lit("/sid="), sid.cast("string"),
    )


def modules_folder(root: str | Column, campaign_id: Column) -> Column:
    """Where `write_modules` puts a campaign's module list below its root."""
    return F.concat(_text(root), F.lit("/campaign_id="), campaign_id.cast("string"))


def _text(value: str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def with_program_parts(campaigns: DataFrame) -> DataFrame:
    c = F.col("program_type")
    names = ("subchannel", "program", "campaign_code", "lob_intent")
    return campaigns.withColumns({n: program_part(c, i) for i, n in enumerate(names)})


def _numbered(keys: DataFrame) -> DataFrame:
    """Distinct (launch_date, campaign_id) with their rank. They are numbered inside a launch
    date and moved on by the campaigns of earlier dates, so no window covers the whole table
    except the one over distinct dates."""
    per_date = keys.groupBy("launch_date").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("launch_date").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_date.select("launch_date", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    rank = F.row_number().over(Window.partitionBy("launch_date").orderBy("campaign_id"))
    return keys.withColumn("_rank", rank).join(offsets, "launch_date").select(
        "launch_date", "campaign_id", (F.col("_offset") + F.col("_rank")).cast("long").alias("_place")
    )


def audience_master(
    campaigns: DataFrame, environment: str, run_time: Column, stored: DataFrame | None = None
) -> DataFrame:
    """Master rows of the campaigns with their SID: the rank of (launch date, campaign).

    With `stored`, the master rows of earlier runs, a campaign that has a SID for its launch
    date keeps it, and the others are numbered on from the largest one, so a SID never
    stands for two campaigns and a rerun gives the same ones.
    """
    rows = with_program_parts(
        campaigns.select(
            "campaign_type_id", "campaign_id", "audience_name", "template_id",
            "campaign_segment_type_id", "launch_date", "locale", "program_type",
        ).distinct()
    )
    day = compact_date(F.col("launch_date"))
    keys = rows.select("launch_date", "campaign_id").distinct()
    if stored is None:
        numbered = _numbered(keys).withColumn("_sid", F.col("_place"))
    else:
        known = stored.select(
            "campaign_id", F.col("campaign_date").alias("_day"), F.col("sid").alias("_sid")
        ).distinct()
        told = keys.withColumn("_day", day).join(known, ["campaign_id", "_day"], "left").select(
            "launch_date", "campaign_id", "_sid"
        )
        largest = F.coalesce(stored.agg(F.max("sid")).scalar(), F.lit(0))
        fresh = _numbered(told.where(F.col("_sid").isNull()).select("launch_date", "campaign_id"))
        numbered = told.where(F.col("_sid").isNotNull()).unionByName(
            fresh.select("launch_date", "campaign_id", (F.col("_place") + largest).alias("_sid"))
        )
    return (
        rows.join(numbered, ["launch_date", "campaign_id"])
        .select(
            "campaign_type_id", "campaign_id", F.col("audience_name").alias("campaign_name"),
            "template_id", F.col("campaign_segment_type_id").alias("segment_id"),
            run_time.alias("run_date"), day.alias("campaign_date"), "subchannel", "program",
            "campaign_code", "lob_intent", "locale", day.alias("partition_date_key"),
            F.lit(environment).alias("environment"), run_time.alias("load_date"),
            F.col("_sid").cast("long").alias("sid"),
        )
    )


def append_master(rows: DataFrame, stored: DataFrame | None, path: str) -> None:
    """Adds the master rows that are not stored yet, by campaign, date and locale; after a
    run that is repeated there are none."""
    key = ["campaign_id", "campaign_date", "locale"]
    new = rows if stored is None else rows.join(stored.select(*key).distinct(), key, "left_anti")
    new.write.mode("append").parquet(path)


def campaign_summary(campaigns: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows per campaign and locale, with those that got none marked as suppressed."""
    key = ["campaign_id", "locale"]
    counts = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
    return (
        campaigns.select(*key, "audience_name", "launch_date").distinct()
        .join(counts, key, "left")
        .withColumn("n_rows", F.coalesce("n_rows", F.lit(0)).cast("long"))
        .withColumn("suppressed", (F.col("n_rows") == 0).cast("int"))
    )


def _schedule_key(schedule: DataFrame) -> list[str]:
    return [c for c in ("campaign_id", "locale") if c in schedule.columns]


def unscheduled(summary: DataFrame, schedule: DataFrame) -> DataFrame:
    """Campaigns and locales that no schedule names; the manifest does not list them."""
    return summary.join(schedule, _schedule_key(schedule), "left_anti")


def manifest(
    summary: DataFrame, schedule: DataFrame, root: str, by_site: bool = False, suppressed: str | None = None
) -> DataFrame:
    """Written folders joined with their schedule and sorted by it: the audience of every
    campaign, and the module list of those that were not suppressed.

    A schedule with a locale counts for that locale alone. `by_site` names folders as they
    are written for one locale each, and `suppressed` the folder that stands for the
    audience of suppressed campaigns.
    """
    audience_root, module_root = f"{root}/campaigns", f"{root}/modules"
    if by_site:
        audience_root, module_root = (site_root(r, F.col("locale")) for r in (audience_root, module_root))

    def entry(name: Column, path: Column) -> list[Column]:
        return [F.col("campaign_id"), F.col("locale"), name.alias("staging_filename"), path.alias("path"), F.col("sid")]

    folder = audience_folder(audience_root, F.col("launch_date"), F.col("file_name"), F.col("sid"))
    if suppressed is not None:
        folder = F.when(F.col("suppressed") == 1, F.lit(suppressed)).otherwise(folder)
    audiences = summary.select(*entry(F.col("file_name"), folder))
    modules = summary.where(F.col("suppressed") == 0).select(
        *entry(F.concat("file_name", F.lit("_modules")), modules_folder(module_root, F.col("campaign_id")))
    )
    key = _schedule_key(schedule)
    return (
        audiences.unionByName(modules)
        .join(schedule.select(*key, "scheduled_launch_time"), key)
        .drop("locale")
        .orderBy("scheduled_launch_time", "staging_filename")
    )


def pick_schedule(details: DataFrame, jobs: DataFrame, enabled: DataFrame) -> DataFrame:
    """Schedule rows of enabled locales from the launch details, of all others from the
    job mapping. Locales are compared whole and without regard to case."""
    on = enabled.select(F.lower("locale").alias("_l")).distinct()
    wanted = ["campaign_id", "locale", "scheduled_launch_time"]
    def gate(df: DataFrame, how: str) -> DataFrame:
        return df.join(on, F.lower(df["locale"]) == on["_l"], how).select(*wanted)

    return gate(details, "left_semi").unionByName(gate(jobs, "left_anti"))


def write_campaigns(rows: DataFrame, path: str) -> None:
    """One folder per site (if the rows have one), launch date, audience and SID, named as
    `site_root` and `audience_folder` have it.

    REBALANCE puts a campaign's rows together and splits those of a large one over several
    tasks, so neither small files nor one giant task result.
    """
    keys = [*_site(rows), "launch_date", "audience", "sid"]
    (
        rows.drop("campaign_id").withColumn("audience", folder_name(F.col("audience"))).hint("rebalance", *keys)
        .write.mode("overwrite").option("maxRecordsPerFile", MAX_FILE_ROWS)
        .partitionBy(*keys).parquet(path)
    )


def _site(rows: DataFrame) -> list[str]:
    return ["site"] if "site" in rows.columns else []


def write_suppressed(rows: DataFrame, path: str) -> None:
    """The one folder that stands for all suppressed campaigns: no rows, the columns of the
    others. One small job, however many campaigns were suppressed."""
    shape = rows.drop("campaign_id", "site", "launch_date", "audience", "sid").schema
    rows.sparkSession.createDataFrame([], shape).coalesce(1).write.mode("overwrite").parquet(path)


def write_modules(modules: DataFrame, path: str) -> None:
    modules.write.mode("overwrite").partitionBy(*_site(modules), "campaign_id").parquet(path)


def write_manifest(rows: DataFrame, path: str) -> None:
    """One sorted file: a few rows per campaign."""
    rows.coalesce(1).write.mode("overwrite").parquet(path)


def snapshot_metadata(meta: DataFrame, run_date: Column, path: str) -> None:
    """Replaces the snapshot of this run's locales and date; others stay."""
    dated = meta.withColumn("run_date", run_date)
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("locale", "run_date").parquet(path)


def run_folder(environment: str, job: str, test: str | None, date: str, locale: str | None, program: str) -> str:
    """Folder of one run below the output root."""
    parts = {
        "env": environment, "job": job, "test_type": test or "none", "launch_date": date,
        "locale": locale or "all", "program": program,
    }
    return "/".join(f"{k}={v}" for k, v in parts.items())
