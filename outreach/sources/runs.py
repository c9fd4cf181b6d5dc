"""The run log: finding upstream output and reporting status."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from outreach.functions.dates import in_zone
from outreach.operators.checks import CheckFailed
from outreach.sources.staging import stage

RUN_LOG = StructType([
    StructField("source_name", StringType()),
    StructField("source_id", IntegerType()),
    StructField("is_complete", IntegerType()),
    StructField("status", StringType()),
    StructField("start_date", TimestampNTZType()),
    StructField("end_date", TimestampNTZType()),
    StructField("error_message", StringType()),
    StructField("row_counts", IntegerType()),
    StructField("file_path", StringType()),
])


def latest_run(log: DataFrame, source_name: str, by: str = "start_date") -> DataFrame:
    """Newest finished run of each source id. `max_by` combines before the shuffle, so a
    source with a third of the log costs no more than any other."""
    newest = F.max_by(F.struct("log_id", "file_path"), F.struct(by, "log_id"))
    return (
        log.where((F.col("is_complete") == 1) & (F.col("source_name") == source_name))
        .groupBy("source_id")
        .agg(newest.alias("_run"))
        .select("source_id", "_run.log_id", "_run.file_path")
    )


def latest_batch(rows: DataFrame, column: str) -> DataFrame:
    """Rows of the newest batch; the maximum is a scalar subquery of the same table."""
    return rows.where(F.col(column) == rows.agg(F.max(column)).scalar())


def run_log_rows(
    log: DataFrame, status: Column, error: Column, row_counts: Column
) -> DataFrame:
    """Status rows of the log's shape, times moved from UTC to the Pacific wall clock."""
    made = {
        "status": status, "error_message": error, "row_counts": row_counts,
        "start_date": in_zone(F.col("start_date")), "end_date": in_zone(F.col("end_date")),
    }
    out = log.withColumns(made)
    return out.select(*[F.col(f.name).cast(f.dataType) for f in RUN_LOG.fields])


# What a run notes of its steps: the log's columns, counts of any size, times in UTC.
STEPS = StructType([
    StructField(f.name, LongType()) if f.name == "row_counts"
    else StructField(f.name, TimestampType()) if f.name.endswith("_date") else f
    for f in RUN_LOG.fields
])


class RunLog:
    """What one run did: a row per step, kept on the driver until it is written.

    A step's rows are counted while its frame is written, so the log costs no job of its own.
    With `guarded`, a step that is needed and has no rows stops the run under its name.
    Nothing here reads a clock: times come from `clock`, with their zone, and are NULL without one.
    """

    def __init__(
        self, source_name: str = "outreach", source_id: int = 0,
        clock: Callable[[], dt.datetime] | None = None, guarded: bool = False,
    ):
        self.source_name, self.source_id, self.guarded = source_name, source_id, guarded
        self.clock = clock or (lambda: None)
        self.steps: list[tuple] = []

    def note(self, status: str, n_rows: int = 0, started=None, error: str | None = None, path: str | None = None) -> None:
        done = int(error is None)
        self.steps.append(
            (self.source_name, self.source_id, done, status, started or self.clock(), self.clock(), error, n_rows, path)
        )

    def stage(self, df: DataFrame, step: str, fault: type[CheckFailed] | None = None) -> DataFrame:
        """Stage a frame and note its rows; `fault` is raised where none is not allowed."""
        return self._write(df, step, fault, stage)

    def written(self, df: DataFrame, step: str, write: Callable[[DataFrame], None], path: str) -> None:
        """Write a frame by `write` and note its rows and where they went."""
        self._write(df, step, None, write, path)

    def _write(self, df, step, fault, write, path=None):
        seen, started = Observation(), self.clock()
        out = write(df.observe(seen, F.count(F.lit(1)).alias("n_rows")))
        n = seen.get["n_rows"]
        if self.guarded and fault is not None and n == 0:
            raise fault(f"{step}: no rows")
        self.note(step, n, started, path=path)
        return out

    def rows(self, spark: SparkSession) -> DataFrame:
        """The steps so far in the shape of the log, times as Pacific wall clock."""
        made = spark.createDataFrame(self.steps, STEPS)
        local = {c: in_zone(F.col(c)) for c in ("start_date", "end_date")}
        return made.withColumns(local).select(
            *[F.col(f.name) if f.name == "row_counts" else F.col(f.name).cast(f.dataType) for f in RUN_LOG.fields]
        )


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)
