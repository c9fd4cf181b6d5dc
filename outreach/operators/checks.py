"""Checks that stop a run before it sends nonsense."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class CheckFailed(Exception):
    """A required frame is empty or a reference is missing."""


class NothingToSend(CheckFailed):
    """The run is sound and has nothing to do: it ends without output."""


def row_guards(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per named frame: its row count and whether it has any."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("frame"), "n_rows", (F.col("n_rows") > 0).alias("ok")
        )
        for name, df in frames.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), rows)


def require_rows(df: DataFrame, message: str, fault: type[CheckFailed] = CheckFailed) -> None:
    if df.isEmpty():
        raise fault(message)


def require_none(missing: DataFrame, column: str, message: str) -> None:
    """Raise if `missing` has rows, naming the first few."""
    names = [str(r[0]) for r in missing.select(column).orderBy(column).take(20)]
    if names:
        raise CheckFailed(f"{message}: {', '.join(names)}")


def missing_schedule(campaigns: DataFrame, schedule: DataFrame) -> DataFrame:
    return campaigns.select("campaign_id").distinct().join(schedule, "campaign_id", "left_anti")


def conflicting_priorities(campaigns: DataFrame) -> DataFrame:
    """Campaigns listed with more than one priority."""
    spread = campaigns.groupBy("campaign_id").agg(F.count_distinct("priority").alias("n_priorities"))
    return spread.where(F.col("n_priorities") > 1)
