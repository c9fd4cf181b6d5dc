"""Date expressions. Every one is a pure function of its inputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PACIFIC = "America/Los_Angeles"
INDIA = "Asia/Kolkata"


def rotation_seed(day: Column) -> Column:
    """ISO week plus weekday (Monday is 0): moves on by one every day."""
    return F.weekofyear(day) + F.weekday(day)


def in_zone(utc: Column, zone: str = PACIFIC) -> Column:
    """Wall clock in `zone` of a UTC timestamp without zone; session zone plays no part."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def launch_date(utc: Column) -> Column:
    """Pacific date, except late in the Pacific evening, when the Indian date is used.

    The instant is an argument, so both zones see the same moment.
    """
    pacific = in_zone(utc)
    return F.when(F.hour(pacific) > 20, F.to_date(in_zone(utc, INDIA))).otherwise(
        F.to_date(pacific)
    )


def compact_date(day: Column) -> Column:
    """2001-08-01 as the integer 20010801."""
    return F.date_format(day, "yyyyMMdd").cast("int")


def issue_id(launch_time_utc: Column) -> Column:
    """Midnight launch text such as 2001-08-01T00:00:00Z as 20010801."""
    day = F.replace(launch_time_utc, F.lit("T00:00:00Z"), F.lit(""))
    return F.replace(day, F.lit("-"), F.lit(""))
