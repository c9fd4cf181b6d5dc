"""Repeatable samples for test sends."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outreach.operators.skew import first_per_group


def joined(keys: list[str]) -> Column:
    return F.concat_ws("|", *[F.col(k).cast("string") for k in keys])


def digest(keys: list[str]) -> Column:
    return F.md5(joined(keys))


def unit_hash(keys: list[str]) -> Column:
    """A number in [0, 1) fixed by the key columns."""
    return F.conv(F.substring(digest(keys), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def with_head(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows with the text that leading hash columns begin with, put together once for rows that a
    join repeats before they are sampled. NULL where all of them are, as those add nothing."""
    known = F.coalesce(*[F.col(k).cast("string") for k in keys]).isNotNull()
    return rows.withColumn(name, F.when(known, joined(keys)))


def stratified_sample(
    rows: DataFrame, stratum: str, keys: list[str], fraction: float = 0.01, head: str | None = None
) -> DataFrame:
    """The same fraction of every stratum, decided row by row: no shuffle, same rows on a
    rerun. The stratum enters the hash, so strata are sampled independently.

    Rows stay whose `unit_hash` is below the fraction. Hex digits sort as numbers do, so the
    digest is compared as text. `head` names a column of `with_head` for the stratum and the
    first keys; `keys` then has the others.
    """
    bound = ceil(fraction * 2**32)
    if bound >= 2**32:
        return rows
    return rows.where(digest([head or stratum, *keys]) < f"{max(bound, 0):08x}")


def sample_per_code(rows: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """At most n rows of each module code, chosen by hash."""
    return first_per_group(rows, ["module_code"], [digest(keys), *keys], n)
