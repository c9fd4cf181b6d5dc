"""Tables by name, from parquet folders, CSV files or JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class TableSource:
    """Where named tables live. JDBC options (url, driver, user, password) come from the
    caller; the JDBC branch needs a server and is not covered by the tests."""

    kind: str = "parquet"              # or "jdbc"
    root: str = ""
    suffix: str = ".parquet"
    options: dict[str, str] = field(default_factory=dict, repr=False)


def read_table(spark: SparkSession, name: str, source: TableSource) -> DataFrame:
    """A whole table; columns and filters applied to it reach the scan."""
    if source.kind == "jdbc":
        return spark.read.format("jdbc").options(**source.options).option("dbtable", name).load()
    return spark.read.parquet(f"{source.root}/{name}{source.suffix}")


def read_query(spark: SparkSession, query: str, source: TableSource) -> DataFrame:
    """A query run by the database; only for JDBC sources."""
    if source.kind != "jdbc":
        raise ValueError("a query can only be pushed to a JDBC source; filter the table instead")
    return spark.read.format("jdbc").options(**source.options).option("query", query).load()


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header, with a stated schema so that no pass is spent on inference."""
    return spark.read.option("header", True).schema(schema).csv(path)


def read_many(spark: SparkSession, paths: list[str], empty: StructType) -> DataFrame:
    """All paths as one frame; an empty frame of the given schema when there are none.
    A path that cannot be read raises and is named by Spark."""
    if not paths:
        return spark.createDataFrame([], empty)
    return spark.read.schema(empty).parquet(*paths)


def found_paths(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of the paths that exist; any other fault of a path is raised. Looking lists a
    folder and starts no job."""
    found = []
    for path in paths:
        try:
            spark.read.format("binaryFile").load(path)
        except AnalysisException as fault:
            if fault.getCondition() != "PATH_NOT_FOUND":
                raise
        else:
            found.append(path)
    return found


def read_listed(spark: SparkSession, paths: list[str], schema: StructType) -> DataFrame:
    """The listed tables as one frame of the given schema. Paths that are gone are passed over;
    with none left the frame is empty."""
    return read_many(spark, found_paths(spark, paths), schema)


def load_config_set(
    spark: SparkSession, names: list[str], source: TableSource, surrogate: str = "id"
) -> dict[str, DataFrame]:
    """Configuration tables by name, without their surrogate key."""
    return {n: read_table(spark, n, source).drop(surrogate) for n in names}
