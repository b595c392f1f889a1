"""National and state files of births as two tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.readers import scan_headerless, with_path_int
from ..sources.writers import write_parquet

# File names and columns of the two sources.
YEAR_FILES, YEAR_PATTERN = "yob*.txt", r"/[^/]{3}([^/.]+)\.[^/]*$"
STATE_FILES = "*.TXT"
YEAR_SCHEMA = "name string, sex string, count int"
STATE_SCHEMA = "state string, sex string, year int, name string, count int"


def us_national(
    spark: SparkSession, path: str, glob: str = YEAR_FILES, year: str = YEAR_PATTERN, recursive: bool = False
) -> DataFrame:
    """Name, sex, count and the year out of the file's name."""
    return with_path_int(scan_headerless(spark, path, YEAR_SCHEMA, glob, recursive), "year", year)


def us_state(spark: SparkSession, path: str, glob: str = STATE_FILES, recursive: bool = False) -> DataFrame:
    """State, sex, year, name, count."""
    return scan_headerless(spark, path, STATE_SCHEMA, glob, recursive)


def convert_national(spark: SparkSession, path: str, out: str, partition_by: list[str] | None = None) -> None:
    """Write the national files as one table, for instance one folder per year."""
    write_parquet(us_national(spark, path), out, partition_by)


def convert_state(spark: SparkSession, path: str, out: str, partition_by: list[str] | None = None) -> None:
    """Write the state files as one table."""
    write_parquet(us_state(spark, path), out, partition_by)
