"""Sinks. Each writes a folder of files and replaces what was there; a retried task never leaves a row twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .scratch import delete_path


def write_csv(df: DataFrame, path: str, sep: str = ",", rows_per_file: int = 0) -> None:
    """Delimited files with a header, quoted only where needed; blanks at the ends of a value are kept."""
    df.write.mode("overwrite").options(
        sep=sep,
        header=True,
        quoteAll=False,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        maxRecordsPerFile=rows_per_file,
    ).csv(path)


def write_headerless(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Comma files without a header, in one folder for each value of the partition columns."""
    df.write.mode("overwrite").partitionBy(*(partition_by or [])).options(
        header=False, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet, compressed with zstd."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_records(df: DataFrame, path: str, drop: tuple[str, ...] = ("nombre_id",), schema: StructType | None = None) -> bool:
    """CSV without the helper columns, in the schema's column order if one is given; no output for an empty frame.

    The plan runs once: rows are counted as they are written, and an output without any is deleted.
    """
    if schema is not None:
        df = df.select(*schema.fieldNames())
    counted = Observation()
    write_csv(df.drop(*drop).observe(counted, F.count(F.lit(1)).alias("rows")), path)
    if counted.get["rows"]:
        return True
    delete_path(df.sparkSession, path)
    return False
