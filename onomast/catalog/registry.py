"""Named queries over the test tables, each with the SQL that gives the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.readers import spread_small
from ..sources.scratch import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one folder, read on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)
        return table

    def spread(self, name: str) -> DataFrame:
        """A table for work that needs all cores, however few splits it has."""
        return spread_small(getattr(self, name))

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)


def query(key: str, sql: str | None = None):
    """Register a function of the tables under a key."""

    def register(build: Callable[[Tables], DataFrame]):
        @functools.wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(spark, folder))

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return build

    return register
