"""Payloads of series and regions as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import decimal_comma, whole_number


def explode_series(df: DataFrame, label: str = "decade", amount: str = "amount") -> DataFrame:
    """One row per pair of ``ticks`` and ``values``, up to the shorter list; points without an amount are left out."""
    pairs = F.least(F.size("ticks"), F.size("values"))
    zipped = F.arrays_zip(
        F.slice("ticks", F.lit(1), pairs).alias("tick"), F.slice("values", F.lit(1), pairs).alias("value")
    )
    rest = [c for c in df.columns if c not in ("ticks", "values")]
    # The outer form: the planner adds a filter for empty lists below the other one, which would parse every payload twice.
    points = df.select(*rest, F.explode_outer(zipped).alias("point"))
    return points.select(*rest, F.col("point.tick").alias(label), F.col("point.value").alias(amount)).where(
        F.col(amount).isNotNull()
    )


def explode_regions(df: DataFrame) -> DataFrame:
    """One row per region with a whole id and a readable rate; other regions are left out."""
    rest = [c for c in df.columns if c != "regiones"]
    regions = df.select(*rest, F.explode_outer("regiones").alias("region"))
    return regions.select(
        *rest,
        whole_number(F.col("region.id")).alias("region_id"),
        decimal_comma(F.col("region.val")).alias("percentage"),
    ).where("region_id is not null and percentage is not null")
