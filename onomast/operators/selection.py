"""Bounds below which no row can be among a group's largest, found without sorting or moving the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..sources.scratch import stage

#: Quantiles that a pass takes of each group, accuracy of the sketch they come from, and passes at most.
GRID, ACCURACY, PASSES = 1_000, 20_000, 6

_BOUND, _NUMBER, _GROUP = "_bound", "_number", "_group"


def _number_of(df: DataFrame, value: str) -> Column:
    """A numeric value as a double, in the same order but for ties; NaN is missing."""
    number = F.col(value).cast("double")
    return F.when(~F.isnan(number), number)


def largest_bounds(df: DataFrame, by: str, value: str, n: int) -> DataFrame | None:
    """(_group, _bound) of the groups with more than ``n`` values: about the n-th largest of each, or a little less.

    Every pass takes quantiles of what is left of each group as mergeable sketches and moves the bound up to the last one that has
    ``n`` rows above it however far the sketch may be off. Passes end when at most twice ``n`` rows a group are left, or when equal
    values stop the bounds. None if no group has more than ``n`` values.
    """
    present = df.select(F.col(by).alias(_GROUP), _number_of(df, value).alias(_NUMBER)).where(F.col(_NUMBER).isNotNull())
    counts = present.groupBy(_GROUP).agg(F.count("*").alias("left")).where(F.col("left") > n)
    bounds = stage(counts.withColumn(_BOUND, F.lit(float("-inf"))), "bounds")
    groups, left = bounds.agg(F.count("*"), F.sum("left")).first()
    if not groups:
        return None
    quantiles = [k / GRID for k in range(1, GRID)]
    for _ in range(PASSES):
        if left <= 2 * n * groups:
            break
        rows = present.join(bounds.select(_GROUP, _BOUND), _GROUP).where(F.col(_NUMBER) >= F.col(_BOUND))
        sums = rows.groupBy(_GROUP).agg(F.count("*").alias("now"), F.percentile_approx(_NUMBER, quantiles, ACCURACY).alias("at"), F.first(_BOUND).alias(_BOUND))
        last = F.floor((1 - n / F.col("now") - 2 / ACCURACY) * GRID).cast("int")
        moved = F.when(last >= 1, F.greatest(_BOUND, F.get("at", last - 1))).otherwise(F.col(_BOUND))
        rest = F.when(moved > F.col(_BOUND), F.ceil(F.col("now") * (GRID + 1 - last) / GRID)).otherwise(F.col("now"))
        bounds = stage(sums.select(_GROUP, rest.alias("left"), moved.alias(_BOUND)), "bounds")
        before, left = left, bounds.agg(F.sum("left")).first()[0]
        if left >= before:
            break
    return bounds.select(_GROUP, _BOUND)


def largest_candidates(df: DataFrame, by: str, value: str, n: int) -> DataFrame:
    """The rows of each group that can be among its ``n`` largest, written once.

    Rows that share the n-th value all pass, as does every row of a group with fewer values than ``n``. The table passes whole if its values
    are no numbers, no group is larger than ``n``, or, against all odds, a bound was too high, which exact counts would show.
    """
    if not isinstance(df.schema[value].dataType, NumericType):
        return df
    bounds = largest_bounds(df, by, value, n)
    if bounds is None:
        return df
    joined = df.join(bounds, F.col(by) == F.col(_GROUP), "left")
    few = stage(joined.where(F.col(_BOUND).isNull() | (_number_of(df, value) >= F.col(_BOUND))).select(*df.columns), "largest")
    counts = bounds.join(few.groupBy(F.col(by).alias(_GROUP)).agg(F.count("*").alias("rows")), _GROUP, "left")
    return df if counts.where(F.coalesce("rows", F.lit(0)) < n).count() else few
