"""Positions, ranks and top lists that no single group can hold up."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import settled, stage
from .selection import largest_candidates

ROWS_PER_TASK = 1_000_000
MAX_RANGES = 20_000
COPY_SAMPLE = 200_000

_PART, _AT, _COPIES, _START = "_part", "_at", "_copies", "_start"
_DIRECTIONS = {"asc": F.asc_nulls_last, "desc": F.desc_nulls_last}


def hashable(df: DataFrame) -> list[str]:
    """Columns that can be hashed and grouped by; maps and variants cannot."""
    return [f.name for f in df.schema if not any(kind in f.dataType.simpleString() for kind in ("map<", "variant"))]


def first_in_task(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The first ``n`` rows of each partition; sorts inside the tasks, can spill and moves nothing."""
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return df.sortWithinPartitions(*order).withColumn(_AT, place).where(F.col(_AT) < n).drop(_AT)


def _buckets(df: DataFrame) -> int:
    """Width of the middle level of a tree: about the square root of the session's shuffle partitions."""
    return math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def without_nan(df: DataFrame, value: str) -> Column:
    """A value to sort by in which NaN is missing."""
    floating = df.schema[value].dataType.typeName() in ("float", "double")
    return F.when(~F.isnan(value), F.col(value)) if floating else F.col(value)


def ordering(value: str | Column, ties: list[str], direction: str = "desc") -> list[Column]:
    """Sort order by a value, nulls last, then by the tie columns ascending."""
    return [_DIRECTIONS[direction](value), *[F.asc_nulls_last(t) for t in ties]]


def _all_present(by: list[str]) -> Column:
    present = F.lit(True)
    for name in by:
        present = present & F.col(name).isNotNull()
    return present


def _by_window(df: DataFrame, by: list[str], order: list[Column], out: str) -> DataFrame:
    """Numbering with one task per group. Rows without a group get no number and are spread over all tasks."""
    if not by:
        return df.withColumn(out, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    present = _all_present(by)
    spread = F.when(~present, F.xxhash64(*hashable(df)))
    number = F.row_number().over(Window.partitionBy(*by, _PART).orderBy(*order)).cast("bigint")
    return df.withColumn(_PART, spread).withColumn(out, F.when(present, number)).drop(_PART)


def _has_hot_copies(df: DataFrame, keys: list[str], rows: int, rows_per_task: int) -> bool:
    """Whether, going by a sample, more than two tasks' worth of rows are equal in all sorting columns."""
    fraction = min(1.0, COPY_SAMPLE / max(rows, 1))
    sample = df.select(*keys) if fraction == 1.0 else df.select(*keys).sample(fraction, seed=1)
    most = sample.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    return most >= 3 and most / fraction > 2 * rows_per_task


def _floating(kind: str) -> bool:
    return "float" in kind or "double" in kind


def _by_ranges(
    df: DataFrame, by: list[str], order: list[Column], keys: list[str], out: str, rows: int, rows_per_task: int, max_ranges: int
) -> DataFrame:
    """Numbering by ranges of the sort order, so that a group of any size takes as many tasks as it needs.

    Each range numbers its own rows; the rows a group has in earlier ranges are added from a table that has one line
    per range and group. A range holds a run of the sort order, so that table has at most as many lines as there are
    ranges and groups together. The ranges are written once, which fixes their limits for the second step.
    """
    columns = df.columns
    sort = [*[F.asc_nulls_last(b) for b in by], *order]
    # Rows with maps cannot be counted as copies; they are told apart by their order alone.
    copies = hashable(df) == columns and _has_hot_copies(df, list(dict.fromkeys([*by, *keys])), rows, rows_per_task)
    if copies:
        # No range parts rows that sort alike: equal rows become one with their number, others are told apart by a hash.
        # Grouping turns -0.0 into 0.0, so floating columns also go by their text, and the row itself is carried along.
        texts = [F.col(f.name).cast("string").alias(f"_text{i}") for i, f in enumerate(df.schema) if _floating(f.dataType.simpleString())]
        counted = df.groupBy(*columns, *texts).agg(F.count("*").alias(_COPIES), F.first(F.struct(*columns)).alias("_row"))
        df = counted.select("_row.*", _COPIES)
        sort.append(F.xxhash64(*columns))
    ranges = min(max_ranges, max(1, math.ceil(rows / rows_per_task)))
    ranged = (
        df.repartitionByRange(ranges, *sort)
        .sortWithinPartitions(*sort)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_AT, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    )
    ranged = stage(ranged, "ranges")
    weight = F.sum(_COPIES) if copies else F.count("*")
    parts = ranged.groupBy(*by, _PART).agg(weight.alias("_rows"), F.min(_AT).alias("_first"))
    earlier = Window.partitionBy(*by).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn(_START, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    # Written, so that the planner sees its real size: a line for each range and group.
    joined = ranged.join(stage(parts.drop("_rows"), "shifts"), [*by, _PART])
    if not copies:
        number = F.col(_START) + F.col(_AT) - F.col("_first") + 1
        return joined.select(*columns, number.alias(out))
    inside = Window.partitionBy(*by, _PART).orderBy(_AT)
    last = F.col(_START) + F.sum(_COPIES).over(inside)
    numbered = joined.select(*columns, (last - F.col(_COPIES) + 1).alias("_from"), last.alias("_to"))
    # Copies come back in blocks, which are spread over the tasks before they are written out.
    block = 100_000
    blocks = numbered.select("*", F.explode(F.sequence("_from", "_to", F.lit(block))).alias("_block"))
    return blocks.repartition("_block").select(
        *columns, F.explode(F.sequence("_block", F.least(F.col("_block") + block - 1, "_to"))).alias(out)
    )


def number_rows(
    df: DataFrame,
    order: list[Column],
    keys: list[str],
    out: str,
    by: list[str] | None = None,
    plan: str = "auto",
    rows_per_task: int = ROWS_PER_TASK,
    max_ranges: int = MAX_RANGES,
) -> DataFrame:
    """Number the rows 1, 2, … in the given order, per group or (without ``by``) over the whole table.

    ``keys`` names the columns that ``order`` uses. ``plan="window"`` gives each group to one task,
    ``plan="range"`` spreads every group over ranges of the sort order. ``"auto"`` counts the groups first and uses
    ranges if one of them has more than ``rows_per_task`` rows. All plans give the same numbers and take the same columns.
    ``max_ranges`` bounds the ranges, whose limits the driver holds; beyond ``max_ranges * rows_per_task`` rows, ranges grow.
    """
    by = by or []
    if plan == "window":
        return _by_window(df, by, order, out)
    if plan not in ("auto", "range"):
        raise ValueError(f"plan must be 'auto', 'window' or 'range', not {plan!r}")
    df = settled(df, "numbered")
    if not by:
        rows = df.count()
        if plan == "auto" and rows <= rows_per_task:
            return _by_window(df, by, order, out)
        return _by_ranges(df, by, order, keys, out, rows, rows_per_task, max_ranges)

    grouped = df.where(_all_present(by))
    if plan == "range":
        numbered = _by_ranges(grouped, by, order, keys, out, grouped.count(), rows_per_task, max_ranges)
        return numbered.unionByName(df.where(~_all_present(by)).withColumn(out, F.lit(None).cast("bigint")))

    # One group that is too large for a task puts the whole table into ranges: no list of such groups is kept anywhere.
    most, total = grouped.groupBy(*by).agg(F.count("*").alias("_rows")).agg(F.max("_rows"), F.sum("_rows")).first()
    if (most or 0) <= rows_per_task:
        return _by_window(df, by, order, out)
    numbered = _by_ranges(grouped, by, order, keys, out, total, rows_per_task, max_ranges)
    return numbered.unionByName(df.where(~_all_present(by)).withColumn(out, F.lit(None).cast("bigint")))


def sort_rows(df: DataFrame, order: list[Column], keys: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Sort the table. Where too many rows sort alike for one task, they are numbered first and sorted by number.

    Rows are counted, sampled and moved: a plan that does more than read is worked out once and written for that (``settled``).
    """
    df = settled(df, "sorted")
    rows = df.count()
    if rows <= 2 * rows_per_task or not _has_hot_copies(df, keys, rows, rows_per_task):
        return df.orderBy(*order)
    numbered = number_rows(df, order, keys, _AT, plan="range", rows_per_task=rows_per_task)
    return numbered.orderBy(_AT).drop(_AT)


def rank_in_group(
    df: DataFrame, by: str, value: str, ties: list[str], out: str = "Popularity", plan: str = "auto", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Rank by falling value in each group; ranks are unique, ties go by ``ties``; no rank without a group."""
    return number_rows(df, ordering(without_nan(df, value), ties), [value, *ties], out, [by], plan, rows_per_task)


def top_n_per_group(df: DataFrame, by: str, value: str, n: int, ties: list[str], out: str = "rank") -> DataFrame:
    """The ``n`` rows of each group with the largest values, ranked.

    A tree: each task, then each bucket of tasks, passes on at most ``n`` rows per group. Tasks can only do so up to Spark's
    ``spark.sql.optimizer.windowGroupLimitThreshold`` (1,000). For a longer list, bounds of the n-th values are narrowed down first
    (``selection``); only the rows that pass them are moved and ranked.
    """
    present = df.where(F.col(by).isNotNull())
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        return rank_in_group(largest_candidates(present, by, value, n), by, value, ties, out).where(F.col(out) <= n)
    order = ordering(without_nan(df, value), ties)
    bucket = Window.partitionBy(by, _PART).orderBy(*order)
    few = present.withColumn(_PART, F.spark_partition_id() % max(1, _buckets(df))).withColumn(_AT, F.row_number().over(bucket))
    few = few.where(F.col(_AT) <= n).drop(_AT, _PART)
    ranked = few.withColumn(out, F.row_number().over(Window.partitionBy(by).orderBy(*order)))
    return ranked.where(F.col(out) <= n).withColumn(out, F.col(out).cast("bigint"))


def limit_head(df: DataFrame, n: int | None, order: list[Column], keys: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The first ``n`` rows in the given order; all rows for None or below 0.

    A tree: every task keeps ``n`` rows, each bucket of tasks (about the square root of the shuffle partitions) ``n`` of those,
    and one task ``n`` of the buckets' rows. A list of more than ``rows_per_task`` rows, too long for that one task, is cut
    from the row numbers.
    """
    if n is None or n < 0:
        return sort_rows(df, order, keys)
    if n > rows_per_task:
        return number_rows(df, order, keys, _AT, rows_per_task=rows_per_task).where(F.col(_AT) <= n).drop(_AT)
    buckets = _buckets(df)
    if buckets > 1:
        few = first_in_task(df, n, order).withColumn(_PART, F.spark_partition_id())
        df = first_in_task(few.repartition(buckets, _PART), n, order).drop(_PART)
    return df.orderBy(*order).limit(n)


def top_k(df: DataFrame, value: str, n: int | None, ties: list[str]) -> DataFrame:
    """The ``n`` rows with the largest values."""
    return limit_head(df, n, ordering(without_nan(df, value), ties), [value, *ties])


def distinct_by_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key. Each task passes on one row per key."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_AT, F.row_number().over(window)).where(F.col(_AT) == 1).drop(_AT)
