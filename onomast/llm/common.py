"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from types import ModuleType

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import stage

#: Fixed pattern: a word is a run without blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
_PART = "_part"


def ship(module: str) -> None:
    """Send a module's functions to the executors by value, so that these need no copy of the package."""
    found: ModuleType = sys.modules[module]
    cloudpickle.register_pickle_by_value(found)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Fewer rows at a time for what is run inside, where a row is much larger in Python than it is in Spark."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with more underscores in front where the frame has such a column."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        found.append(name)
    return found


def word_count(text: Column | str) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def held_out(doc_id: Column | str) -> Column:
    """Whether a row is kept from learning: crc32 of the id's text is a multiple of 5. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 5 == 0, F.lit(False))


def running_total(df: DataFrame, by: list[str], order: list[Column], weight: Column | str, out: str, label: str) -> DataFrame:
    """Each row with the weights of the earlier rows of its group, as a two-pass prefix sum.

    The rows are sorted into ranges of (group, order), which are written once. Each range sums its own rows, and the
    totals of a group's earlier ranges are added from a table with a line per range and group: a group of any size is
    spread over as many tasks as it needs. ``by`` columns must not be null; rows that sort alike should have been
    counted into one (``weight``).
    """
    columns = df.columns
    sort = [*by, *order]
    ranged = stage(df.repartitionByRange(*sort).withColumn(_PART, F.spark_partition_id()), label)
    weight = F.col(weight) if isinstance(weight, str) else weight
    parts = ranged.groupBy(*by, _PART).agg(F.sum(weight).alias("_sum"))
    earlier = Window.partitionBy(*by).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(*by, _PART, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*by, _PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_start") + F.coalesce(F.sum(weight).over(inside), F.lit(0))
    return ranged.join(starts, [*by, _PART]).withColumn(out, before).select(*columns, out)


def repeat_rows(df: DataFrame, times: str, index: str, block: int = 100_000) -> DataFrame:
    """Each row ``times`` times, numbered from 0 in ``index``; many repeats are written out in blocks."""
    last = F.col(times) - 1
    blocks = df.where(F.col(times) > 0).withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(block).cast("bigint"))))
    return blocks.withColumn(index, F.explode(F.sequence("_block", F.least(F.col("_block") + (block - 1), last)))).drop("_block")
