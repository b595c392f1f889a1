"""Aggregates per group and whole-table profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import share_percent
from ..sources.scratch import stage
from .joins import lookup_join
from .ranking import number_rows

#: Values of a page of a key's list.
PAGE_ROWS = 10_000

_KEY, _VALUE, _AT = "_key", "_value", "_at"


def group_total(df: DataFrame, by: str, value: str, out: str | None = None) -> DataFrame:
    """Sum per group; rows without a group are left out."""
    return df.where(F.col(by).isNotNull()).groupBy(by).agg(F.sum(value).alias(out or value))


def join_group_total(df: DataFrame, by: str, value: str, suffix: str = "_Total") -> DataFrame:
    """Each row with the total of its group; rows without a group vanish.

    Only the totals are shuffled. A window over the group would move every row, and all rows of a group into one task.
    """
    return lookup_join(df, group_total(df, by, value, f"{value}{suffix}"), by, "inner")


def share_of_group(df: DataFrame, by: str, value: str, out: str = "Percentage") -> DataFrame:
    """Value as a percentage of its group's total."""
    total = f"{value}_Total"
    return join_group_total(df, by, value).withColumn(out, share_percent(F.col(value), F.col(total))).drop(total)


def value_counts(df: DataFrame, column: str, out: str = "count") -> DataFrame:
    """Rows per value, most frequent first; null is not counted."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias(out))
    return counts.orderBy(F.desc(out), column)


def profile(df: DataFrame, ranges: list[str], flags: dict[str, Column | str] | None = None, keep: Column | None = None) -> DataFrame:
    """One row with the number of rows, smallest and largest values and numbers of true flags.

    With ``keep``, the same figures for the kept rows are added as ``kept_…``, from the same pass.
    """

    def figures(prefix: str, condition: Column | None) -> list[Column]:
        inside = (lambda c: c) if condition is None else (lambda c: F.when(condition, c))
        counted = F.count("*") if condition is None else F.count_if(condition)
        row = [counted.alias(f"{prefix}rows")]
        for name in ranges:
            row += [F.min(inside(F.col(name))).alias(f"{prefix}min_{name}"), F.max(inside(F.col(name))).alias(f"{prefix}max_{name}")]
        for name, flag in (flags or {}).items():
            row.append(F.count_if(inside(F.col(flag) if isinstance(flag, str) else flag)).alias(f"{prefix}{name}"))
        return row

    return df.agg(*figures("", None), *([] if keep is None else figures("kept_", keep)))


def keep_last(df: DataFrame, keys: list[str], order_by: Column | str, value: str, out: str | None = None) -> DataFrame:
    """Per key the value of the last row."""
    return df.groupBy(*keys).agg(F.max_by(value, order_by).alias(out or value))


def keep_first(df: DataFrame, keys: list[str], order_by: Column | str, value: str, out: str | None = None) -> DataFrame:
    """Per key the value of the first row."""
    return df.groupBy(*keys).agg(F.min_by(value, order_by).alias(out or value))


def only_value(df: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    """Per key its value if it has exactly one, else null. The state of a key is two values, however many it has."""
    least, most = F.min(value), F.max(value)
    return df.groupBy(key).agg(F.when(least == most, least).alias(out or value))


def candidate_pages(df: DataFrame, key: str, value: str, out: str = "candidates", page_rows: int = PAGE_ROWS) -> DataFrame:
    """Per key the sorted set of its values in pages: key, page (from 0), pages, and at most ``page_rows`` values.

    Different pairs are counted first. If no key has more values than a page, one aggregate makes the lists. Otherwise the pairs
    are numbered in ranges, so that neither a task nor a row holds all values of a hot key. A key without values has one empty page.
    """
    pairs = stage(df.select(F.struct(key).alias(_KEY), F.col(value).alias(_VALUE)).distinct(), "pairs")
    counts = pairs.groupBy(_KEY).agg(F.count(_VALUE).alias("_values"))
    most = counts.agg(F.max("_values")).first()[0] or 0
    page_of = F.lit(0).cast("bigint")
    if most > page_rows:
        numbered = number_rows(pairs, [F.asc_nulls_last(_VALUE)], [_VALUE], _AT, [_KEY])
        pairs, page_of = numbered, F.floor((F.col(_AT) - 1) / page_rows)
    lists = pairs.groupBy(_KEY, page_of.alias("page")).agg(F.array_sort(F.collect_list(_VALUE)).alias(out))
    if most > page_rows:
        pages = F.greatest(F.lit(1), F.ceil(F.col("_values") / page_rows)).alias("pages")
        # A null behind the last full page makes no page.
        lists = lists.where((F.size(out) > 0) | (F.col("page") == 0)).join(stage(counts.select(_KEY, pages), "pages"), _KEY)
    else:
        lists = lists.withColumn("pages", F.lit(1).cast("bigint"))
    return lists.select(f"{_KEY}.{key}", "page", "pages", out)


def candidates(df: DataFrame, key: str, value: str, out: str = "candidates", most: int = 1_000_000) -> DataFrame:
    """Per key the sorted set of its values, in one row; a set of more than ``most`` values is an error: it comes in ``candidate_pages``."""
    pages = candidate_pages(df, key, value, out, most)
    large = F.raise_error(F.lit(f"a key has more than {most} values; take candidate_pages"))
    return pages.select(key, F.when(F.col("pages") > 1, large).otherwise(F.col(out)).alias(out))
