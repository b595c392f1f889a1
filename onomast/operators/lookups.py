"""Lookups with defaults, fallback keys and parents that must be unique."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .groups import PAGE_ROWS, candidate_pages, only_value
from .joins import lookup_join

_WANTED = "_wanted"


def lookup_default(df: DataFrame, lookup: DataFrame, on: str, value: str, default: str, order_by: str | None = None) -> DataFrame:
    """Add the lookup's value, or the default where the key is unknown; no row is multiplied.

    Of several values for a key the last by ``order_by`` counts; without such a column, the largest.
    """
    one = F.max(value) if order_by is None else F.max_by(value, order_by)
    known = lookup.groupBy(on).agg(one.alias(value))
    return df.join(known, on, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def last_of_each(variant: str, value: str, variants: list[str], order_by: str) -> list[Column]:
    """Aggregates ``v0``, ``v1``, … with the last value that each variant has."""
    return [
        F.max_by(value, F.when((F.col(variant) == v) & F.col(value).isNotNull(), F.col(order_by))).alias(f"v{i}")
        for i, v in enumerate(variants)
    ]


def first_of(wanted: Column, variants: list[str], depth: int) -> Column:
    """Out of a widened lookup, the value of the first wanted variant that has one."""
    picks = []
    for place in range(depth):
        key = F.get(wanted, F.lit(place))
        pick = F.lit(None)
        for i, variant in enumerate(variants):
            pick = F.when(key == variant, F.col(f"v{i}")).otherwise(pick)
        picks.append(pick)
    return F.coalesce(*picks)


def lookup_fallback(
    df: DataFrame,
    lookup: DataFrame,
    on: list[str],
    variant: str,
    value: str,
    wanted: Column,
    variants: list[str],
    order_by: str,
    depth: int = 2,
) -> DataFrame:
    """Add the value found under the key and the first of the wanted variants; null if there is none. One join for all variants."""
    wide = lookup.groupBy(*on).agg(*last_of_each(variant, value, variants, order_by))
    # The wanted variants are a column of their own, so that they are not worked out again for each variant and place.
    found = lookup_join(df.withColumn(_WANTED, wanted), wide, on).withColumn(value, first_of(F.col(_WANTED), variants, depth))
    return found.drop(_WANTED, *[f"v{i}" for i in range(len(variants))])


def parents(pairs: DataFrame, child: str, parent: str, listed: int = PAGE_ROWS) -> DataFrame:
    """Per child its only parent (null if there are several) and the sorted list of all as text.

    Whether there is one needs no list. Of more than ``listed`` parents the text has the first ones and an ellipsis;
    ``candidate_pages`` has them all.
    """
    known = pairs.where(F.col(parent).isNotNull())
    first = candidate_pages(known, child, parent, "_list", listed).where("page = 0").withColumnRenamed(child, "_child")
    more = F.when(F.col("pages") > 1, F.lit(", …")).otherwise(F.lit(""))
    texts = first.select("_child", F.concat(F.array_join("_list", ", "), more).alias("candidates"))
    return only_value(known, child, parent).join(texts, F.col(child).eqNullSafe(F.col("_child"))).drop("_child")


def unique_parent(df: DataFrame, pairs: DataFrame, child: str, parent: str, listed: int = PAGE_ROWS) -> DataFrame:
    """Add the child's parent if it has exactly one, and the list of its parents as text (``parents``)."""
    return lookup_join(df, parents(pairs, child, parent, listed), child)
