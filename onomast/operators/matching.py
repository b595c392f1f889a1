"""Requests for names, matched without regard to case."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import stage
from .membership import key_filter, possible_rows
from .ranking import distinct_by_key, limit_head

Request = str | tuple[str, str | None]
ORDER = "request"
#: Requests of a table that are joined without a filter of their names.
LISTED_REQUESTS = 100_000


def as_requests(spark: SparkSession, names: Sequence[Request]) -> DataFrame:
    """Table of the requests in their order, names in upper case, groups in lower case."""
    pairs = [(name, None) if isinstance(name, str) else name for name in names]
    rows = [(i, str(n).upper(), None if g is None else str(g).lower()) for i, (n, g) in enumerate(pairs)]
    return spark.createDataFrame(rows, f"{ORDER} int, wanted_name string, wanted_group string")


def _matches(requests: DataFrame, name: str, group: str) -> Column:
    group_fits = F.col("wanted_group").isNull() | (F.lower(F.col(group)) == F.col("wanted_group"))
    return (F.upper(F.col(name)) == F.col("wanted_name")) & group_fits


def _matched(df: DataFrame, names: Sequence[Request] | DataFrame, name: str, group: str, listed: int = LISTED_REQUESTS) -> DataFrame:
    if isinstance(names, DataFrame):
        # The planner sees the written size of a table of requests. From many requests on, which it would not broadcast, rows that
        # cannot match are left out before the join moves any.
        side = stage(names, "requests")
        number = side.count()
        if number > listed:
            df = possible_rows(df, F.upper(F.col(name)), *key_filter(side, F.col("wanted_name"), number))
    else:
        # Requests from the driver are bounded by it.
        side = F.broadcast(as_requests(df.sparkSession, names))
    return df.join(side, _matches(side, name, group)).drop("wanted_name", "wanted_group").withColumn(name, F.upper(name))


def match_requests(
    df: DataFrame,
    names: Sequence[Request] | DataFrame | None,
    name: str,
    group: str,
    order_by: list[str],
    limit: int | None = None,
    listed: int = LISTED_REQUESTS,
) -> DataFrame:
    """The rows of the requested names, in request order, one row per name and group; then the limit.

    A request is a name, or a name and a group. Without requests, the first ``limit`` rows in ``order_by``. The column
    ``request`` holds the place of the request. A table of more than ``listed`` requests is met by a filter of its names first, so that
    the join moves only rows that match, and about one in seventy of the others.
    """
    if names is None:
        upper = df.withColumn(name, F.upper(name)).withColumn(ORDER, F.lit(None).cast("int"))
        return upper if limit is None else limit_head(upper, limit, [F.asc(c) for c in order_by], order_by)
    order = [F.asc(ORDER), *[F.asc(c) for c in order_by]]
    once = distinct_by_key(_matched(df, names, name, group, listed), [name, group], order)
    return once if limit is None else limit_head(once, limit, order, [ORDER, *order_by])


def missing_requests(df: DataFrame, names: Sequence[Request] | DataFrame, name: str, group: str) -> DataFrame:
    """The requests that no row answers. The large table is only scanned, and hands on one row per request and task."""
    requests = names if isinstance(names, DataFrame) else as_requests(df.sparkSession, names)
    found = _matched(df, requests, name, group).select(ORDER).distinct()
    return requests.join(found, ORDER, "left_anti")


def select_names(
    df: DataFrame,
    name: str,
    group: str,
    value: str,
    ties: list[str],
    names: Sequence[str] | None = None,
    only_group: str | None = None,
    top: int | None = None,
) -> DataFrame:
    """Name and group of the requested names (every match), or of the ``top`` rows by group and falling value."""
    if names:
        pairs = _matched(df, [(n, only_group) for n in names], name, group)
        return pairs.select(name, group, ORDER)
    rows = df.withColumn(name, F.upper(name))
    if only_group:
        rows = rows.where(F.lower(F.col(group)) == only_group.lower())
    order = [F.asc_nulls_last(group), F.desc_nulls_last(value), *[F.asc(t) for t in ties]]
    columns = list(dict.fromkeys([name, group, value, *ties]))
    chosen = rows.select(*columns) if not top else limit_head(rows.select(*columns), top, order, [group, value, *ties])
    return chosen.select(name, group)
