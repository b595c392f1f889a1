"""Joins against a side that may or may not be small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from ..sources.scratch import stage


def lookup_join(df: DataFrame, lookup: DataFrame, on: str | list[str] | Column, how: str = "left") -> DataFrame:
    """Join a lookup, whatever its size, to a large table.

    The lookup is worked out once, when the frame is built, and written; every size is fixed at the same moment. The planner
    sees the size of the files: below its broadcast threshold the large table stays where it is, above it both sides are
    shuffled, where adaptive execution splits the partition of a hot key.
    """
    return df.join(stage(lookup, "lookup"), on, how)
