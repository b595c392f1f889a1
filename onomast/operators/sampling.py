"""Reproducible samples that do not depend on how the table is partitioned."""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.readers import FILE_ORDER
from ..sources.scratch import settled, stage
from .ranking import ROWS_PER_TASK, hashable, limit_head, number_rows

#: Hexadecimal digits of the draw that a shuffled table is dealt by: 65,536 level buckets.
RADIX_DIGITS = 4
#: Samples of more rows are cut from the draws below a bound; of fewer, each task passes on that many rows.
DIRECT_ROWS = 10_000

_DRAW, _REST, _BUCKET, _BEFORE = "_draw", "_rest", "_bucket", "_before"


def draw_key(key: str | list[str], seed: int) -> Column:
    """Random-looking sort key of a row, fixed by seed and the row's key columns; a null has a draw like any other value."""
    keys = [key] if isinstance(key, str) else key
    typed = [F.coalesce(F.col(k).cast("string"), F.lit("\x00null")) for k in keys]
    return F.md5(F.concat_ws("\x1f", F.concat(F.lit(f"{seed}:"), typed[0]), *typed[1:]))


def _drawn(df: DataFrame, key: str | list[str], seed: int) -> tuple[DataFrame, list[Column], list[str]]:
    """The frame with its draws, and what to sort by: rows with one key are told apart by a draw over all their columns."""
    keys, whole = [key] if isinstance(key, str) else key, hashable(df)
    drawn = df.withColumns({_DRAW: draw_key(keys, seed), _REST: F.xxhash64(F.lit(seed), *whole)})
    return drawn, [F.asc(_DRAW), *[F.asc_nulls_last(k) for k in keys], F.asc(_REST)], [_DRAW, *keys, _REST]


def shuffle_rows(df: DataFrame, key: str | list[str], seed: int, out: str = "position", rows_per_task: int = ROWS_PER_TASK, **plan) -> DataFrame:
    """All rows with their place in a random order.

    Draws are uniform, so that their first digits deal the rows into level buckets without a sample: rows are numbered in their
    bucket, and the rows of earlier buckets, from a table of at most 65,536 lines, are added. If a bucket is too large for a task, as with
    a hot key, whose rows share a draw, rows are numbered by ranges (``number_rows``), as they are with any ``plan``.
    """
    drawn, order, keys = _drawn(settled(df, "shuffled"), key, seed)
    dealt = drawn.withColumn(_BUCKET, F.left(_DRAW, F.lit(RADIX_DIGITS)))
    if not plan:
        counts = stage(dealt.groupBy(_BUCKET).agg(F.count("*").alias("rows")), "buckets")
        if (counts.agg(F.max("rows")).first()[0] or 0) <= rows_per_task:
            # At most one line for each value of the digits.
            before = F.sum("rows").over(Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1))
            starts = F.broadcast(counts.select(_BUCKET, F.coalesce(before, F.lit(0)).alias(_BEFORE)))
            inside = F.row_number().over(Window.partitionBy(_BUCKET).orderBy(*order))
            placed = dealt.join(starts, _BUCKET).withColumn(out, (F.col(_BEFORE) + inside).cast("bigint"))
            return placed.select(*df.columns, out)
    return number_rows(drawn, order, keys, out, rows_per_task=rows_per_task, **plan).drop(_DRAW, _REST)


def first_draws(drawn: DataFrame, n: int) -> DataFrame:
    """The rows whose draws lie below a bound that at least ``n`` of them pass, and few more; written. No other row is moved.

    Draws are uniform, so that the count of all rows gives a bound which ``n`` rows pass but for one time in many millions; the count of
    those that did says so, and then the bound is doubled. Rows with one key have one draw and pass together.
    """
    total = drawn.count()
    share = (n + 6 * math.sqrt(n) + 10) / max(total, 1)
    while share < 1:
        few = stage(drawn.where(F.col(_DRAW) < format(int(share * 16**32), "032x")), "draws")
        if few.count() >= n:
            return few
        share *= 2
    return drawn


def sample_rows(df: DataFrame, mode: str, n: int | None, key: str | list[str], seed: int | None = None) -> DataFrame:
    """Choose rows by ``mode``; ``key`` names the columns that tell rows apart, as rows with one key are drawn together.

    ``all``: every row. ``sequential``: the first ``n`` in file order, if ``with_file_order`` has added it, or else by
    ``key``; all for None or ``n ≤ 0``. ``random``: exactly ``n`` rows without replacement, all in random order for None;
    without a seed, one is drawn.
    """
    keys = [key] if isinstance(key, str) else key
    if mode == "all" or (mode == "sequential" and (n is None or n <= 0)):
        return df
    if mode == "sequential":
        first = [FILE_ORDER] if FILE_ORDER in df.columns else keys
        return limit_head(df, n, [F.asc_nulls_last(k) for k in first], first)
    if mode != "random":
        raise ValueError(f"mode must be 'all', 'sequential' or 'random', not {mode!r}")
    if n is not None and n <= 0:
        raise ValueError(f"a random sample needs a positive size, not {n}")
    large = n is not None and n > DIRECT_ROWS
    drawn, order, names = _drawn(settled(df, "drawn") if large else df, keys, random.randrange(1 << 31) if seed is None else seed)
    drawn = first_draws(drawn, n) if large else drawn
    return limit_head(drawn, n, order, names).drop(_DRAW, _REST)
