"""Mixing sources to target weights by entropy balancing.

Each source has a target in words. The rates of its documents are the ones of least relative entropy to "each once" that
meet the target, none above the limit: ``rate = min(limit, exp(theta * size / mean size))``, with one multiplier
``theta`` per source, the solution of the convex dual. All sources are solved at once by Newton steps, each of them one
aggregate over (source, size) cells. Rates are then rounded into whole copies, from the largest documents to the
smallest, with the error carried on, so that a source misses its target by about half of its smallest documents.
"""

from __future__ import annotations

import warnings

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import Rounds, stage
from .common import repeat_rows, running_total, ship, unused, word_count

ship(__name__)

STEPS, TOLERANCE = 60, 1e-7
#: Columns that the sizes of a mix add.
ADDED = ("source", "size", "source_size", "target", "copies", "taken")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Targets of sources: (source, source_size) in, the same with ``source_no``, ``target`` out.

    Sources by code point, null last, have the weights in turn and share ``share`` times all words. A target stops at
    ``most`` times its source's words, and what is over goes to the others by weight until none is above. Each round is
    one aggregate; the set of stopped sources only grows.
    """
    numbered = running_total(
        sizes.withColumn("_one", F.lit(1)), ["_one"], [F.asc_nulls_last("source")], F.lit(1), "source_no", "sources"
    ).drop("_one")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    known = stage(numbered.withColumn("_weight", weight).withColumn("_cap", most * F.col("source_size")), "sources")
    total = known.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while total:
        stopped = F.col("_cap") <= level * F.col("_weight")
        row = known.agg(F.sum(F.when(stopped, F.col("_cap"))).alias("c"), F.sum(F.when(~stopped, F.col("_weight"))).alias("w")).first()
        if not row["w"]:
            level = float("inf")
            break
        rest = (share * total - (row["c"] or 0.0)) / row["w"]
        if rest <= level:
            break
        level = rest
    target = F.when(F.col("_cap") <= level * F.col("_weight"), F.col("_cap")).otherwise(level * F.col("_weight")) if level < float("inf") else F.col("_cap")
    return known.select("source", "source_no", "source_size", target.alias("target"))


def _solve(cells: DataFrame, sources: DataFrame, most: float) -> DataFrame:
    """Newton steps on the dual; (source_no, mean, theta) of each source. theta is null where every rate is at the limit.

    A source that has not met its target after ``STEPS`` steps is warned of; rounding carries what it misses on.
    """
    shape = cells.groupBy("source_no").agg(F.sum(F.col("n") * F.col("size")).alias("words"), F.sum("n").alias("docs"), F.min("size").alias("least"))
    state = shape.join(sources.select("source_no", "target"), "source_no").select(
        "source_no",
        "target",
        (F.col("words") / F.col("docs")).alias("mean"),
        F.when(F.col("target") < most * F.col("words"), F.lit(0.0)).alias("theta"),
        F.lit(float("-inf")).alias("low"),
        (F.log(F.lit(most)) * F.col("words") / F.col("docs") / F.col("least")).alias("high"),
        F.lit(float("inf")).alias("off"),
    )
    states = Rounds(cells.sparkSession, "dual")
    state = states.write(state)
    for _ in range(STEPS):
        z = F.col("size") / F.col("mean")
        free = F.col("theta") * z < F.log(F.lit(most))
        rate = F.when(free, F.exp(F.col("theta") * z)).otherwise(F.lit(most))
        words = F.col("n") * F.col("size")
        sums = (
            cells.join(state.where("theta is not null and off > 0").select("source_no", "mean", "theta"), "source_no")
            .groupBy("source_no")
            .agg(F.sum(words * rate).alias("g"), F.sum(F.when(free, words * z * rate).otherwise(0.0)).alias("slope"))
        )
        stepped = state.join(sums, "source_no", "left")
        gap = F.log(F.col("g")) - F.log(F.col("target"))
        low = F.when(gap < 0, F.col("theta")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("theta")).otherwise(F.col("high"))
        newton = F.col("theta") - gap * F.col("g") / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > low) & (newton < high)
        step = F.when(inside, newton).when(low > float("-inf"), (low + high) / 2).otherwise(2 * high - 1)
        done = F.abs(gap) <= TOLERANCE
        stepped = stepped.select(
            "source_no",
            "target",
            "mean",
            F.when(F.col("g").isNull() | done, F.col("theta")).otherwise(step).alias("theta"),
            F.when(F.col("g").isNull(), F.col("low")).otherwise(low).alias("low"),
            F.when(F.col("g").isNull(), F.col("high")).otherwise(high).alias("high"),
            F.when(F.col("g").isNull() & F.col("theta").isNotNull() | done, 0.0).otherwise(F.abs(gap)).alias("off"),
        )
        state = states.write(stepped)
        if state.where("theta is not null and off > 0").isEmpty():
            break
    else:
        worst = state.where("off > 0").agg(F.count("*").alias("n"), F.max("off").alias("off")).first()
        warnings.warn(f"{worst['n']} sources have not met their targets after {STEPS} steps, by a factor of up to e^{worst['off']:.2g}", stacklevel=3)
    return state.select("source_no", "mean", "theta")


def _round_copies(cells: pd.DataFrame) -> pd.DataFrame:
    """Copies of the cells of one source, largest documents first; the words missed so far go to the next cell."""
    cells = cells.sort_values("size", ascending=False)
    rates = cells["rate"].to_numpy()
    error, copies = float(cells["target"].iloc[0]) - float((cells["n"] * cells["size"] * rates).sum()), []
    for n, size, rate, most in zip(cells["n"].tolist(), cells["size"].tolist(), rates.tolist(), cells["most"].tolist()):
        wanted = n * rate + error / size
        whole = int(min(max(round(wanted), 0), most * n))
        error = (wanted - whole) * size
        copies.append(whole)
    return pd.DataFrame({"source_no": cells["source_no"], "size": cells["size"], "_n": cells["n"], "_copies": copies})


def allocate(
    docs: DataFrame,
    keys: list[str],
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
) -> DataFrame:
    """The mix, one row per different (keys, source, size): its rows ``_m`` and the copies that these get together.

    ``before`` and ``_base``, ``_extra`` tell the copies of single rows: the row with number i from 0 among the ``_m``
    gets ``_base`` copies, and one more if ``before + i < _extra``. A document without words has rate 1 and is kept once.
    """
    rows = docs.select(*keys, F.col(source).alias("source"), word_count(text).alias("size"))
    rows = stage(rows.groupBy(*keys, "source", "size").agg(F.count("*").alias("_m")), "sizes")
    sizes = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("_m")).alias("source_size"))
    sources = stage(source_targets(sizes, weights, share, most), "targets")
    same = rows["source"].eqNullSafe(sources["source"])
    numbered = rows.join(sources.withColumnRenamed("source", "_s"), rows["source"].eqNullSafe(F.col("_s"))).drop("_s", same)
    numbered = stage(numbered, "numbered")
    cells = stage(numbered.where("size > 0").groupBy("source_no", "size").agg(F.sum("_m").alias("n")), "cells")
    solved = _solve(cells, sources, float(most))
    exponent = F.col("theta") * F.col("size") / F.col("mean")
    rate = F.when(F.col("theta").isNull(), F.lit(float(most))).otherwise(F.least(F.lit(float(most)), F.exp(exponent)))
    rated = cells.join(solved, "source_no").join(sources.select("source_no", "target"), "source_no")
    rated = rated.select("source_no", "size", "n", "target", rate.alias("rate"), F.lit(most).alias("most"))
    # A group is the different document sizes of a source, whatever the number of its documents.
    copies = stage(rated.groupBy("source_no").applyInPandas(_round_copies, "source_no long, size long, _n long, _copies long"), "copies")
    draw = F.xxhash64(*keys)
    placed = running_total(numbered.withColumn("_draw", draw), ["source_no", "size"], [F.col("_draw"), *[F.col(k) for k in keys]], "_m", "before", "places")
    joined = placed.join(copies, ["source_no", "size"], "left")
    base = F.when(F.col("_n").isNull(), F.lit(1)).otherwise(F.floor(F.col("_copies") / F.col("_n")))
    extra = F.when(F.col("_n").isNull(), F.lit(0)).otherwise(F.col("_copies") % F.col("_n"))
    return joined.select(
        *keys, "source", "size", "_m", "source_size", "target", "before", base.cast("bigint").alias("_base"), extra.cast("bigint").alias("_extra")
    )


def mix_sizes(docs: DataFrame, keys: list[str], **options) -> DataFrame:
    """Each row of ``docs`` (by its keys) with source, size, source_size, target, copies and taken = copies times size.

    A key called like one of these is a ``ValueError``, as the result could not tell them apart; any other name will do.
    """
    if clash := {k.lower() for k in keys}.intersection(ADDED):
        raise ValueError(f"no key can be called {', '.join(sorted(clash))}, as the mix adds such a column")
    own = unused(docs, *[f"_key{i}" for i in range(len(keys))])
    rows = repeat_rows(allocate(docs.withColumns({a: F.col(k) for a, k in zip(own, keys)}), own, **options), "_m", "_i")
    copies = F.col("_base") + F.when(F.col("before") + F.col("_i") < F.col("_extra"), 1).otherwise(0)
    rows = rows.withColumn("copies", copies)
    named = [F.col(a).alias(k) for a, k in zip(own, keys)]
    return rows.select(*named, "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mixed table: the rows of ``docs`` with all their columns, each as often as it was drawn.

    Rows that are equal in every column are counted into one before texts move; texts are shuffled once. An empty table
    gives an empty one; a null source is a source of its own; null texts have no words and are kept once.
    """
    columns = docs.columns
    keys = unused(docs, "_k1", "_k2")
    keyed = docs.withColumns({keys[0]: F.xxhash64(*columns), keys[1]: F.xxhash64(F.lit(1), *columns)})
    drawn = allocate(keyed, keys, text, source, **options)
    extra = F.least(F.greatest(F.col("_extra") - F.col("before"), F.lit(0)), F.col("_m"))
    drawn = drawn.select(*keys, (F.col("_base") * F.col("_m") + extra).alias("_copies")).where("_copies > 0")
    whole = keyed.groupBy(*keys).agg(F.first(F.struct(*columns)).alias("_row"))
    return repeat_rows(whole.join(drawn, keys), "_copies", "_i").select("_row.*")
