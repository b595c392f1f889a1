"""Approximate nearest neighbours by inner product, with an adaptive scan over dimensions.

Vectors get one more dimension so that the largest inner product is the least distance. They are rotated at random and
dealt to the lists of an inverted file. In a probed list, distances are summed up column block by column block; after
each block a hypothesis test asks whether, going by the part seen so far, a candidate can still be among the nearest, and
those that cannot are abandoned. What is left is scored exactly, in double precision, on the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import stage
from .common import ship

ship(__name__)

#: Bound of the sample from which the lists and the number of probed lists are fitted.
SAMPLE_ROWS, SAMPLE_QUERIES = 8_192, 128
MOST_LISTS, COLUMN_BLOCK, TEST_WIDTH = 1_024, 16, 2.1
LIST_BLOCK, QUERY_BLOCK = 4_096, 512
SAMPLE_RECALL = 0.97
HIT_TYPES = {"query": "int64", "score": "float64", "ids": "object"}


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite numbers, not all of them zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def rotation(dims: int) -> np.ndarray:
    turned, corner = np.linalg.qr(np.random.default_rng(3).normal(size=(dims, dims)))
    return turned * np.sign(np.diag(corner))


def lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the dimension that gives all of them the length of the longest."""
    rest = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(axis=1), 0))
    return np.column_stack([vectors, rest])


def cluster(points: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    """Centres by Lloyd's rounds from evenly taken points; a centre that loses its points keeps its place."""
    centres = points[np.linspace(0, len(points) - 1, lists).round().astype(int)].copy()
    for _ in range(rounds):
        at = (centres**2).sum(axis=1) - 2 * points @ centres.T
        nearest = at.argmin(axis=1)
        sums, sizes = np.zeros_like(centres), np.bincount(nearest, minlength=lists)
        np.add.at(sums, nearest, points)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def probes_needed(points: np.ndarray, centres: np.ndarray, k: int, queries: np.ndarray, target: float) -> int:
    """Lists to probe so that, in the sample, the share of true nearest points in probed lists reaches the target."""
    at = (centres**2).sum(axis=1) - 2 * points @ centres.T
    home = at.argmin(axis=1)
    exact = np.argsort(-(queries[:, :-1] @ points[:, :-1].T), axis=1, kind="stable")[:, :k]
    order = np.argsort((centres**2).sum(axis=1) - 2 * queries @ centres.T, axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(order.shape[1])[None, :].repeat(len(order), 0), axis=1)
    needed = np.take_along_axis(rank, home[exact], axis=1)
    return int(np.quantile(needed, target, method="higher")) + 1


def scan(vectors: np.ndarray, queries: np.ndarray, bounds: np.ndarray, turn: np.ndarray, longest: float, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, candidate) pairs that no test has abandoned; vectors and queries are the original ones.

    ``bounds`` holds the score of each query's k-th candidate so far, -inf if there are fewer; then the k candidates
    that are nearest in the first column block are measured in full, and the worst of them is the bound.
    """
    dims = turn.shape[0]
    points = lifted(vectors, longest) @ turn
    asked = np.column_stack([queries, np.zeros(len(queries))]) @ turn
    cuts = [*range(0, dims, COLUMN_BLOCK), dims]
    first = slice(0, cuts[1])
    partial = (points[:, first] ** 2).sum(axis=1) - 2 * asked[:, first] @ points[:, first].T + (asked[:, first] ** 2).sum(axis=1)[:, None]
    limit = longest**2 + (queries**2).sum(axis=1) - 2 * bounds
    for q in np.flatnonzero(np.isinf(limit)) if len(points) > k else ():
        start = np.argpartition(partial[q], k - 1)[:k]
        limit[q] = ((points[start] - asked[q]) ** 2).sum(axis=1).max()
    limit = limit * (1 + 1e-9) + 1e-9
    test = lambda low: limit * (1.0 if low == dims else low / dims * (1 + TEST_WIDTH / math.sqrt(low)) ** 2)
    q, c = np.nonzero(partial <= test(cuts[1])[:, None])
    left = partial[q, c]
    for low, high in zip(cuts[1:], cuts[2:]):
        left = left + ((points[c, low:high] - asked[q, low:high]) ** 2).sum(axis=1)
        kept = left <= test(high)[q]
        q, c, left = q[kept], c[kept], left[kept]
    return q, c


def _assign(batches: Iterator[pd.DataFrame], centres: np.ndarray, turn: np.ndarray, longest: float, probes: int) -> Iterator[pd.DataFrame]:
    """The nearest list of each vector, or as many lists as a query probes."""
    for batch in batches:
        for low in range(0, len(batch), 2_000):
            some = batch.iloc[low : low + 2_000]
            vectors = np.stack(some["vector"].to_list()).astype(np.float64)
            points = (np.column_stack([vectors, np.zeros(len(vectors))]) if probes else lifted(vectors, longest)) @ turn
            at = (centres**2).sum(axis=1) - 2 * points @ centres.T
            lists = np.argsort(at, axis=1, kind="stable")[:, : max(probes, 1)]
            yield some.assign(list=lists.tolist() if probes else lists[:, 0])


def nearest(table: DataFrame, asked: Column, k: int = 20, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row for which ``asked`` holds, the ``k`` other rows of largest inner product.

    Ties go to the smaller id; with fewer candidates, all are returned. Rows without an id, and vectors that are null, zero
    or hold null or non-finite components take no part. Vectors of different lengths have no inner product: each length is searched
    by itself, one after the other, so that a table should have few of them. An id on several rows stands once, with the smallest of its vectors. Equal vectors are one candidate with its smallest ids,
    which is all that a list of ``k`` can need; blocks of a long list are scanned by tasks of their own.
    """
    empty = table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    flagged = table.select(F.col(id).alias("id"), F.col(vector).alias("vector"), F.coalesce(asked, F.lit(False)).alias("asked"))
    rows = flagged.where(F.col("id").isNotNull() & usable(F.col("vector")))
    rows = stage(rows.groupBy("id").agg(F.min("vector").alias("vector"), F.max("asked").alias("asked")), "vectors")
    lengths = [r["dims"] for r in rows.groupBy(F.size("vector").alias("dims")).agg(F.max("asked").alias("asked")).where("asked").orderBy("dims").collect()]
    return reduce(DataFrame.unionByName, [_nearest_of(rows.where(F.size("vector") == dims), dims, k) for dims in lengths], empty)


def _nearest_of(rows: DataFrame, dims: int, k: int) -> DataFrame:
    """The search among rows (id, vector, asked) of vectors of one length, some of them asked."""
    double = F.col("vector").cast("array<double>")
    square = F.aggregate(double, F.lit(0.0), lambda s, x: s + x * x)

    # Of equal vectors, the k + 1 smallest ids can be wanted; each task passes on that many.
    place = Window.partitionBy("vector").orderBy("id")
    few = rows.withColumn("_n", F.row_number().over(place)).where(F.col("_n") <= k + 1)
    points = stage(few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("point", F.xxhash64("vector")), "points")
    asking = rows.where("asked")
    queries = stage(asking.groupBy("vector").agg(F.count("*").alias("_n")).select("vector", F.xxhash64("vector").alias("query")), "queries")
    total, longest = points.agg(F.count("*"), F.sqrt(F.max(square))).first()
    longest = float(longest) * (1 + 1e-12)

    sample = points.orderBy("point").limit(SAMPLE_ROWS).select("vector").toPandas()["vector"]
    turn = rotation(dims + 1)
    fitted = lifted(np.stack(sample.to_list()).astype(np.float64), longest)
    lists = max(1, min(MOST_LISTS, round(math.sqrt(total) / 2), len(fitted) // 8))
    centres = cluster(fitted @ turn, lists)
    few_queries = np.column_stack([fitted[:SAMPLE_QUERIES, :-1], np.zeros(min(SAMPLE_QUERIES, len(fitted)))])
    # The sample is sparser than the table, so that its nearest points lie further off: the probes err on the safe side.
    probes = min(lists, probes_needed(fitted @ turn @ turn.T, centres @ turn.T, min(k, len(fitted)), few_queries, SAMPLE_RECALL))

    kind = points.schema["vector"].dataType.simpleString()
    dealt = points.mapInPandas(lambda b: _assign(b, centres, turn, longest, 0), f"vector {kind}, ids array<long>, point long, list long")
    dealt = stage(dealt, "lists")
    sizes = dealt.groupBy("list").agg(F.ceil(F.count("*") / LIST_BLOCK).alias("blocks"))
    candidates = dealt.join(F.broadcast(sizes), "list").withColumn("block", F.pmod("point", "blocks"))
    probing = queries.mapInPandas(lambda b: _assign(b, centres, turn, longest, probes), f"vector {kind}, query long, list array<long>")
    probing = stage(probing.select("vector", "query", F.posexplode("list").alias("turn", "list")), "probes")
    asks = probing.groupBy("list").agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("parts"))
    limits = stage(sizes.join(asks, "list"), "limits")
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))
    candidates = candidates.join(F.broadcast(limits.select("list", "parts")), "list").withColumn("part", each)
    probing = probing.join(F.broadcast(limits), "list").withColumn("part", F.pmod("query", "parts"))
    probing = probing.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = {"query": [], "score": [], "ids": []}
        if len(left) and len(right):
            vectors = np.stack(left["vector"].to_list()).astype(np.float64)
            ids = left["ids"].to_numpy()
            least = np.array([i[0] for i in ids])
            for low in range(0, len(right), 64):
                some = right.iloc[low : low + 64]
                wanted, bounds = np.stack(some["vector"].to_list()).astype(np.float64), some["bound"].to_numpy()
                q, c = scan(vectors, wanted, bounds, turn, longest, k + 1)
                scores = (vectors[c] * wanted[q]).sum(axis=1)
                order = np.lexsort((least[c], -scores, q))
                order = order[scores[order] >= bounds[q[order]]]
                q, c, scores = q[order], c[order], scores[order]
                # The first k + 1 of each query.
                place = np.arange(len(q)) - np.searchsorted(q, q)
                kept = place <= k
                found["query"] += some["query"].to_numpy()[q[kept]].tolist()
                found["score"] += scores[kept].tolist()
                found["ids"] += [ids[i] for i in c[kept]]
        # Typed, as a list without any candidate left gives three empty columns.
        return pd.DataFrame({name: pd.Series(found[name], dtype=kind) for name, kind in HIT_TYPES.items()})

    on = ["list", "block", "part"]
    dealt_out = candidates.select(*on, "vector", "ids")

    def hits_of(asks: DataFrame) -> DataFrame:
        some = dealt_out.join(asks.select(*on).distinct(), on, "left_semi").groupBy(*on)
        return some.cogroup(asks.select(*on, "vector", "query", "bound").groupBy(*on)).applyInPandas(search, "query long, score double, ids array<long>")

    # The nearest list first: its k-th score bounds what the other lists still have to offer.
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.get("ids", F.lit(0)))
    home = hits_of(probing.where("turn = 0").withColumn("bound", F.lit(float("-inf"))))
    home = stage(home.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1), "home")
    bounds = home.where(F.col("_n") == k + 1).select("query", F.col("score").alias("bound"))
    others = probing.where("turn > 0").join(bounds, "query", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    hits = home.drop("_n").unionByName(hits_of(others))
    hits = stage(hits.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1).groupBy("query").agg(F.collect_list(F.struct("score", "ids")).alias("hits")), "hits")

    # k + 1 vectors with k + 1 ids at most: a row for each query vector, spread over the rows that ask it.
    flat = F.flatten(F.transform("hits", lambda h: F.transform(h["ids"], lambda i: F.struct((-h["score"]).alias("s"), i.alias("i")))))
    known = hits.select("query", F.sort_array(flat).alias("hits"))
    rowed = asking.select("id", F.xxhash64("vector").alias("query")).join(known, "query")
    others = F.slice(F.filter("hits", lambda h: h["i"] != F.col("id")), 1, k)
    out = rowed.select(F.col("id").alias("query_id"), F.posexplode(others).alias("_p", "_h"))
    return out.select("query_id", (F.col("_p") + 1).cast("int").alias("rank"), F.col("_h.i").alias("vec_id"), (-F.col("_h.s")).alias("score"))
