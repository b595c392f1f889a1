"""Clustering around centroids by exact rounds over whole numbers, with heap-ordered bounds.

Vectors lie in blocks, a row each. In a block, every cluster keeps a heap of its vectors by the gap between the upper bound of
their distance to the own centroid and the lower bound of that to any other. When centroids move, the gaps of a cluster shrink
by at most what its own centroid and the farthest-moved other one have drifted; that is added to an offset of the whole
cluster, not to each vector. Only vectors at the top of a heap whose gap the offset has used up are popped and measured
against all centroids. Blocks pass on the sums of the vectors that changed cluster; nothing is shuffled but these.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import delete_path, scratch_path, stage
from .common import arrow_batches, ship

ship(__name__)

#: Vectors of a block, and blocks that a Python worker gets at a time.
BLOCK, BATCH_BLOCKS = 4_096, 16
#: Gaps are taken so much smaller, relative to the numbers they come from, that rounding never hides a nearer centroid.
MARGIN = 1e-9


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """Each component as floor(scale * x)."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))


def usable(vector: Column, dims: int) -> Column:
    """Whether a vector has exactly so many components, all of them finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce((F.size(vector) == dims) & F.forall(vector, finite), F.lit(False))


def largest_of(numbers: np.ndarray) -> int:
    return max(int(numbers.max(initial=0)), -int(numbers.min(initial=0)))


def squared_distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-number vectors as 64-bit integers; an error where they would not fit."""
    largest = max(largest_of(points), largest_of(centroids))
    if 4 * points.shape[1] * largest**2 >= 1 << 62:
        raise ArithmeticError(f"a component of {largest} is too large: squared distances would not fit in 64 bits")
    # Sums of products below 2^53 are exact in floating point, which is much faster.
    kind = np.float64 if 4 * points.shape[1] * largest**2 < 1 << 53 else np.int64
    points, centroids = points.astype(kind), centroids.astype(kind)
    found = (points**2).sum(axis=1)[:, None] - 2 * (points @ centroids.T) + (centroids**2).sum(axis=1)
    return found.astype(np.int64)


def scan(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (ties: smaller number), its squared distance, and a safe lower bound of the gap to the next nearest."""
    squared = squared_distances(points, centroids)
    rows, nearest = np.arange(len(points)), squared.argmin(axis=1)
    least = squared[rows, nearest]
    if len(centroids) == 1:
        return nearest, least, np.full(len(points), np.inf)
    others = squared.copy()
    others[rows, nearest] = np.iinfo(np.int64).max
    near, far = np.sqrt(least.astype(float)), np.sqrt(others.min(axis=1).astype(float))
    return nearest, least, far - near - MARGIN * (1 + far + near)


def next_block(points: np.ndarray, heaps: list[list[tuple[float, int]]] | None, centroids: np.ndarray, offsets: np.ndarray) -> tuple[list, np.ndarray, np.ndarray, int]:
    """Heaps after a round, the changes of the clusters' sums and counts, and the number of vectors that were measured.

    A heap has (gap + offset when it was measured, row). Without heaps, all rows are measured.
    """
    clusters = len(centroids)
    if heaps is None:
        heaps, rows, old = [[] for _ in range(clusters)], np.arange(len(points)), None
    else:
        popped = []
        for c, heap in enumerate(heaps):
            while heap and heap[0][0] <= offsets[c]:
                popped.append((heapq.heappop(heap)[1], c))
        rows, old = np.array([r for r, _ in popped], np.int64), np.array([c for _, c in popped], np.int64)
    sums, counts = np.zeros((clusters, points.shape[1]), np.int64), np.zeros(clusters, np.int64)
    if len(rows):
        nearest, _, gaps = scan(points[rows], centroids)
        keys = gaps + offsets[nearest] - MARGIN * offsets[nearest]
        for c, key, row in zip(nearest.tolist(), keys.tolist(), rows.tolist()):
            heapq.heappush(heaps[c], (key, row))
        moved = np.ones(len(rows), bool) if old is None else nearest != old
        np.add.at(sums, nearest[moved], points[rows[moved]])
        np.add.at(counts, nearest[moved], 1)
        if old is not None:
            np.subtract.at(sums, old[moved], points[rows[moved]])
            np.subtract.at(counts, old[moved], 1)
    return heaps, sums, counts, len(rows)


def _unpack(row, dims: int) -> tuple[np.ndarray, list[list[tuple[float, int]]] | None]:
    points = np.frombuffer(row.points, "<i4").reshape(-1, dims)
    if row.sizes is None:
        return points, None
    pairs = list(zip(np.frombuffer(row.keys, "<f8").tolist(), np.frombuffer(row.members, "<i4").tolist()))
    ends = np.cumsum(np.frombuffer(row.sizes, "<i8")).tolist()
    return points, [pairs[a:b] for a, b in zip([0, *ends], ends)]


BLOCK_FIELDS = "points binary, keys binary, members binary, sizes binary, measured long, moved array<struct<cluster: int, count: long, sums: array<long>>>"


def _blocks(batches: Iterator[pd.DataFrame], dims: int) -> Iterator[pd.DataFrame]:
    """Rows of vectors as blocks without heaps."""
    for batch in batches:
        for low in range(0, len(batch), BLOCK):
            some = batch.iloc[low : low + BLOCK]
            points = np.array(some["point"].to_list(), np.int64)
            if largest_of(points) >= 1 << 31:
                raise ArithmeticError("a component is too large: squared distances would not fit in 64 bits")
            nothing = {name: pd.Series([None], dtype=object) for name in ("keys", "members", "sizes", "moved")}
            yield pd.DataFrame({"ids": [some["id"].to_list()], "points": [points.astype("<i4").tobytes()], "measured": [0], **nothing})


def _rounds(batches: Iterator[pd.DataFrame], centroids: np.ndarray, offsets: np.ndarray) -> Iterator[pd.DataFrame]:
    """Blocks after a round."""
    for batch in batches:
        for row in batch.itertuples(index=False):
            points, heaps = _unpack(row, centroids.shape[1])
            heaps, sums, counts, measured = next_block(points, heaps, centroids, offsets)
            touched = np.flatnonzero(counts | np.abs(sums).any(axis=1))
            yield pd.DataFrame(
                {
                    "ids": [row.ids],
                    "points": [row.points],
                    "keys": [np.array([k for h in heaps for k, _ in h], "<f8").tobytes()],
                    "members": [np.array([r for h in heaps for _, r in h], "<i4").tobytes()],
                    "sizes": [np.array([len(h) for h in heaps], "<i8").tobytes()],
                    "measured": [measured],
                    "moved": [[{"cluster": c, "count": int(counts[c]), "sums": sums[c].tolist()} for c in touched.tolist()]],
                }
            )


def _members(batches: Iterator[pd.DataFrame], centroids: np.ndarray, offsets: np.ndarray) -> Iterator[pd.DataFrame]:
    """(id, cluster, distance) of the vectors of each block after the last assignment."""
    for batch in batches:
        for row in batch.itertuples(index=False):
            points, heaps = _unpack(row, centroids.shape[1])
            heaps = next_block(points, heaps, centroids, offsets)[0]
            cluster = np.empty(len(points), np.int32)
            for c, heap in enumerate(heaps):
                cluster[[r for _, r in heap]] = c
            distance = ((points.astype(np.int64) - centroids[cluster]) ** 2).sum(axis=1)
            yield pd.DataFrame({"id": pd.Series(list(row.ids), dtype=object), "cluster": cluster, "distance": distance})


def _sums(blocks: DataFrame, clusters: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Changes of sums and counts over all blocks: a row for each cluster reaches the driver."""
    moved = blocks.select(F.explode("moved").alias("m")).select("m.*")
    sums, counts = np.zeros((clusters, dims), dtype=object), np.zeros(clusters, dtype=object)
    for row in moved.groupBy("cluster").agg(F.sum("count"), *[F.sum(F.get("sums", F.lit(i))) for i in range(dims)]).collect():
        counts[row[0]], sums[row[0]] = row[1], np.array(row[2:], dtype=object)
    return sums, counts


def moved_centroids(centroids: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Componentwise floor(sum / count); a cluster without vectors keeps its centroid."""
    return np.array([[int(s) // int(n) for s in row] if n else old for old, row, n in zip(centroids.tolist(), sums, counts)], np.int64)


def drifted(offsets: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Offsets plus what each cluster's gaps can have lost: its own drift and the largest of any other."""
    drift = np.array([math.sqrt(sum(d * d for d in row)) for row in (new - old).tolist()]) * (1 + MARGIN)
    others = np.array([max((d for j, d in enumerate(drift) if j != c), default=0.0) for c in range(len(drift))])
    return offsets + drift + others


def cluster_vectors(
    table: DataFrame, id: str = "vec_id", vector: str = "embedding", dims: int = 64, clusters: int = 40, rounds: int = 5, salt: str = "2", scale: int = 256
) -> DataFrame:
    """``id``, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector that takes part.

    These are the vectors with exactly ``dims`` components, all finite; they are made whole by floor(scale * x). The first centroids are
    the vectors with the smallest sha256 of ``salt:id``; a missing id comes last, rows with one id go by their components. Each
    round gives every vector to the nearest centroid (squared distance, ties to the smaller number) and moves centroids to
    floor(sum / count) of their vectors; without vectors they stay. A last assignment follows. Distances are exact; components for
    which they would not fit in 64 bits are an error. Repeated rows are vectors each; fewer vectors than ``clusters`` are centroids
    all; an empty table, or one without such vectors, gives an empty one.
    """
    spark = table.sparkSession
    kept = table.where(usable(F.col(vector), dims)).select(F.col(id).alias("id"), whole_numbers(F.col(vector), scale).alias("point"))
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    first = kept.orderBy(F.asc_nulls_last(digest), "point").limit(clusters).collect()
    kind = kept.schema["id"].dataType.simpleString()
    if not first:
        return spark.createDataFrame([], f"`{id}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = np.array([r["point"] for r in first], np.int64)
    offsets, fields = np.zeros(len(first)), f"ids array<{kind}>, {BLOCK_FIELDS}"
    sums, counts = np.zeros(centroids.shape, dtype=object), np.zeros(len(first), dtype=object)

    blocks, path = kept.mapInPandas(lambda b: _blocks(b, dims), fields), None
    for number in range(rounds):
        new = scratch_path(spark, f"round{number}")
        if path is None:
            kept.mapInPandas(lambda b: _rounds(_blocks(b, dims), centroids, offsets), fields).write.parquet(new)
        else:
            # A row is a block.
            with arrow_batches(spark, BATCH_BLOCKS):
                blocks.mapInPandas(lambda b: _rounds(b, centroids, offsets), fields).write.parquet(new)
            # The round before is not needed any more: there are never more than two on the disk.
            delete_path(spark, path)
        blocks, path = spark.read.schema(blocks.schema).parquet(new), new
        changed, count = _sums(blocks, len(centroids), dims)
        sums, counts = sums + changed, counts + count
        moved = moved_centroids(centroids, sums, counts)
        offsets, centroids = drifted(offsets, centroids, moved), moved

    final = centroids, offsets
    with arrow_batches(spark, BATCH_BLOCKS if path else int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))):
        found = stage(blocks.mapInPandas(lambda b: _members(b, *final), f"id {kind}, cluster int, distance long"), "members")
    if path:
        delete_path(spark, path)
    inertia = found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()
    total = sum(r["inertia"] for r in inertia)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    figures = [(r["cluster"], r["inertia"], total, digests[r["cluster"]]) for r in inertia]
    # A row for each cluster.
    figures = spark.createDataFrame(figures, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = found.join(F.broadcast(figures), "cluster")
    return out.select(F.col("id").alias(id), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
