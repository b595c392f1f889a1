"""Centroid clustering against plain rounds, and on odd rows."""

import hashlib
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from onomast.llm import centroids
from onomast.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def plain(rows, clusters=40, rounds=5):
    """Every distance of every round, in whole numbers."""
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows]
    order = sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:clusters]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))
    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        centres = [[sum(x) // len(members[k]) for x in zip(*members[k])] if k in members else c for k, c in enumerate(centres)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = {c: sum(d for _, k, d in found if k == c) for _, c, _ in found}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), digest[c]) for i, c, d in found), key=str)


def rows_of(frame):
    return sorted(((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in frame.collect()), key=str)


def test_query_agrees_with_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{FOLDER}/embeddings.parquet'")
    frame = QUERIES["op12_centroids_heap"](spark, FOLDER)
    cursor = db.execute(ORACLES["op12_centroids_heap"])
    names = [c[0] for c in cursor.description]
    assert names == frame.columns
    assert rows_of(frame) == sorted(cursor.fetchall(), key=str)


@pytest.mark.parametrize("dims,clusters", [(3, 7), (5, 1), (2, 40)])
def test_against_plain_rounds(spark, monkeypatch, dims, clusters):
    rng = np.random.default_rng(dims)
    matrix = rng.integers(-3, 4, size=(300, dims)) / 64 + rng.integers(0, 2, size=(300, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(matrix)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    monkeypatch.setattr(centroids, "BLOCK", 41)
    assert rows_of(centroids.cluster_vectors(table, dims=dims, clusters=clusters)) == plain(rows, clusters)


def test_odd_rows(spark):
    bad = [(50, None), (51, [1.0]), (52, []), (53, [1.0, None]), (54, [float("nan"), 1.0]), (55, [float("inf"), 1.0]), (56, [1.0, 2.0, 3.0])]
    good = [(1, [0.0, -0.0]), (1, [0.0, -0.0]), (1, [0.5, 0.25]), (None, [-1.5, 0.001]), (None, [2.0, 2.0]), (2, [-0.001, 1e4]), (3, [0.5, 0.25])]
    table = spark.createDataFrame(bad + good, "vec_id long, embedding array<float>").withColumns({"cluster": F.lit("own"), "ids": F.lit("own"), "point": F.lit(1)})
    for clusters in (1, 2, 3, 40):
        assert rows_of(centroids.cluster_vectors(table, dims=2, clusters=clusters)) == plain(good, clusters)
    for none in (table.limit(0), table.where("vec_id >= 50")):
        out = centroids.cluster_vectors(none, dims=2)
        assert out.collect() == [] and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    for size in (1e30, -1e30, 1e7):
        huge = spark.createDataFrame([(1, [size, 0.0])], "vec_id long, embedding array<float>")
        with pytest.raises(Exception, match="too large"):
            centroids.cluster_vectors(huge, dims=2).collect()


def test_large_components_are_exact():
    points, centres = np.array([[2**25, -(2**25)], [3, 2**24 + 1]]), np.array([[-(2**25), 1], [2**24, 5]])
    exact = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, c)) for c in centres] for p in points]
    assert centroids.squared_distances(points, centres).tolist() == exact


def test_heaps_leave_most_vectors_alone():
    """In later rounds only vectors whose gap is used up are measured, and the clusters are still those of a full scan."""
    rng = np.random.default_rng(1)
    points = (rng.normal(size=(12, 16)) * 400)[rng.integers(0, 12, 3000)] + rng.normal(size=(3000, 16)) * 40
    points = np.floor(points).astype(np.int64)
    centres, offsets = points[rng.choice(3000, 12, replace=False)], np.zeros(12)
    heaps, sums, counts, measured = centroids.next_block(points, None, centres, offsets)
    assert measured == 3000
    later = []
    for _ in range(6):
        moved = centroids.moved_centroids(centres, sums, counts)
        offsets, centres = centroids.drifted(offsets, centres, moved), moved
        heaps, more, change, measured = centroids.next_block(points, heaps, centres, offsets)
        sums, counts = sums + more, counts + change
        later.append(measured)
        cluster = np.empty(3000, int)
        for c, heap in enumerate(heaps):
            cluster[[r for _, r in heap]] = c
        assert (cluster == centroids.squared_distances(points, centres).argmin(axis=1)).all()
    assert later[-1] < 600
