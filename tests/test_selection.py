"""Long top lists: only the rows that pass the bounds are ranked."""

import pytest
from pyspark.sql import functions as F

from onomast.operators import ranking, selection


def ranked(rows, n):
    """The n largest of each group, nulls and NaN last, ties by id."""
    found = {}
    for group, value, i in rows:
        if group is not None:
            found.setdefault(group, []).append((value is None or value != value, -(value or 0) if value == value else 0, i))
    return sorted((g, k + 1, i) for g, some in found.items() for k, (_, _, i) in enumerate(sorted(some)[:n]))


def table_of(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"g string, v {kind}, i long").repartition(5)


CASES = {
    "spread": lambda i: (i * 7919 % 10_007) / 3,
    "repeated": lambda i: float(i % 3),
    "equal": lambda i: 1.0,
    "skewed": lambda i: 10.0 ** (i % 300),
    "missing": lambda i: None if i % 2 else float("nan") if i % 5 == 0 else float(i),
}


@pytest.mark.parametrize("case", list(CASES))
def test_long_lists(spark, case):
    rows = [(("hot", "b", None, "few")[0 if i % 10 < 6 else 1 if i % 10 < 8 else 2 if i % 10 == 8 else 3], CASES[case](i), i) for i in range(20_000)]
    top = ranking.top_n_per_group(table_of(spark, rows), "g", "v", 2_500, ["i"])
    assert sorted((r["g"], r["rank"], r["i"]) for r in top.collect()) == ranked(rows, 2_500)


def test_few_rows_pass(spark):
    table = spark.range(400_000).select((F.col("id") % 2).cast("string").alias("g"), F.xxhash64("id").alias("v"), F.col("id").alias("i"))
    few = selection.largest_candidates(table, "g", "v", 2_000)
    assert 4_000 <= few.count() < 8_000
    exact = [r["i"] for r in table.where("g = '0'").orderBy(F.desc("v")).limit(2_000).collect()]
    top = ranking.top_n_per_group(table, "g", "v", 2_000, ["i"])
    assert [r["i"] for r in top.where("g = '0'").orderBy("rank").collect()] == exact
    # Only what passed is shuffled.
    assert "largest-" in "".join(top.inputFiles()) and all("largest-" in f for f in top.inputFiles())


def test_large_whole_numbers_and_no_rows(spark):
    rows = [("a", 2**62 + i, i) for i in range(3_000)]
    top = ranking.top_n_per_group(table_of(spark, rows, "long"), "g", "v", 1_500, ["i"])
    assert sorted(r["i"] for r in top.collect()) == list(range(1_500, 3_000))
    assert ranking.top_n_per_group(table_of(spark, rows, "long").limit(0), "g", "v", 1_500, ["i"]).collect() == []
    texts = spark.createDataFrame([("a", f"{i:05}", i) for i in range(3_000)], "g string, v string, i long")
    assert sorted(r["i"] for r in ranking.top_n_per_group(texts, "g", "v", 1_500, ["i"]).collect()) == list(range(1_500, 3_000))


def test_a_bound_that_is_too_high_is_noticed(spark, monkeypatch):
    rows = [("a", float(i), i) for i in range(9_000)]
    table = table_of(spark, rows)
    monkeypatch.setattr(selection, "largest_bounds", lambda *a: spark.createDataFrame([("a", 8_000.0)], "_group string, _bound double"))
    assert selection.largest_candidates(table, "g", "v", 2_000) is table
