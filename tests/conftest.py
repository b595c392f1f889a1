import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from check import session

    spark = session("4")
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def values(spark):
    """Evaluate a column function over rows of arguments."""

    def run(function, rows, types="string"):
        rows = [r if isinstance(r, tuple) else (r,) for r in rows]
        kinds = types.split(",")
        names = [f"c{i}" for i in range(len(kinds))]
        schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds))
        frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
        from pyspark.sql import functions as F

        out = frame.select("i", function(*[F.col(n) for n in names]).alias("x")).orderBy("i").collect()
        return [r["x"] for r in out]

    return run
