"""A shared folder for tables that a job writes in order to read them again."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}
_made: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below ``spark.checkpoint.dir``.

    Where that is unset, a local master gets a temporary folder of its own; on a cluster it is an error, because
    other machines would not see such a folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local.get("root")
        if root is None:
            root = _local["root"] = tempfile.mkdtemp(prefix="onomast-")
            atexit.register(shutil.rmtree, root, ignore_errors=True)
    path = f"{root.rstrip('/')}/onomast/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def release_scratch(spark: SparkSession, since: int = 0, keep: int = 0) -> int:
    """Delete the tables that this process wrote to the shared folder; call it when no result that uses them is needed.

    With ``since``, a number that ``scratch_written`` gave, earlier tables stay; so do the last ``keep`` ones. Returns how many were deleted.
    """
    last = len(_made) - keep
    gone = _made[since:last]
    _made[since:last] = []
    return sum(delete_path(spark, path) for path in gone)


def scratch_written() -> int:
    """How many tables this process has written and not released."""
    return len(_made)


def delete_path(spark: SparkSession, name: str) -> bool:
    """Delete a folder of any store that Spark reads; whether it was there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write the frame to the shared folder, in a folder for each value of ``by`` if that is given, and read it back.

    The result no longer depends on how ``df`` was computed: lost executors cost no recomputation, values that depend
    on the run (partition numbers, paid replies) are fixed, and the planner sees the table's real size.
    """
    path = scratch_path(df.sparkSession, label)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Rounds:
    """Tables of a loop, each of which replaces the one before: there are never more than two on the disk."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.path = spark, label, None

    def write(self, df: DataFrame) -> DataFrame:
        before, self.path = self.path, scratch_path(self.spark, self.label)
        df.write.parquet(self.path)
        if before:
            delete_path(self.spark, before)
            _made.remove(before)
        return self.spark.read.schema(df.schema).parquet(self.path)


#: Steps of a plan that only read: a scan, chosen columns and rows, and a name.
_READING = ("Relation", "Project", "Filter", "SubqueryAlias", "LocalRelation", "Range")


def settled(df: DataFrame, label: str) -> DataFrame:
    """The frame for use by several jobs: as it is if it only reads columns and rows of one table, or else written.

    What joins, groups, explodes or calls Python is worked out once; a bare scan is cheaper to read again than to write.
    """
    steps = (line.lstrip(" :+-") for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines())
    return df if all(step.startswith(_READING) for step in steps if step) else stage(df, label)
