"""Paid replies on shared storage, committed batch by batch, and what became of each call."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from ..sources.scratch import scratch_path

#: Batches of one run at most: beyond ``MAX_BATCHES`` times the keys of a batch, batches grow.
MAX_BATCHES = 1_000
CALLS = "array<struct<task: string, error: string, started: double, seconds: double>>"

_KEY, _BATCH, _CALLS = "_key", "_batch", "_calls"


@dataclass
class ReplyLog:
    """A folder of replies: per key and batch a row with the replies it got (null: none) and the calls it took.

    A batch is a job of its own whose rows become visible when it ends. What is lost with an executor is a task's share of
    the running batch, with the driver the running batch; everything before it is never asked again.
    """

    spark: SparkSession
    path: str
    key: DataType
    tasks: tuple[str, ...]

    @property
    def schema(self) -> StructType:
        replies = [StructField(t, StringType(), True) for t in self.tasks]
        return StructType([StructField(_KEY, self.key, True), *replies, StructField(_CALLS, DataType.fromDDL(CALLS), True)])

    def rows(self) -> DataFrame:
        """Everything that was committed."""
        return self.spark.read.schema(self.schema).parquet(self.path)

    def known(self) -> DataFrame:
        """A row per key with a reply for each task that has one; of several replies, the smallest."""
        return self.rows().groupBy(_KEY).agg(*[F.min(t).alias(t) for t in self.tasks])

    def ask(self, asked: DataFrame, key: str, answer: Callable[[DataFrame], DataFrame], batch_keys: int) -> None:
        """Commit the replies to all prompts (columns named like the tasks) that have none.

        ``answer`` turns a frame of ``_key`` and prompts into one with the log's columns. A prompt whose reply is known is null.
        Keys are dealt to batches by hash.
        """
        # An empty write makes the folder.
        self.spark.createDataFrame([], self.schema).write.mode("append").parquet(self.path)
        known = self.known().select(F.col(_KEY).alias("_known"), *[F.col(t).alias(f"_{t}") for t in self.tasks])
        joined = asked.select(F.col(key).alias(_KEY), *self.tasks).join(known, F.col(_KEY).eqNullSafe(F.col("_known")), "left")
        open_ = joined.select(_KEY, *[F.when(F.col(f"_{t}").isNull(), F.col(t)).alias(t) for t in self.tasks])
        open_ = open_.where(" or ".join(f"`{t}` is not null" for t in self.tasks))
        # Written, as the log grows while it is read: once to count, once in batches.
        path = scratch_path(self.spark, "prompts")
        open_.write.parquet(path)
        open_ = self.spark.read.schema(open_.schema).parquet(path)
        batches = min(MAX_BATCHES, math.ceil(open_.count() / batch_keys))
        if batches > 1:
            path = scratch_path(self.spark, "batches")
            dealt = open_.withColumn(_BATCH, F.pmod(F.xxhash64(_KEY), F.lit(batches)))
            dealt.repartition(_BATCH).write.partitionBy(_BATCH).parquet(path)
            dealt = self.spark.read.schema(dealt.schema).parquet(path)
        for batch in range(batches):
            some = open_ if batches == 1 else dealt.where(F.col(_BATCH) == batch).drop(_BATCH)
            answer(some).select(*self.schema.fieldNames()).write.mode("append").parquet(self.path)

    def calls(self) -> DataFrame:
        """Every call: _key, task, error (null for a reply), started (seconds of the epoch), seconds."""
        return self.rows().select(_KEY, F.explode(_CALLS).alias("c")).select(_KEY, "c.*")

    def failed(self) -> DataFrame:
        """(key, task, error) of what still has no reply, with the error of the last call."""
        last = self.calls().groupBy(_KEY, "task").agg(F.count_if(F.col("error").isNull()).alias("good"), F.max_by("error", "started").alias("error"))
        return last.where("good = 0").select(F.col(_KEY).cast("string").alias("key"), "task", "error")

    def figures(self) -> DataFrame:
        """Per task: keys, calls, replies, failed calls, mean seconds of a call, elapsed seconds, calls a minute."""
        begun, ended = F.min("started"), F.max(F.col("started") + F.col("seconds"))
        sums = self.calls().groupBy("task").agg(
            F.count_distinct(F.struct(_KEY)).alias("keys"),
            F.count("*").alias("calls"),
            F.count_if(F.col("error").isNull()).alias("replies"),
            F.count("error").alias("failed"),
            F.avg("seconds").alias("call_seconds"),
            (ended - begun).alias("elapsed_seconds"),
        )
        return sums.withColumn("calls_per_minute", F.try_divide(F.col("calls") * 60, "elapsed_seconds"))
