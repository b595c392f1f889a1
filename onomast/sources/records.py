"""Records of delimited text whose quoted fields hold line breaks, read in splits.

Whether a line break ends a record depends on the quotes before it, back to the start of the file. Each split counts its
quotes; a prefix over the splits of a file tells which of them start inside a quoted field. With that, a split puts its lines
together by itself, and only records that cross a split's limit are joined from their pieces.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import stage

#: Splits of one scan at most: the driver sends a few bytes for each of them to every executor.
MAX_SPLITS = 2_000_000

WHOLE, TAIL, MIDDLE, HEAD = 0, 1, 2, 3
FIELDS = "value string, file string, block long, kind int"


def text_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Lines of text files with their file and the start and number of their split; only line feeds end a line."""
    reader = spark.read.option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    split = F.xxhash64("_metadata.file_path", "_metadata.file_block_start", "_metadata.file_block_length")
    return reader.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), split.alias("split")
    )


def _odd_quotes(value: Column) -> Column:
    return (F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))) % 2


def split_starts(lines: DataFrame) -> DataFrame:
    """(split, begins, ends): whether each split begins and ends inside a quoted field. One aggregate; a row per split is written."""
    sums = lines.groupBy("file", "block", "split").agg((F.sum(_odd_quotes(F.col("value"))) % 2).cast("int").alias("odd"))
    before = Window.partitionBy("file").orderBy("block")
    ends = (F.sum("odd").over(before.rowsBetween(Window.unboundedPreceding, 0)) % 2).cast("int")
    return stage(sums.select("split", ends.alias("ends"), "odd").select("split", ((F.col("ends") + F.col("odd")) % 2).alias("begins"), "ends"), "splits")


def _put_together(skip: int, names: list[str] | None, sep: str, fragments: bool):
    """Lines of a split, which stand together and in order, as records, or as the pieces of those that cross its limits.

    The first ``skip`` records of a file are left out; the last of them must have the ``names``, if these are given.
    """

    def check_header(text: str, file: str) -> None:
        found = next(csv.reader([text.removesuffix("\r").removeprefix("\ufeff")], delimiter=sep), [])
        if names is not None and found != names:
            raise ValueError(f"{file} has another header: {text}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of the current split: parity of its quotes so far, records so far, lines of an open record, and whether that began earlier.
        split, file, block, inside, place, pending, head = None, None, None, 0, 0, [], False

        def batch_of(values: pa.Array, kind: int) -> pa.RecordBatch:
            size = len(values)
            columns = [values, pa.array([file] * size, pa.string()), pa.array([block] * size, pa.int64()), pa.array([kind] * size, pa.int32())]
            return pa.RecordBatch.from_arrays(columns, ["value", "file", "block", "kind"])

        def piece(lines: list[str], kind: int) -> Iterator[pa.RecordBatch]:
            if fragments and lines:
                yield batch_of(pa.array(["\n".join(lines)], pa.string()), kind)

        for batch in batches:
            splits = batch["split"].to_numpy(zero_copy_only=False)
            limits = [0, *(np.flatnonzero(splits[1:] != splits[:-1]) + 1).tolist(), len(splits)] if len(splits) else []
            for low, high in zip(limits, limits[1:]):
                if splits[low] != split:
                    yield from piece(pending, MIDDLE if head else TAIL)
                    split, file, block = splits[low], batch["file"][low].as_py(), batch["block"][low].as_py()
                    inside, place, pending = batch["begins"][low].as_py(), 0, []
                    head = inside == 1
                values = batch["value"].slice(low, high - low)
                odd = pc.count_substring(values, '"').to_numpy(zero_copy_only=False) & 1
                open_ = (inside + np.cumsum(odd)) & 1
                inside, skipped = int(open_[-1]), skip if block == 0 else 0
                if not open_.any() and not pending and not head and place >= skipped:
                    place += len(values)
                    if not fragments:
                        yield batch_of(values, WHOLE)
                    continue
                lines, cuts = values.to_pylist(), [0, *(np.flatnonzero(open_ == 0) + 1).tolist()]
                if len(cuts) == 1:
                    pending += lines
                    continue
                found = [[*pending, *lines[: cuts[1]]], *[lines[x:y] for x, y in zip(cuts[1:], cuts[2:])]]
                pending = lines[cuts[-1] :]
                if head:
                    yield from piece(found.pop(0), HEAD)
                    head = False
                texts = ["\n".join(record) for record in found]
                dropped = min(max(skipped - place, 0), len(texts))
                if dropped and place + dropped == skipped and not fragments:
                    check_header(texts[dropped - 1], file)
                place += len(texts)
                if not fragments:
                    yield batch_of(pa.array(texts[dropped:], pa.string()), WHOLE)
        yield from piece(pending, MIDDLE if head else TAIL)

    return run


def quoted_records(lines: DataFrame, skip: int = 0, names: list[str] | None = None, sep: str = ",") -> DataFrame:
    """(value, file) of the records of ``text_lines``, without blank ones; ``skip`` records at the start of each file are left out.

    Quotes may only stand around fields and, doubled, inside of quoted ones. The skipped records must lie in a file's first split; if
    ``names`` are given, the last of them is a header that must have these. A quoted field that a file never closes is an error. Text
    is read twice, and once more where a split starts inside a field, for the records that cross its limit.
    """
    starts = split_starts(lines)
    splits, inside = starts.agg(F.count("*"), F.sum("begins")).first()
    if splits > MAX_SPLITS:
        raise ValueError(f"{splits} splits are too many; raise spark.sql.files.maxPartitionBytes")
    unclosed = stage(starts.where("ends = 1"), "open") if inside else starts.where("ends = 1")
    known = lines.join(F.broadcast(starts), "split", "left")
    moved = F.raise_error("the files are not read in the splits of the first scan")
    known = known.withColumn("begins", F.when(F.col("begins").isNull(), moved).otherwise(F.col("begins")))
    columns = known.select("value", "file", "block", "split", F.col("begins").cast("long").alias("begins"))
    records = columns.mapInArrow(_put_together(skip, names, sep, False), FIELDS).select("value", "file")
    if inside or not unclosed.isEmpty():
        crossing = columns.join(F.broadcast(starts.where("begins = 1 or ends = 1").select("split")), "split", "left_semi").select(*columns.columns)
        pieces = crossing.mapInArrow(_put_together(skip, names, sep, True), FIELDS)
        # In a split, the end of the record before stands first.
        order = [F.col("block"), F.col("kind") == TAIL]
        number = F.sum((F.col("kind") == TAIL).cast("int")).over(Window.partitionBy("file").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
        parts = F.array_sort(F.collect_list(F.struct("block", (F.col("kind") == TAIL).alias("last"), "value")))
        whole = pieces.withColumn("number", number).groupBy("file", "number").agg(parts.alias("parts"), F.max("kind").alias("kind"))
        text = F.array_join(F.transform("parts", lambda p: p["value"]), "\n")
        never = F.raise_error(F.concat(F.lit("a quoted field is never closed in "), F.col("file")))
        records = records.unionByName(whole.select(F.when(F.col("kind") == HEAD, text).otherwise(never).alias("value"), "file"))
    ended = F.when(F.col("value").endswith("\r"), F.substring("value", F.lit(1), F.length("value") - 1)).otherwise(F.col("value"))
    return records.select(ended.alias("value"), "file").where("value <> ''")
