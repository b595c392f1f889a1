"""Scans. All schemas are explicit, so a scan never costs a pass of its own and ``NA`` stays a text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.errors import AnalysisException

from .records import quoted_records, text_lines

FILE_ORDER = "_file_order"


def _file_order() -> Column:
    """Sort key of the order in which rows stand in the files, files by name. Costs no shuffle."""
    return F.struct(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def with_file_order(df: DataFrame, name: str = FILE_ORDER) -> DataFrame:
    """Add the file order to a frame that comes straight from a scan."""
    return df.select("*", _file_order().alias(name))


def spread_small(df: DataFrame) -> DataFrame:
    """Deal a table out to all cores if it comes in fewer splits than there are cores; a larger one stays as it is.

    For work that costs more than the move, such as parsing or patterns over long texts.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def require_inputs(df: DataFrame, where: str) -> DataFrame:
    """The scan as it is, or ``ValueError`` if it found no file."""
    if not df.rdd.getNumPartitions():
        raise ValueError(f"there is no file to read in {where}")
    return df


def require_nonempty(df: DataFrame, what: str) -> DataFrame:
    """The frame as it is, or ``ValueError`` if it has no row."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty; nothing to do")
    return df


def _open(reader, path: str, source: str) -> DataFrame:
    try:
        return require_inputs(reader.format(source).load(path), path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise ValueError(f"there is no file to read in {path}") from None
        raise


def scan_csv(
    spark: SparkSession, path: str, schema: StructType | str, sep: str = ",", glob: str | None = None, multiline: bool = False
) -> DataFrame:
    """Delimited files with a header; the schema's columns are found by their names in it. A bad value is an error.

    Columns that the schema does not name are left out, one that no header has is a ``ValueError``. ``multiline`` allows
    line breaks inside quotes, as in ``scan_csv_strings``.
    """
    raw = scan_csv_strings(spark, path, sep, multiline, glob)
    wanted = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    lacking = [f.name for f in wanted if f.name not in raw.columns]
    if lacking:
        raise ValueError(f"the header of {path} has no column {', '.join(lacking)}")
    return raw.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted])


def scan_csv_strings(
    spark: SparkSession, path: str, sep: str = ",", multiline: bool = False, glob: str | None = None
) -> DataFrame:
    """Delimited files with a header, every column a string under its name in the header.

    The header is read once. A file with another header, and a row with more or fewer fields, is an error. ``multiline`` allows
    line breaks inside quotes: such files are read in splits too, twice (``quoted_records``); quotes may then only stand around
    whole fields and, doubled, inside of them.
    """
    options = {"sep": sep, "header": True, "escape": '"', "multiLine": multiline} | ({"pathGlobFilter": glob} if glob else {})
    names = _open(spark.read.options(inferSchema=False, **options), path, "csv").schema
    if multiline:
        records = quoted_records(text_lines(spark, path, glob), 1, names.fieldNames(), sep)
        return records.select(_parsed(F.col("value"), names, sep).alias("row")).select("row.*")
    strict = {"mode": "FAILFAST", "enforceSchema": False, "columnPruning": False}
    return _open(spark.read.schema(names).options(**options, **strict), path, "csv")


def scan_headerless(
    spark: SparkSession, path: str, schema: StructType | str, glob: str | None = None, recursive: bool = False
) -> DataFrame:
    """Comma files without a header as one table, in one scan. A bad value is an error; no file is a ``ValueError``."""
    reader = spark.read.schema(schema).options(header=False, escape='"', mode="FAILFAST", recursiveFileLookup=recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return _open(reader, path, "csv")


def with_path_int(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Add the whole number that the pattern's first group finds in the file's path; an error where there is none."""
    return df.select("*", F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).cast("int").alias(name))


def scan_delimited_rename(spark: SparkSession, path: str, names: list[str], sep: str = ";") -> DataFrame:
    """Delimited files with a header, all columns strings and renamed by position."""
    reader = spark.read.schema(", ".join(f"`{n}` string" for n in names))
    return _open(reader.options(sep=sep, header=True, escape='"', mode="FAILFAST", enforceSchema=True), path, "csv")


def _drop_preamble(skip: int):
    """Leave out the first ``skip`` lines of each file. Lines of a file stand together and in order."""

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, seen = None, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            run = pc.run_end_encode(batch["file"])
            ends = np.asarray(run.run_ends)
            starts = np.concatenate(([0], ends[:-1]))
            lines = np.arange(batch.num_rows) - np.repeat(starts, ends - starts)
            files = run.values.to_pylist()
            if files[0] == current:
                lines[: ends[0]] += seen
            current, seen = files[-1], int(lines[-1]) + 1
            keep = (lines >= skip) | (np.asarray(batch["block"]) > 0)
            yield batch.filter(pa.array(keep))

    return drop


def _parsed(value: Column, schema: StructType | str, sep: str) -> Column:
    """A delimited record as a struct; a record with other fields than the schema's is an error."""
    text = schema if isinstance(schema, str) else ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    return F.from_csv(value, F.lit(text), {"sep": sep, "escape": '"', "mode": "FAILFAST", "multiLine": "true"})


def scan_tagged_sheets(
    spark: SparkSession, path: str, schema: StructType | str, skip: int, tags: dict[str, str], tag: str, sep: str = ",", multiline: bool = False
) -> DataFrame:
    """Delimited sheets that start with ``skip`` lines and a header, as one table with the tag of their sheet.

    ``tags`` maps the sheet's label, which is part of the file's path, to the tag. Files are read in splits; only the
    split that starts a file has lines to leave out. ``multiline`` allows line breaks inside quoted fields, as in
    ``scan_csv_strings``; without it, a line is a row. A file without a known label is an error.
    """
    lines = _open(spark.read, path, "text").select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    body = quoted_records(text_lines(spark, path), skip + 1) if multiline else lines.mapInArrow(_drop_preamble(skip + 1), lines.schema)
    label = F.regexp_extract("file", "/(" + "|".join(tags) + r")[^/]*(/[^/]*)?$", 1)
    sheet = F.element_at(F.create_map(*[F.lit(x) for pair in tags.items() for x in pair]), label)
    sheet = F.coalesce(sheet, F.raise_error(F.concat(F.lit("no known label in the path of "), F.col("file"))))
    return body.where(F.col("value") != "").select(_parsed(F.col("value"), schema, sep).alias("row"), sheet.alias(tag)).select("row.*", tag)


def scan_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Landed JSON lines."""
    return _open(spark.read.schema(schema).option("mode", "FAILFAST"), path, "json")


SERIES_SCHEMA = "values array<array<string>>, ticks array<string>"
REGIONS_SCHEMA = "regiones array<struct<id: string, val: string>>, unidad string"


def parse_series(df: DataFrame, payload: str = "payload", mode: str = "FAILFAST") -> DataFrame:
    """Replace a series payload by ``ticks`` and the first row of ``values``; what is missing becomes an empty list."""
    parsed = F.from_json(payload, SERIES_SCHEMA, {"mode": mode})
    nothing = F.array().cast("array<string>")
    return df.withColumn("_parsed", parsed).select(
        *[c for c in df.columns if c != payload],
        F.coalesce("_parsed.ticks", nothing).alias("ticks"),
        F.coalesce(F.get("_parsed.values", F.lit(0)), nothing).alias("values"),
    )


def parse_regions(df: DataFrame, payload: str = "payload", mode: str = "FAILFAST") -> DataFrame:
    """Replace a region payload by ``regiones`` and ``unidad``, which is ``‰`` only where the payload has no such key."""
    parsed = F.from_json(payload, REGIONS_SCHEMA, {"mode": mode})
    has_unit = F.array_contains(F.json_object_keys(payload), "unidad")
    return df.withColumn("_parsed", parsed).select(
        *[c for c in df.columns if c != payload],
        F.coalesce("_parsed.regiones", F.array().cast("array<struct<id: string, val: string>>")).alias("regiones"),
        # The keys are only looked at where no unit was read.
        F.when(F.col("_parsed.unidad").isNull() & has_unit, None).otherwise(F.coalesce("_parsed.unidad", F.lit("‰"))).alias("unidad"),
    )


def scan_xml_ids(
    spark: SparkSession, path: str, row_tag: str = "path", class_attr: str = "class", label_attr: str = "title"
) -> DataFrame:
    """Region id and label of each map shape; of several shapes with one id, the last in file order counts."""
    reader = spark.read.schema(f"_{class_attr} string, _{label_attr} string").options(
        rowTag=row_tag, ignoreSurroundingSpaces=False
    )
    shapes = _open(reader, path, "xml").select(
        F.col(f"_{class_attr}").alias("classes"), F.col(f"_{label_attr}").alias("label"), _file_order().alias("at")
    )
    region = F.regexp_extract("classes", r"(?:^|\s)id_(\S+)", 1)
    whole = F.when(region.rlike(r"^[+-]?[0-9]+$"), region.try_cast("bigint"))
    labelled = shapes.where("classes != '' and label != ''").select(
        whole.alias("region_id"), F.regexp_replace("label", r"(?U)^\s+|\s+$", "").alias("region_name"), "at"
    )
    return (
        labelled.where("region_id is not null")
        .groupBy("region_id")
        .agg(F.max_by("region_name", "at").alias("region_name"))
    )
