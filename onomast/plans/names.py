"""Base table, metrics and young popular names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import char_count, is_compound, syllable_count
from ..operators.groups import profile, share_of_group
from ..operators.ranking import rank_in_group, sort_rows, top_k
from ..sources.readers import scan_tagged_sheets
from ..sources.writers import write_records

# The columns of the names tables and the sheets they come from.
NAME, COUNT, AGE, GENDER = "Nombre", "Frecuencia", "Edad Media (*)", "Gender"
SHEETS = {"Hombres": "Male", "Mujeres": "Female"}
SHEET_SCHEMA = f"`{NAME}` string, `{COUNT}` bigint, `{AGE}` double"
PREAMBLE = 6


def build_names_base(spark: SparkSession, path: str, schema: str = SHEET_SCHEMA, skip: int = PREAMBLE, multiline: bool = False) -> DataFrame:
    """Both sheets as one table: name, count, average age, gender. ``multiline`` allows line breaks in quoted cells."""
    return scan_tagged_sheets(spark, path, schema, skip, SHEETS, GENDER, multiline=multiline).select(NAME, COUNT, AGE, GENDER)


def simple_male() -> Column:
    """Keeps one-word names of men."""
    return ~F.col("Is_Compound") & (F.lower(F.col(GENDER)) == "male")


def process_names(base: DataFrame, keep: Column | None = None, plan: str = "auto") -> DataFrame:
    """Compound flag, share and rank in the gender, characters and syllables of the names that ``keep`` lets pass.

    Share and rank are over the kept rows. ``Popularity`` gives the sorted order, so the result itself is not sorted.
    """
    kept = base.withColumn("Is_Compound", is_compound(F.col(NAME))).where(simple_male() if keep is None else keep)
    shared = share_of_group(kept, GENDER, COUNT, "Percentage")
    ranked = rank_in_group(shared, GENDER, COUNT, [NAME], "Popularity", plan)
    return ranked.select(
        NAME,
        COUNT,
        AGE,
        GENDER,
        "Is_Compound",
        "Percentage",
        "Popularity",
        char_count(F.col(NAME)).alias("Character_Count"),
        syllable_count(F.col(NAME)).alias("Syllable_Count"),
    )


def young_popular_names(names: DataFrame, max_age: float = 40, top_n: int = 50) -> DataFrame:
    """The most frequent names with an average age below the limit."""
    return top_k(names.where(F.col(AGE) < max_age), COUNT, top_n, [NAME, GENDER])


def young_popular_report(names: DataFrame, max_age: float = 40) -> DataFrame:
    """Size and ranges of the table before and after the age limit, and the compound names among them."""
    flags = {"compound": "Is_Compound"} if "Is_Compound" in names.columns else None
    return profile(names, [AGE, COUNT], flags, F.col(AGE) < max_age)


def young_popular_profile(names: DataFrame, max_age: float = 40, top_n: int = 50) -> DataFrame:
    """Rows, ranges of age and count, and compound names, in all and by gender, of the whole table, of the names below the
    age limit and of the chosen ones. ``scope`` is ``all``, ``young`` or ``chosen``; the line over all genders has a null there.
    """
    compound = F.count_if("Is_Compound") if "Is_Compound" in names.columns else F.lit(0).cast("bigint")
    scopes = {"all": names, "young": names.where(F.col(AGE) < max_age), "chosen": young_popular_names(names, max_age, top_n)}
    lines = [
        rows.rollup(GENDER).agg(
            F.count("*").alias("rows"),
            F.min(AGE).alias("min_age"),
            F.max(AGE).alias("max_age"),
            F.min(COUNT).alias("min_count"),
            F.max(COUNT).alias("max_count"),
            compound.alias("compound"),
        ).select(F.lit(scope).alias("scope"), "*")
        for scope, rows in scopes.items()
    ]
    return lines[0].unionByName(lines[1]).unionByName(lines[2])


def write_young_popular(names: DataFrame, path: str, max_age: float = 40, top_n: int = 50) -> bool:
    """Write the young popular names as CSV; no output if there are none."""
    return write_records(young_popular_names(names, max_age, top_n), path, drop=())


def write_names_base(base: DataFrame, path: str) -> bool:
    """Write the base table as CSV; no output for an empty one."""
    return write_records(base.select(NAME, COUNT, AGE, GENDER), path, drop=())


def write_processed(names: DataFrame, path: str) -> bool:
    """Write the processed names as CSV, by gender and rank; no output if there are none."""
    keys = [GENDER, "Popularity", NAME]
    return write_records(sort_rows(names, [F.asc_nulls_last(k) for k in keys], keys), path, drop=())
