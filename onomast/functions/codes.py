"""Codes of the gender values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Population columns by gender, and the request code of each gender.
MALE_KEY, FEMALE_KEY, TOTAL_KEY = "Hombres", "Mujeres", "Total"
GENDER_CODES = {"Male": "1", "Female": "6"}


def gender_alias(c: Column) -> Column:
    """Population keys to try for a gender, best first."""
    initial = F.left(F.lower(c), F.lit(1))
    return (
        F.when(initial == "m", F.array(F.lit(MALE_KEY), F.lit(TOTAL_KEY)))
        .when(initial == "f", F.array(F.lit(FEMALE_KEY), F.lit(TOTAL_KEY)))
        .otherwise(F.array(F.lit(TOTAL_KEY)))
    )


def gender_code(c: Column) -> Column:
    """Request code of a gender; any other value is an error."""
    code = None
    for gender, number in GENDER_CODES.items():
        code = F.when(c == gender, F.lit(number)) if code is None else code.when(c == gender, F.lit(number))
    message = F.concat(F.lit("no code for the gender "), F.coalesce(c, F.lit("null")))
    return code.otherwise(F.raise_error(message))
