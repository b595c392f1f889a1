"""Number functions. Rounding is half to even throughout, which ``rint`` does exactly on doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DECIMAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
WHOLE = r"^\s*[+-]?[0-9]+\s*$"


def decimal_comma(c: Column) -> Column:
    """``"9,534"`` → 9.534; null for what is no number."""
    text = F.replace(c, F.lit(","), F.lit("."))
    return F.when(text.rlike(DECIMAL), text.try_cast("double"))


def whole_number(c: Column) -> Column:
    """``"13"`` → 13; null for what is no whole number."""
    return F.when(c.rlike(WHOLE), c.try_cast("bigint"))


def strip_digits_sep(c: Column) -> Column:
    """``"1.863 401"`` → 1863401; null if nothing is left, an error for what is no number."""
    digits = F.nullif(F.regexp_replace(c, "[. ]", ""), F.lit(""))
    return round_count(digits)


def round_count(c: Column) -> Column:
    """Nearest whole number."""
    return F.rint(c.cast("double")).cast("bigint")


def rate_to_count(population: Column, rate: Column, unit: Column) -> Column:
    """Persons behind a rate: per mille, per cent, or (any other unit, null too) the rate itself; null without a population."""
    per_mille = population * (rate / F.lit(1000.0))
    per_cent = population * (rate / F.lit(100.0))
    persons = F.when(unit == "‰", per_mille).when(unit == "%", per_cent).otherwise(rate)
    return F.when(population.isNotNull(), round_count(persons))


def share_percent(value: Column, total: Column) -> Column:
    """Value as a percentage of the total; null if the total is 0."""
    return F.try_divide(value, total) * 100
