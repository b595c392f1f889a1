"""Population by place and gender."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import FEMALE_KEY, MALE_KEY, TOTAL_KEY
from ..functions.numbers import strip_digits_sep
from ..functions.text import clean_label, label_code, label_text, normalize_label
from ..operators.lookups import last_of_each
from ..sources.scratch import stage

# Columns of the population file, in its order.
POPULATION_COLUMNS = [
    "ambito",
    "province_raw",
    "municipality_raw",
    "gender",
    "nationality",
    "period",
    "population",
]
VARIANTS = [MALE_KEY, FEMALE_KEY, TOTAL_KEY]


def load_population(
    raw: DataFrame, nationality: str = "Total", period: str = "2024", label_mode: str = "first_token"
) -> DataFrame:
    """Typed rows of one nationality and period, with code and name of province and municipality.

    ``label_mode="first_token"`` keeps the first word of each name, which is how published results were made;
    ``"full"`` keeps whole names and turns round those of municipalities too. Other columns of ``raw`` are kept.
    """
    province = clean_label(label_text(F.col("province_raw"), label_mode))
    municipality = label_text(F.col("municipality_raw"), label_mode)
    return raw.where((F.col("nationality") == nationality) & (F.col("period") == period)).withColumns(
        {
            "population": strip_digits_sep(F.col("population")),
            "province_id": label_code(F.col("province_raw")),
            "province_name": province,
            "municipality_id": label_code(F.col("municipality_raw")),
            "municipality_name": clean_label(municipality) if label_mode == "full" else municipality,
        }
    )


def place_key(name: Column, label_mode: str) -> Column:
    """Comparison key of a place name that is to be looked up."""
    return normalize_label(clean_label(name) if label_mode == "full" else name)


def place_lookup(population: DataFrame, order_by: str) -> DataFrame:
    """One row per province and municipality (null on the rows of the province itself).

    ``v0``, ``v1``, ``v2`` are men, women, all; of duplicate rows the last counts. ``province_display`` is the name on the
    province's first row for all genders. The table is written once, so that the planner knows how small it is.
    """
    keyed = population.withColumns(
        {
            "province_key": normalize_label(F.col("province_name")),
            "municipality_key": normalize_label(F.col("municipality_name")),
            "in_town": F.col("municipality_name").isNotNull(),
        }
    )
    whole = ~F.col("in_town") & (F.col("gender") == TOTAL_KEY) & F.col("population").isNotNull()
    places = keyed.groupBy("province_key", "municipality_key", "in_town").agg(
        *last_of_each("gender", "population", VARIANTS, order_by),
        F.min_by("province_name", F.when(whole, F.col(order_by))).alias("province_display"),
        F.count("population").alias("rows"),
    )
    # Filtered only now: above the keys, the filter would work out each of them a second time.
    usable = stage(places, "places").where(
        "rows > 0 and province_key is not null and in_town = (municipality_key is not null)"
    )
    return usable.drop("in_town", "rows")


def province_lookup(places: DataFrame) -> DataFrame:
    """Population per province."""
    return places.where("municipality_key is null").drop("municipality_key")


def municipality_lookup(places: DataFrame) -> DataFrame:
    """Population per province and municipality."""
    return places.where("municipality_key is not null").drop("province_display")


def only_municipalities(places: DataFrame) -> DataFrame:
    """Population and province of each municipality whose name one province has; of any other only the list of provinces."""
    shown = province_lookup(places).select("province_key", "province_display")
    towns = municipality_lookup(places).join(shown, "province_key", "left")
    towns = towns.withColumn("province", F.coalesce("province_display", "province_key"))
    single = F.count("*") == 1
    people = [F.when(single, F.max(f"v{i}")).alias(f"v{i}") for i in range(len(VARIANTS))]
    provinces = F.array_join(F.array_sort(F.collect_set("province")), ", ")
    return towns.groupBy("municipality_key").agg(*people, provinces.alias("provinces"))
