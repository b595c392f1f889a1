"""Decades and regions of chosen names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import gender_alias, gender_code
from ..functions.numbers import rate_to_count, round_count
from ..functions.text import build_key
from ..operators.lookups import first_of, lookup_default
from ..operators.matching import ORDER, Request, match_requests, missing_requests
from ..operators.ranking import sort_rows
from ..operators.series import explode_regions, explode_series
from ..sources.readers import FILE_ORDER, parse_regions, parse_series
from ..sources.scratch import stage
from ..sources.writers import write_records
from .population import VARIANTS, only_municipalities, place_key, province_lookup

# Kinds of region, their views, and the name of an unknown one.
REGION_TYPES = {"muni": "municipio", "prov": "provincia"}
UNKNOWN_REGION = "Desconocido"


def _checked(payloads: DataFrame) -> DataFrame:
    """The payloads with the key of their name; a gender that cannot be asked for is an error."""
    known = payloads.where(gender_code(F.col("gender")).isNotNull())
    return known.withColumn("nombre_id", build_key(F.col("nombre"), F.col("gender")))


def decade_series(payloads: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """Persons per name, gender and decade out of series payloads."""
    points = explode_series(parse_series(_checked(payloads), mode=mode))
    return points.select("nombre_id", "nombre", "gender", "decade", round_count(F.col("amount")).alias("persons"))


def _region_rows(payloads: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """Regions with their rates out of region payloads."""
    return explode_regions(parse_regions(_checked(payloads), mode=mode))


def _named(rows: DataFrame, regions: DataFrame, view: str) -> DataFrame:
    if view not in REGION_TYPES:
        raise ValueError(f"view must be one of {sorted(REGION_TYPES)}, not {view!r}")
    named = lookup_default(rows, regions, "region_id", "region_name", UNKNOWN_REGION)
    return named.withColumn("region_type", F.lit(REGION_TYPES[view]))


def region_rates(payloads: DataFrame, regions: DataFrame, view: str, mode: str = "FAILFAST") -> DataFrame:
    """Named regions with their rates out of region payloads."""
    return _named(_region_rows(payloads, mode), regions, view)


def estimate_regions(
    payloads: DataFrame,
    regions: DataFrame,
    places: DataFrame,
    view: str,
    label_mode: str = "first_token",
    mode: str = "FAILFAST",
) -> DataFrame:
    """Estimated persons per name and region: the region's rate times its population of that gender (``place_lookup``).

    Regions whose population is unknown stay, without persons. A municipality counts as known only if one province has
    one of that name; otherwise its parent is the list of those provinces. The rows are not sorted (``sort_records``).
    """
    return _estimated(region_rates(payloads, regions, view, mode), places, view, label_mode)


def _estimated(rates: DataFrame, places: DataFrame, view: str, label_mode: str) -> DataFrame:
    """Persons, and the parent region, of named regions with their rates."""
    key = "province_key" if view == "prov" else "municipality_key"
    lookup = province_lookup(places) if view == "prov" else only_municipalities(places)
    found = rates.withColumn(key, place_key(F.col("region_name"), label_mode)).join(lookup, key, "left")
    parent = F.col("region_name" if view == "prov" else "provinces")
    # Columns of their own: both are used several times.
    found = found.withColumn("_wanted", gender_alias(F.col("gender")))
    found = found.withColumn("_people", first_of(F.col("_wanted"), VARIANTS, 2))
    return found.select(
        "nombre_id",
        "nombre",
        "gender",
        "region_id",
        "region_name",
        "percentage",
        "unidad",
        rate_to_count(F.col("_people"), F.col("percentage"), F.col("unidad")).alias("persons"),
        "region_type",
        parent.alias("parent_region_name"),
    )


def sort_records(records: DataFrame) -> DataFrame:
    """Sort by request, if there are requests, then by type and id of the region; name and gender keep a region of many rows from filling one task."""
    keys = [*([ORDER] if ORDER in records.columns else []), "region_type", "region_id", "nombre", "gender"]
    return sort_rows(records, [F.asc(k) for k in keys], keys)


def name_details(
    base: DataFrame,
    series: DataFrame,
    region_payloads: DataFrame,
    regions: dict[str, DataFrame],
    places: DataFrame,
    names: Sequence[Request] | None = None,
    limit: int | None = None,
    label_mode: str = "first_token",
    name: str = "Nombre",
    group: str = "Gender",
    base_order: list[str] | None = None,
    report_missing: bool = False,
) -> dict[str, DataFrame]:
    """Decades, municipalities and provinces of the chosen names, out of the landed payloads.

    ``region_payloads`` has a column ``vista`` (``muni`` or ``prov``), ``regions`` a map table for each. The column ``request``
    is the place of the request; without requests, the first ``limit`` rows are those in file order, if ``with_file_order``
    has added it to ``base``, or else by ``base_order``. The targets are worked out once and written, as are the regions of their
    payloads, in a folder for each view: a payload is parsed once, however many tables and jobs use it. With ``report_missing``, a
    table ``missing`` has the requests that no row of ``base`` answers.
    """
    first = base_order or ([FILE_ORDER] if FILE_ORDER in base.columns else [name, group])
    chosen = match_requests(base, names, name, group, first, limit)
    asked = chosen.groupBy(F.col(name).alias("nombre"), F.col(group).alias("gender")).agg(F.min(ORDER).alias(ORDER))
    asked = stage(asked, "targets")
    targets = asked.drop(ORDER)

    def of_targets(payloads: DataFrame) -> DataFrame:
        return payloads.join(targets, ["nombre", "gender"], "left_semi")

    def in_order(table: DataFrame) -> DataFrame:
        return table.join(asked, ["nombre", "gender"], "left").select(*table.columns, ORDER)

    tables = {"decades": in_order(decade_series(of_targets(series)))}
    views = {"muni": "municipios", "prov": "provincias"}
    rows = stage(_region_rows(of_targets(region_payloads.where(F.col("vista").isin(*views)))), "regions", "vista")
    for view, table in views.items():
        rates = _named(rows.where(F.col("vista") == view).drop("vista"), regions[view], view)
        tables[table] = in_order(_estimated(rates, places, view, label_mode))
    if report_missing and names is not None:
        tables["missing"] = missing_requests(base, names, name, group)
    return tables


def write_details(tables: dict[str, DataFrame], folder: str, prefix: str = "details") -> list[str]:
    """Write each table as CSV without its helper keys, in order; a table without rows has no output. Returns the tables written.

    Each table is worked out once: what sorting counts and samples is written before, and rows are counted as they are written.
    """
    written = []
    for name, table in tables.items():
        if "region_id" in table.columns:
            records = sort_records(table)
        else:
            keys = [c for c in (ORDER, "decade", "nombre", "gender", "wanted_name") if c in table.columns]
            records = sort_rows(table, [F.asc(k) for k in keys], keys)
        if write_records(records, f"{folder}/{prefix}_{name}", drop=("nombre_id", ORDER)):
            written.append(name)
    return written
